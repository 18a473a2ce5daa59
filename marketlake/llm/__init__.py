"""Operators for preparing training corpora.

Nothing else in the library imports this subpackage; it takes general helpers
(session, scratch paths) from the library."""
