"""All registered queries."""

from __future__ import annotations

from importlib import import_module

AREAS = [
    "market",
    "events",
    "graphs",
    "texts",
    "patterns",
    "statistics",
    "functions",
    "streams",
    "lakes",
    "learning",
]


def all_queries():
    found = {}
    for area in AREAS:
        book = import_module(f"marketlake.catalog.{area}").book
        clash = found.keys() & book.queries.keys()
        if clash:
            raise ValueError(f"registered in two areas: {sorted(clash)}")
        found.update(book.queries)
    return found
