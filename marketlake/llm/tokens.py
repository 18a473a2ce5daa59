"""Token ids of whole texts by a public tokenizer, in Arrow batches.

A tokenizer whose pre-tokenizer never joins text across ASCII white space gives a
text's ids as the ids of its words, one after the other.  Words repeat, so each
distinct word is encoded once and remembered by the worker; a text is then a
gather of known ids."""

from __future__ import annotations

import os
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from marketlake.llm.common import byte_slices, large_text, split_words, spread

# Pieces remembered by a worker, some 200 bytes each; a full memory learns no more.
CACHE_PIECES = 250_000

# Words of plain Latin letters with closing marks: lower-casing is one to one there
# and nothing composes, so letters and marks are encoded apart.
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f"
_SIMPLE = f"^[{_LETTERS}]+[.,!?;:%*#$&|)]*$"


def _byte_characters() -> dict[int, str]:
    """Byte-level alphabet: printable Latin-1 bytes stand for themselves, the others
    follow from U+0100 on in order."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return {b: chr(b) if b in printable else chr(next(others)) for b in range(256)}


class WordEncoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.alphabet = _byte_characters()
        self.letters: dict[str, bytes] = {}
        self.others: dict[str, bytes] = {}

    def _of_letters(self, core: str) -> bytes:
        """Ids of lower-case letters: one piece for the pre-tokenizer, and a text that
        the normalizer leaves alone, so the model is asked directly."""
        ids = self.letters.get(core)
        if ids is None:
            piece = core.encode().decode("latin-1").translate(self.alphabet)
            ids = array("I", [t.id for t in self.model.tokenize(piece)]).tobytes()
            if len(self.letters) < CACHE_PIECES:
                self.letters[core] = ids
        return ids

    def _of_any(self, text: str) -> bytes:
        ids = self.others.get(text)
        if ids is None:
            ids = array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()
            if len(self.others) < CACHE_PIECES // 4:
                self.others[text] = ids
        return ids

    def _entries(self, entries: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, starts, counts) of distinct words; a word is two pieces, of which
        the second may be empty."""
        simple = pc.match_substring_regex(entries, _SIMPLE)
        cores = pc.if_else(simple, pc.utf8_lower(pc.utf8_rtrim(entries, ".,!?;:%*#$&|)")), "")
        rest = pc.if_else(
            simple, pc.replace_substring_regex(entries, f"^[{_LETTERS}]+", ""), entries
        )
        cores, rest = cores.dictionary_encode(), rest.dictionary_encode()
        parts = [self._of_letters(w) for w in cores.dictionary.to_numpy(zero_copy_only=False)]
        shift = len(parts)
        parts += [self._of_any(w) for w in rest.dictionary.to_numpy(zero_copy_only=False)]
        sizes = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        pieces = np.column_stack([cores.indices.to_numpy(), rest.indices.to_numpy() + shift])
        flat = np.frombuffer(b"".join(parts), "<u4")
        ids = flat[spread(pieces.ravel().astype(np.int64), np.cumsum(sizes) - sizes, sizes)]
        counts = sizes[pieces].sum(axis=1)
        return ids, np.cumsum(counts) - counts, counts

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, offsets of the texts' ids)."""
        entries, places, offsets = split_words(texts)
        flat, starts, counts = self._entries(entries)
        ids = flat[spread(places, starts, counts)]
        upto = np.concatenate([[0], np.cumsum(counts[places])]).astype(np.int64)
        return ids, upto[offsets]


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """The worker's encoder for a vocabulary file; it stays between tasks."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def encoded(column, path: str) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, ids, offsets) for pieces of a text column; null texts are empty."""
    for first, piece in byte_slices(large_text(column)):
        yield first, *encoder(path).encode(piece)
