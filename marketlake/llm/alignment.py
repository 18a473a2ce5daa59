"""Alignment of two tokenizers' tokens by galloping intersection of their byte ends.

Tokenizer A (a byte-level vocabulary file of ``tokenizers``) reads a space and the text,
tokenizer B (a ``sentencepiece`` model, which adds that space itself) reads the text; both
cover the same bytes.  A token's end is the number of bytes up to it.  In every document the
shorter of the two lists of ends drives: each of its ends gallops through the longer list,
in steps of 1, 2, 4, ... from the place that its share of the list suggests, until it is
bracketed, and a binary search closes the bracket.  All ends of a batch gallop together.

Places where both lists have the same end cut the tokens into groups, the least runs of A and
B tokens that cover the same bytes.  The places found are ranks, so two neighbouring ones also
say which tokens of the longer list overlap a token of the shorter one.  A link is a pair of
an A and a B token that end together, that is the last tokens of a group.

Links are counted corpus-wide per pair of ids by an aggregate; the table of pairs goes to the
documents by a join, broadcast while it has at most BROADCAST_PAIRS rows.

Texts are cut before white space into segments that no token crosses and no merge depends on
(checked on the vocabularies when they are loaded; texts with other than ASCII white space
stay whole), and a worker remembers the ids of at most CACHE_SEGMENTS of them.

Defined cases: a null or empty text, and one whose joined token bytes differ from the space and
the text (as with U+2581 in it), has no tokens: zeros and an empty digest; a null doc_id and
rows that repeat one are documents of their own; other columns are ignored; no documents give
no rows."""

from __future__ import annotations

import hashlib
import json
import os
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.common import byte_slices, keep, large_text, spread
from marketlake.llm.tokens import _byte_characters

CACHE_SEGMENTS = 200_000
BROADCAST_PAIRS = 500_000  # rows of 16 bytes
_SPACE = "\u2581"
# White space besides the six ASCII characters, and separators some engines count as such.
_ODD_SPACE = "[\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\x1c-\x1f]"


# --- galloping -------------------------------------------------------------------------


def gallop(values: np.ndarray, guesses: np.ndarray, longer: np.ndarray) -> np.ndarray:
    """For each value the first place of ``longer`` (ascending) that isn't below it, by
    exponential steps from a guessed place, up or down, and binary search in the bracket."""
    n = len(longer)
    low = np.clip(guesses, 0, max(0, n - 1))
    high = low.copy()
    below = longer[low] < values if n else np.zeros(len(values), bool)
    # low: a place below the value (or -1); high: a place that isn't (or n)
    up, down = np.flatnonzero(below), np.flatnonzero(~below)
    low[down] = -1
    high[up] = n
    step = 1
    at = guesses[up].clip(0, max(0, n - 1))
    while len(up):
        at = at + step
        inside = at < n
        up, at = up[inside], at[inside]
        less = longer[at] < values[up]
        low[up[less]] = at[less]
        high[up[~less]] = at[~less]
        up, at, step = up[less], at[less], step * 2
    step, at = 1, high[down]
    while len(down):
        at = at - step
        inside = at >= 0
        down, at = down[inside], at[inside]
        less = longer[at] < values[down]
        low[down[less]] = at[less]
        high[down[~less]] = at[~less]
        down, at, step = down[~less], at[~less], step * 2
    open_ = np.flatnonzero(high - low > 1)
    while len(open_):
        middle = (low[open_] + high[open_]) >> 1
        less = longer[middle] < values[open_]
        low[open_[less]] = middle[less]
        high[open_[~less]] = middle[~less]
        open_ = open_[high[open_] - low[open_] > 1]
    return high


def _driven(ends, other, offsets, other_offsets, drives):
    """Places in ``ends`` of the documents that drive, and their ranks in ``other``."""
    counts = np.diff(offsets)
    own = np.flatnonzero(np.repeat(drives, counts))
    doc = np.repeat(np.flatnonzero(drives), counts[drives])
    share = np.diff(other_offsets)[doc] / counts[doc]
    guesses = other_offsets[doc] + ((own - offsets[doc]) * share).astype(np.int64)
    return own, gallop(ends[own], guesses, other)


@dataclass
class Alignment:
    """Tokens of some documents: ids, offsets of the documents, and the places of the tokens
    that end groups.  ``driver`` and ``ranks`` are the galloped places."""

    a_ids: np.ndarray
    b_ids: np.ndarray
    a_offsets: np.ndarray
    b_offsets: np.ndarray
    a_ends: np.ndarray
    b_ends: np.ndarray
    a_last: np.ndarray
    b_last: np.ndarray


def intersect(a_ends, b_ends, a_offsets, b_offsets) -> tuple[np.ndarray, np.ndarray]:
    """Places (in A, in B) of equal ends.  Ends ascend over all documents."""
    a_drives = np.diff(a_offsets) <= np.diff(b_offsets)
    a_own, a_rank = _driven(a_ends, b_ends, a_offsets, b_offsets, a_drives)
    b_own, b_rank = _driven(b_ends, a_ends, b_offsets, a_offsets, ~a_drives)
    a_hit = b_ends[a_rank] == a_ends[a_own]
    b_hit = a_ends[b_rank] == b_ends[b_own]
    a_last = np.concatenate([a_own[a_hit], b_rank[b_hit]])
    b_last = np.concatenate([a_rank[a_hit], b_own[b_hit]])
    order = np.argsort(a_last, kind="stable")
    return a_last[order], b_last[order]


def overlaps(ends: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(first, last) places of ``other`` whose tokens share bytes with each token of ``ends``;
    both lists cover the same bytes.  The rank of an end is the last token that overlaps; the
    rank before it, or the place after where both ended together, is the first."""
    guesses = (np.arange(len(ends)) * (len(other) / max(1, len(ends)))).astype(np.int64)
    last = gallop(ends, guesses, other)
    first = np.zeros_like(last)
    first[1:] = last[:-1] + (other[last[:-1]] == ends[:-1])
    return first, last


# --- token ids -------------------------------------------------------------------------


class Tokenizers:
    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        self.a_bytes = self._a_bytes()
        self.b_bytes = [self._b_bytes(i) for i in range(len(self.b))]
        self.a_sizes = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_sizes = np.array([len(x) for x in self.b_bytes], np.int64)
        self.space = self.b.piece_to_id(_SPACE)
        self.separable = self._a_separable() and self._b_separable()
        self.known: dict[bytes, tuple[bytes, bytes] | None] = {}  # None: bytes differ

    def _a_bytes(self) -> list[bytes]:
        back = {ord(c): b for b, c in _byte_characters().items()}
        out = [b""] * self.a.get_vocab_size()
        for piece, i in self.a.get_vocab().items():
            codes = [back.get(ord(c)) for c in piece]
            out[i] = piece.encode() if None in codes else bytes(codes)
        return out

    def _b_bytes(self, i: int) -> bytes:
        if self.b.is_byte(i):
            return bytes([int(self.b.id_to_piece(i)[3:5], 16)])
        return self.b.id_to_piece(i).replace(_SPACE, " ").encode()

    def _a_separable(self) -> bool:
        """The pre-tokenizer never joins a word with the white space after it."""
        made = json.loads(self.a.to_str())
        before = made["pre_tokenizer"] or {}
        return (
            made["normalizer"] is None
            and before.get("type") == "ByteLevel"
            and before.get("use_regex", True)
            and not before.get("add_prefix_space", True)
        )

    def _b_separable(self) -> bool:
        """No piece crosses the start of a run of spaces, tabs or line ends."""
        pieces = [self.b.id_to_piece(i) for i in range(len(self.b)) if not self.b.is_byte(i)]
        return not any(
            _SPACE in p.lstrip(_SPACE) or "\n" in p or "\t" in p for p in pieces
        ) and self.b.encode("\n") == [self.space, *self.b.encode("\n")[1:]]

    def _b_ids(self, segments: list[str]) -> list[list[int]]:
        spaced = [s[1:] if s.startswith(" ") else s for s in segments]
        out = self.b.encode(spaced, num_threads=1)
        for i, (segment, body) in enumerate(zip(segments, spaced)):
            if not body:
                out[i] = [self.space]
            elif body is segment:  # starts with a tab or a line end: the added space goes
                out[i] = out[i][1:]
        return out

    def learn(self, segments: list[bytes]) -> list[tuple[bytes, bytes] | None]:
        """Ids by A and B of segments, as bytes; None where their bytes differ."""
        texts = [s.decode() for s in segments]
        a_all = [e.ids for e in self.a.encode_batch(texts, add_special_tokens=False)]
        found = []
        for segment, a_ids, b_ids in zip(segments, a_all, self._b_ids(texts)):
            same = (
                b"".join([self.a_bytes[i] for i in a_ids]) == segment
                and b"".join([self.b_bytes[i] for i in b_ids]) == segment
            )
            ids = (array("I", a_ids).tobytes(), array("I", b_ids).tobytes())
            found.append(ids if same else None)
        return found

    def ids_of(self, segments: list[bytes]) -> list[tuple[bytes, bytes] | None]:
        out = [self.known.get(s, ()) for s in segments]
        fresh = [i for i, ids in enumerate(out) if ids == ()]
        for a in range(0, len(fresh), 5_000):
            some = fresh[a : a + 5_000]
            for i, ids in zip(some, self.learn([segments[i] for i in some])):
                out[i] = ids
                if len(self.known) < CACHE_SEGMENTS and len(segments[i]) <= 64:
                    self.known[segments[i]] = ids
        return out

    @property
    def strings(self) -> np.ndarray:
        """Decimal ids with each of the four marks that may follow, one table per mark."""
        return _strings(max(len(self.a_sizes), len(self.b_sizes)))


@lru_cache
def _strings(size: int) -> np.ndarray:
    return np.array([f"{i}{mark}" for mark in (",", "|", ";", "") for i in range(size)], object)


@lru_cache
def tokenizers(a_path: str, b_path: str) -> Tokenizers:
    """The worker's tokenizers for two vocabulary files; they stay between tasks."""
    return Tokenizers(a_path, b_path)


def _segments(texts: pa.Array, separable: bool) -> tuple[pa.Array, np.ndarray]:
    """(segments of a space and the text, for each text that isn't empty; offsets of the
    texts' segments)."""
    sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = b"".join(
        b" " + t if t else b"" for t in texts.cast(pa.large_binary()).to_numpy(zero_copy_only=False)
    )
    data = np.frombuffer(flat, np.uint8)
    lengths = sizes + (sizes > 0)
    ends = np.cumsum(lengths)
    starts = (ends - lengths)[sizes > 0]
    white = (data == 32) | ((data >= 9) & (data <= 13))
    cut = np.zeros(len(data), bool)
    if separable and len(data):
        opens = white & (data <= 32) & ((data == 32) | (data == 9) | (data == 10))
        cut[1:] = opens[1:] & ~white[:-1]
        odd = pc.match_substring_regex(texts, _ODD_SPACE).to_numpy(zero_copy_only=False)
        for i in np.flatnonzero(odd):
            cut[ends[i] - lengths[i] : ends[i]] = False
    cut[starts] = True
    bounds = np.append(np.flatnonzero(cut), len(data)).astype(np.int64)
    pieces = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(flat)]
    )
    return pieces, np.concatenate([[0], np.searchsorted(bounds[:-1], ends)]).astype(np.int64)


def align(texts: pa.Array, tok: Tokenizers) -> Alignment:
    """Tokens and groups of texts; none where the bytes of the tokens differ from the text's."""
    pieces, offsets = _segments(texts, tok.separable)
    coded = pieces.dictionary_encode()
    places = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    ids = tok.ids_of(coded.dictionary.to_pylist())
    bad = np.fromiter((x is None for x in ids), bool, len(ids))
    counts = np.diff(offsets)
    if bad.any():
        spoilt = np.concatenate([[0], np.cumsum(bad[places])])
        fine = spoilt[offsets[1:]] == spoilt[offsets[:-1]]
        places = places[np.repeat(fine, counts)]
        counts = np.where(fine, counts, 0)
        ids = [x or (b"", b"") for x in ids]
        offsets = np.concatenate([[0], np.cumsum(counts)])

    def flat(side: int) -> tuple[np.ndarray, np.ndarray]:
        n = np.fromiter((len(x[side]) for x in ids), np.int64, len(ids)) // 4
        all_ids = np.frombuffer(b"".join([x[side] for x in ids]), np.uint32).astype(np.int64)
        upto = np.concatenate([[0], np.cumsum(n[places])])
        return all_ids[spread(places, np.cumsum(n) - n, n)], upto[offsets]

    a_ids, a_offsets = flat(0)
    b_ids, b_offsets = flat(1)
    a_ends, b_ends = np.cumsum(tok.a_sizes[a_ids]), np.cumsum(tok.b_sizes[b_ids])
    a_last, b_last = intersect(a_ends, b_ends, a_offsets, b_offsets)
    return Alignment(a_ids, b_ids, a_offsets, b_offsets, a_ends, b_ends, a_last, b_last)


# --- documents -------------------------------------------------------------------------


def group_strings(al: Alignment, tok: Tokenizers) -> Iterator[str]:
    """``a1,a2|b1;a3|b2,b3`` for each document: ids of a group's A tokens, then of its B
    tokens."""
    size = len(tok.strings) // 4
    n_a = np.diff(al.a_last, prepend=-1)
    n_b = np.diff(al.b_last, prepend=-1)
    a_codes, b_codes = al.a_ids.copy(), al.b_ids.copy()
    a_codes[al.a_last] += size
    b_codes[al.b_last] += 2 * size
    full = al.b_offsets[1:] > al.b_offsets[:-1]
    b_codes[al.b_offsets[1:][full] - 1] += size
    codes = np.empty(len(a_codes) + len(b_codes), np.int64)
    codes[np.arange(len(a_codes)) + np.repeat(np.cumsum(n_b) - n_b, n_a)] = a_codes
    codes[np.arange(len(b_codes)) + np.repeat(np.cumsum(n_a), n_b)] = b_codes
    strings = tok.strings
    bounds = (al.a_offsets + al.b_offsets).tolist()
    for x, y in zip(bounds[:-1], bounds[1:]):
        yield "".join(strings[codes[x:y]].tolist())


def _lists(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(values, kind))


def _aligned(a_path, b_path, batches):
    tok = tokenizers(a_path, b_path)
    for batch in batches:
        for first, texts in byte_slices(large_text(batch.column(1))):
            al = align(texts, tok)
            cuts = np.searchsorted(al.a_last, al.a_offsets)
            before = np.repeat(np.arange(len(texts)), np.diff(cuts))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(first, len(texts)),
                    _lists(al.a_ids, al.a_offsets, pa.int32()),
                    _lists(al.b_ids, al.b_offsets, pa.int32()),
                    _lists(al.a_last - al.a_offsets[before], cuts, pa.int32()),
                    _lists(al.b_last - al.b_offsets[before], cuts, pa.int32()),
                ],
                names=["doc_id", "a_ids", "b_ids", "a_last", "b_last"],
            )


def aligned_documents(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """doc_id, a_ids, b_ids and the places of the tokens that end each group."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        partial(_aligned, a_path, b_path),
        "doc_id long, a_ids array<int>, b_ids array<int>, a_last array<int>, b_last array<int>",
    )


_COUNTS = ["n_a", "n_b", "n_groups", "n_links"]


def _digests(a_path, b_path, pair_type, batches):
    tok = tokenizers(a_path, b_path)
    width = len(tok.b_sizes)
    for batch in batches:
        for first, texts in byte_slices(large_text(batch.column(1))):
            al = align(texts, tok)
            cuts = np.searchsorted(al.a_last, al.a_offsets)
            groups = np.diff(cuts)
            doc = np.repeat(np.arange(len(texts)), groups)
            span = width * len(tok.a_sizes)
            pairs, times = np.unique(
                doc * span + al.a_ids[al.a_last] * width + al.b_ids[al.b_last], return_counts=True
            )
            ends = np.searchsorted(pairs, np.arange(len(texts) + 1) * span)
            hashes = [
                hashlib.sha256(s.encode()).hexdigest() if s else "" for s in group_strings(al, tok)
            ]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(first, len(texts)),
                    pa.array(np.diff(al.a_offsets)),
                    pa.array(np.diff(al.b_offsets)),
                    pa.array(groups.astype(np.int64)),
                    pa.array(groups.astype(np.int64)),
                    pa.array(hashes, pa.string()),
                    _lists(pairs % span, ends, pair_type),
                    _lists(times, ends, pa.int32()),
                ],
                names=["doc_id", *_COUNTS, "groups_sha256", "pairs", "times"],
            )


def _pair_type(a_path: str, b_path: str) -> tuple[str, pa.DataType, int]:
    tok = tokenizers(a_path, b_path)
    width = len(tok.b_sizes)
    small = width * len(tok.a_sizes) < 1 << 31
    return ("int", pa.int32(), width) if small else ("bigint", pa.int64(), width)


def alignment_digests(
    docs: DataFrame, a_path: str, b_path: str, broadcast_pairs: int = BROADCAST_PAIRS
) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    name, kind, width = _pair_type(a_path, b_path)
    aligned = keep(
        docs.select(F.col("doc_id").cast("long"), "text")
        .mapInArrow(
            partial(_digests, a_path, b_path, kind),
            f"doc_id long, {', '.join(f'{c} long' for c in _COUNTS)}, groups_sha256 string,"
            f" pairs array<{name}>, times array<int>",
        )
        .withColumn("row", F.monotonically_increasing_id()),
        "alignments",
    )
    linked = aligned.select("row", F.inline(F.arrays_zip("pairs", "times"))).toDF(
        "row", "pair", "times"
    )
    counts = linked.groupBy("pair").agg(F.sum("times").alias("n"))
    # the pairs of one B id: one for each A id at most
    highest = F.max("n").over(Window.partitionBy(F.col("pair") % width))
    scores = keep(
        counts.withColumn("best", (F.col("n") == highest).cast("int")), "pair-counts"
    )
    if scores.count() <= broadcast_pairs:
        scores = F.broadcast(scores)
    sums = (
        linked.join(scores, "pair")
        .groupBy("row")
        .agg(
            F.sum(F.col("times") * F.col("best")).alias("n_best"),
            F.sum(F.col("times") * F.col("n")).alias("count_sum"),
        )
    )
    return aligned.join(sums, "row", "left").select(
        "doc_id",
        *_COUNTS,
        *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_best", "count_sum")),
        "groups_sha256",
    )
