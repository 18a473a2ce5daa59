"""Skip-gram vectors with negative sampling, trained on one block of documents at a time."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

VECTORS = "block long, word string, vector array<float>"
REACH, RATE, NEGATIVES = 5, 0.025, 5
STEP, DRAWN = 2048, 64  # tokens a step, and the words drawn against all of them
MOST = 64


def _flat(rows: pa.Table) -> tuple[list[str], np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words, the word of each token, its document's place, documents in order of id."""
    rows = rows.sort_by("doc_id")
    texts = rows.column("words").combine_chunks()
    lists = pc.split_pattern(texts, " ")
    flat = lists.flatten()
    coded = flat.filter(pc.not_equal(flat, "")).dictionary_encode()
    lengths = np.diff(lists.offsets.to_numpy()) * pc.not_equal(texts, "").to_numpy(zero_copy_only=False)
    place = np.repeat(np.arange(len(lengths)), lengths)
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(), place, rows.column("doc_id")


def _start(words: list[str], size: int) -> np.ndarray:
    """Small vectors that follow from the word alone, so that all blocks start alike."""
    state = np.array([zlib.crc32(w.encode()) for w in words], np.uint64)[:, None]
    state = (state << np.uint64(8)) + np.arange(1, size + 1, dtype=np.uint64)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        state = (state ^ (state >> np.uint64(shift))) * np.uint64(factor)
    unit = (state >> np.uint64(11)).astype(np.float64) / 2**53
    return ((unit - 0.5) / size).astype(np.float32)


def _known(held: pa.Table, words: list[str], width: int) -> np.ndarray:
    """Rows of ``held`` in the order of ``words``."""
    at = {w: i for i, w in enumerate(held.column("word").to_pylist())}
    flat = held.column("vector").combine_chunks().flatten().to_numpy()
    return flat.reshape(-1, width)[[at[w] for w in words]]


def _add(table: np.ndarray, ids: np.ndarray, grads: np.ndarray, uses: np.ndarray) -> None:
    """Add the sums by word; a word met very often in one step counts as met ``MOST`` times,
    as all its pairs are taken at the vectors before the step."""
    order = np.argsort(ids, kind="stable")
    ids = ids[order]
    first = np.flatnonzero(np.r_[True, ids[1:] != ids[:-1]])
    share = np.minimum(1, MOST / np.maximum(np.add.reduceat(uses[order], first), 1))
    table[ids[first]] += np.add.reduceat(grads[order], first, axis=0) * share.astype(np.float32)[:, None]


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-x))


def _learn(ids: np.ndarray, place: np.ndarray, inner: np.ndarray, outer: np.ndarray, seed: int) -> None:
    """One pass: each word against its neighbours, and against words drawn by count^0.75."""
    draw = np.random.default_rng(seed)
    odds = np.cumsum(np.bincount(ids, minlength=len(inner)) ** 0.75)
    reach = draw.integers(1, REACH + 1, len(ids))
    for at in range(0, len(ids), STEP):
        rate = np.float32(RATE * max(1 - at / len(ids), 1e-4))
        now, doc, wide = ids[at : at + STEP], place[at : at + STEP], reach[at : at + STEP]
        word, near = inner[now], outer[now]
        to_word, to_near = np.zeros_like(word), np.zeros_like(near)
        pairs, met = np.zeros(len(now), np.float32), np.zeros(len(now), np.float32)
        for d in range(1, min(REACH, len(now) - 1) + 1):
            same = doc[d:] == doc[:-d]
            for centre, other in ((slice(None, -d), slice(d, None)), (slice(d, None), slice(None, -d))):
                used = same & (wide[centre] >= d)
                pull = used * (1 - _sigmoid(np.einsum("ij,ij->i", word[centre], near[other])))
                to_word[centre] += pull[:, None] * near[other]
                to_near[other] += pull[:, None] * word[centre]
                pairs[centre] += used
                met[other] += used
        others = np.minimum(np.searchsorted(odds, draw.random(DRAWN) * odds[-1], side="right"), len(inner) - 1)
        away = outer[others]
        push = _sigmoid(word @ away.T) * (pairs * np.float32(NEGATIVES / DRAWN))[:, None]
        to_word -= push @ away
        drawn = np.full(DRAWN, pairs.sum() * NEGATIVES / DRAWN, np.float32)
        _add(inner, now, rate * to_word, pairs * (1 + NEGATIVES))
        _add(outer, np.r_[now, others], rate * np.r_[to_near, -(push.T @ word)], np.r_[met, drawn])


def _vectors(rows: np.ndarray) -> pa.ListArray:
    ends = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(ends, pa.array(rows.ravel()))


def _train(held: pa.Table | None, rows: pa.Table, size: int, seed: int, last: bool) -> pa.Table:
    words, ids, place, _ = _flat(rows)
    if held is None:
        inner, outer = _start(words, size), np.zeros((len(words), size), np.float32)
    else:
        inner, outer = (x.copy() for x in np.hsplit(_known(held, words, 2 * size), 2))
    block = rows.column("block")[0].as_py()
    if words:
        _learn(ids, place, inner, outer, seed + block)
    found = {"block": pa.array([block] * len(words), pa.int64()), "word": pa.array(words, pa.string())}
    return pa.table(found | {"vector": _vectors(inner if last else np.hstack([inner, outer]))})


def _means(held: pa.Table, rows: pa.Table, size: int) -> pa.Table:
    words, ids, place, docs = _flat(rows)
    inner = _known(held, words, size).astype(np.float64)
    sums = np.stack([np.bincount(place, inner[ids, k], len(docs)) for k in range(size)], 1)
    uses = np.maximum(np.bincount(place, minlength=len(docs)), 1)
    return pa.table({"doc_id": docs, "vector": _vectors(sums / uses[:, None])})


def training(size: int, seed: int, last: bool):
    """(block, word, vector) after a round: of documents alone, and of held vectors with their
    documents.  A vector has two halves, as a word and as a neighbour; the last round leaves the first."""

    def first(rows: pa.Table) -> pa.Table:
        return _train(None, rows, size, seed, last)

    def later(held: pa.Table, rows: pa.Table) -> pa.Table:
        return _train(held, rows, size, seed, last)

    return first, later


def document_means(size: int):
    """(doc_id, vector) of a block: mean over a document's tokens; zeros where there is none."""

    def means(held: pa.Table, rows: pa.Table) -> pa.Table:
        return _means(held, rows, size)

    return means
