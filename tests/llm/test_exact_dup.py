"""Exact deduplication against equal texts, with full and with very weak fingerprints."""

import collections
import hashlib

import numpy as np
import pytest

pytest.importorskip("marketlake.llm")

from marketlake.llm import exact_dup  # noqa: E402

TEXTS = [None, "", "a", "b", "a\0", "\0a", "ab" * 5_000, "ab" * 4_999 + "aa", "é" * 700, "é" * 700 + " "]
ROWS = [(i, TEXTS[i % len(TEXTS)]) for i in range(37)]
ROWS += [(None, "a"), (None, "only without id"), (None, "only without id"), (33, "b"), (33, "b")]


def expected(rows):
    groups = collections.defaultdict(list)
    for i, text in rows:
        groups[text or ""].append(i)

    def keep_id(text):
        return max((i for i in groups[text] if i is not None), default=None)

    return collections.Counter(
        (i, keep_id(t or ""), len(groups[t or ""]), hashlib.sha256((t or "").encode()).hexdigest())
        for i, t in rows
    )


def checked(rows, found):
    found = [r.asDict() for r in found]
    assert expected(rows) == collections.Counter(
        (r["doc_id"], r["keep_id"], r["group_size"], r["text_sha256"]) for r in found
    )
    stays = [r for r in found if r["kept"]]
    assert len({r["text_sha256"] for r in stays}) == len(stays) == len({t or "" for _, t in rows})
    assert all(r["doc_id"] == r["keep_id"] for r in stays)


@pytest.mark.parametrize("piece", [64 << 10, 1_000, 1_024])
def test_equal_texts(spark, piece):
    frame = spark.createDataFrame(ROWS, "doc_id long, text string").withColumnRenamed("x", "y")
    checked(ROWS, exact_dup.exact_duplicates(frame.repartition(5), piece).collect())


def test_collisions_are_split(spark, monkeypatch):
    """Fingerprints of two values: nearly every class holds unlike texts of one length."""
    monkeypatch.setattr(
        exact_dup, "_packed", lambda h: [(h[0] % 2).alias("fp1"), (h[0] * 0).alias("fp2")]
    )
    rows = [(i, f"{i % 7}{'x' * (i % 3)}{i % 5}") for i in range(120)] + ROWS
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    checked(rows, exact_dup.exact_duplicates(frame, 3).collect())


def test_hashes_of_parts_add_up():
    """A text's hash is the polynomial, however the text is cut."""
    rng = np.random.default_rng(1)
    data = rng.integers(0, 256, 5_000, dtype=np.uint8)
    value = [0] * exact_dup.POINTS
    for byte in data[::-1].tolist():
        value = [
            (v * int(b) + byte) % exact_dup.PRIME for v, b in zip(value, exact_dup._points())
        ]
    for cuts in ([0, 5_000], [0, 1, 1, 2_047, 5_000], [0, 1_024, 2_048, 4_999, 5_000]):
        offsets = np.array(cuts)
        parts = exact_dup.hash_pieces(data, offsets, offsets[:-1])
        assert (parts.sum(axis=0) % exact_dup.PRIME).tolist() == value


def test_documents_that_stay(spark):
    rows = [(i, t, f"s{i}", "z") for i, t in ROWS]
    frame = spark.createDataFrame(rows, "doc_id long, text string, fp1 string, _digest string")
    left = exact_dup.without_exact_duplicates(frame)
    assert left.columns == frame.columns
    texts = [r.text or "" for r in left.collect()]
    assert sorted(texts) == sorted({t or "" for _, t in ROWS})


def test_empty(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert exact_dup.exact_duplicates(frame).collect() == []
    assert exact_dup.without_exact_duplicates(frame).collect() == []
