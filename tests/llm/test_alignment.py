"""Token alignment against plain encoding and dictionaries of ends."""

import collections
import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

pytest.importorskip("marketlake.llm")

from conftest import SMALL  # noqa: E402

from marketlake.llm import alignment  # noqa: E402
from marketlake.llm.common import table  # noqa: E402

PATHS = [public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "piece_bpe_32k.model")]
COLUMNS = "doc_id n_a n_b n_groups n_links n_best count_sum groups_sha256".split()
BITS = [
    "foo", "bar's", "it's", "1234", " ", "  ", "\n", "\t", "\r\n", "\r", "\x0b", "\u00a0",
    "\u3000", "\u2028", "\u2581", "\u00e9", "\u65e5\u672c", "<|endoftext|>", "<s>", "<0x0A>",
    "\U0001f600", ".", "...", "#$%", "\x1c", "\x00", ";\r", "()", "'", "\u0301", "\ufeff", "/**",
]


@pytest.fixture(scope="module")
def tok():
    return alignment.Tokenizers(*PATHS)


def groups(tok, text):
    """Groups of (A ids, B ids) by plain encoding of the whole text."""
    if not text:
        return []
    whole = (" " + text).encode()
    a = tok.a.encode(" " + text, add_special_tokens=False).ids
    b = tok.b.encode(text)
    joined = [b"".join(tok.a_bytes[i] for i in a), b"".join(tok.b_bytes[i] for i in b)]
    if joined != [whole, whole]:
        return []
    ends = {}
    for side, ids, sizes in ((0, a, tok.a_sizes), (1, b, tok.b_sizes)):
        for at, end in enumerate(np.cumsum(sizes[ids]).tolist()):
            ends.setdefault(end, {})[side] = at
    out, x, y = [], 0, 0
    for _, at in sorted(ends.items()):
        if len(at) == 2:
            out.append((a[x : at[0] + 1], b[y : at[1] + 1]))
            x, y = at[0] + 1, at[1] + 1
    return out


def digest(found):
    text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in found)
    return hashlib.sha256(text.encode()).hexdigest() if text else ""


def expected(tok, rows):
    cut = [(i, groups(tok, t)) for i, t in rows]
    counts = collections.Counter((a[-1], b[-1]) for _, found in cut for a, b in found)
    best = collections.Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    out = collections.Counter()
    for i, found in cut:
        links = [(a[-1], b[-1]) for a, b in found]
        sums = [counts[x] for x in links]
        n_best = sum(counts[x] == best[x[1]] for x in links)
        sizes = [sum(len(g[side]) for g in found) for side in (0, 1)]
        out[(i, *sizes, len(found), len(links), n_best, sum(sums), digest(found))] += 1
    return out


def bag(df):
    return collections.Counter(tuple(r[c] for c in COLUMNS) for r in df.collect())


@pytest.mark.parametrize("broadcast", [alignment.BROADCAST_PAIRS, 0])
def test_documents_equal_brute_force(spark, tok, broadcast):
    docs = table(spark, SMALL, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert bag(alignment.alignment_digests(docs, *PATHS, broadcast)) == expected(tok, rows)


def test_odd_texts(spark, tok, monkeypatch):
    """Mixed white space, marks and special strings; the memory of segments is small."""
    rng = random.Random(5)
    rows = [(i, "".join(rng.choices(BITS, k=rng.randint(0, 12)))) for i in range(3_000)]
    rows += [(None, "null id"), (7, "again"), (7, "again"), (8, None), (9, ""), (10, "x" * 30_000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    monkeypatch.setattr(alignment, "CACHE_SEGMENTS", 10)
    assert bag(alignment.alignment_digests(frame, *PATHS)) == expected(tok, rows)


def test_group_places(spark, tok):
    rows = [(1, "unbelievably tokenised, isn't it?"), (2, None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    for row in alignment.aligned_documents(frame, *PATHS).collect():
        text = dict(rows)[row.doc_id]
        cuts = [(0, 0), *((a + 1, b + 1) for a, b in zip(row.a_last, row.b_last))]
        found = [
            (row.a_ids[a:c], row.b_ids[b:d]) for (a, b), (c, d) in zip(cuts[:-1], cuts[1:])
        ]
        assert found == groups(tok, text)


def test_gallop():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 50, 1_000):
        longer = np.unique(rng.integers(0, 3 * n + 1, n))
        values = rng.integers(-2, 3 * n + 3, 200)
        guesses = rng.integers(-5, n + 5, 200)
        assert (alignment.gallop(values, guesses, longer) == np.searchsorted(longer, values)).all()


def test_overlaps():
    rng = np.random.default_rng(3)
    total = 500
    a, b = (np.append(np.sort(rng.choice(total - 1, n, False)) + 1, total) for n in (60, 140))
    first, last = alignment.overlaps(a, b)
    for i, (x, y) in enumerate(zip(np.append(0, a[:-1]), a)):
        shared = [j for j in range(len(b)) if max(x, b[j - 1] if j else 0) < min(y, b[j])]
        assert (first[i], last[i]) == (shared[0], shared[-1])


def test_empty(spark, tok):
    frame = spark.createDataFrame([], "doc_id long, text string, pairs int, row int")
    assert alignment.alignment_digests(frame, *PATHS).collect() == []
    assert alignment.align(pa.array([], pa.large_string()), tok).a_ids.size == 0
