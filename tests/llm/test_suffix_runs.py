"""Suffix order, common prefixes and earlier copies against brute force."""

import random

import pytest

pytest.importorskip("marketlake.llm")
from marketlake.llm import line_dup, suffix_runs  # noqa: E402


def sequences(rng, kinds, documents, longest):
    found = []
    for _ in range(documents):
        if found and rng.random() < 0.3:  # a passage of an earlier document, or all of it
            other = rng.choice(found)
            a = rng.randint(0, len(other) - 1)
            found.append(other[a:] + [rng.randrange(kinds)] * rng.randint(0, 3))
        else:
            found.append([rng.randrange(kinds) for _ in range(rng.randint(1, longest))])
    return found


def placed(documents):
    rows, first = [], 0
    for ids in documents:
        rows += [(first + i, first, x, -x) for i, x in enumerate(ids)]
        first += len(ids) + 1
    return rows


def several(rows):
    counts = {}
    for r in rows:
        counts[r[2]] = counts.get(r[2], 0) + 1
    return [r for r in rows if counts[r[2]] > 1]


def longest_earlier(rows):
    at = {p: x for p, _, x, _ in rows}
    found = {}
    for p in at:
        for e in at:
            n = 0
            while e + n < p and p + n in at and at.get(e + n) == at[p + n]:
                n += 1
            if e < p and n > found.get(p, 0):
                found[p] = n
    return found


def shared(at, p, q):
    n = 0
    while p + n in at and at.get(q + n) == at[p + n]:
        n += 1
    return n


CASES = [(3, 12, 9), (2, 8, 14), (1, 3, 20), (40, 20, 8)]


@pytest.mark.parametrize("kinds,documents,longest", CASES)
def test_earlier_copies_equal_brute_force(spark, kinds, documents, longest):
    rows = several(placed(sequences(random.Random(kinds), kinds, documents, longest)))
    frame = spark.createDataFrame(rows, "p long, first long, id1 long, id2 long")
    order, rounds = suffix_runs.suffix_order(frame)
    ranks = {r.r: r.p for r in order.collect()}
    assert sorted(ranks) == list(range(len(rows)))
    prefixes = suffix_runs.common_prefixes(order, rounds)
    at = {r[0]: r[2] for r in rows}
    got = {r.r: r.shared for r in prefixes.collect()}
    assert got == {r: shared(at, p, ranks[r - 1]) if r else 0 for r, p in ranks.items()}
    wanted = longest_earlier(rows)
    for size in (1, 4, 1 << 16):  # intervals over many chunks, over some, within one
        found = {r.p: r.n for r in suffix_runs.earlier_copies(prefixes, size).collect()}
        assert found == wanted, size


def test_maximal_copies_of_lines(spark):
    passage = "one two three\nfour five six\n\nseven eight nine ten"
    texts = [
        (1, f"own line a\n{passage}\nx"),
        (2, f"y\n{passage}\nown line b"),
        (3, "\n".join(["again and again"] * 7)),
        (4, passage),
        (4, passage),
        (5, None),
        (6, "four five six\n\nown line c"),
    ]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    runs = line_dup.maximal_copies(line_dup.repeated_lines(frame, 8), size=2).collect()
    # runs of seven equal lines: each later line starts a shorter copy, held by the one before
    assert sorted((r.doc_id, r.line, r.n) for r in runs) == [
        (2, 1, 4),
        (3, 3, 3),
        (3, 4, 3),
        (4, 0, 4),
    ]


def test_no_repeated_lines(spark):
    frame = spark.createDataFrame([(1, "a b"), (2, "c d")], "doc_id long, text string")
    assert line_dup.repeated_runs(frame).count() == 0
    assert line_dup.repeated_runs(frame.limit(0)).count() == 0
