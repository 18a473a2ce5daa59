"""Near pairs against all pairs: recall, work, exact distances, hot buckets."""

import itertools
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest

from marketlake.operators import near_pairs, similarity


def frame(spark, rows, start=0):
    return spark.createDataFrame(pd.DataFrame({"id": range(start, start + len(rows)), "row": list(map(list, rows))}))


def exact(points, within):
    i, j = np.triu_indices(len(points), 1)
    d = np.sqrt(((points[i] - points[j]) ** 2).sum(axis=1))
    return {(int(a), int(b)): x for a, b, x in zip(i, j, d) if x <= within}


def planted(rng, n=3_000, near=600, width=64, shift=0.3):
    base = rng.normal(size=(n, width)) / np.sqrt(width)
    step = rng.normal(size=(near, width))
    step *= (rng.uniform(0.2, 1.0, near) * shift / np.linalg.norm(step, axis=1))[:, None]
    return np.concatenate([base, base[:near] + step])


def test_recall_and_work_on_vectors(spark):
    points = planted(np.random.default_rng(1))
    want = exact(points, 0.3)
    rows = frame(spark, points)
    n, typical = similarity.typical_distance(rows)
    assert n == len(points) and abs(typical - np.sqrt(2)) < 0.1
    plan = near_pairs.plan_projection(n, 0.3, typical)
    keys = near_pairs.keyed(rows, "projection", plan)
    sizes = [r.n for r in near_pairs.buckets(keys).collect()]
    assert sum(m * (m - 1) // 2 for m in sizes) < 0.05 * n * (n - 1) / 2
    found = {(r.left, r.right): r.distance for r in near_pairs.near_pairs(keys, "projection", 0.3).collect()}
    assert found.keys() <= want.keys() and len(found) >= 0.95 * len(want)
    assert all(abs(d - want[p]) < 1e-12 for p, d in found.items())


def test_recall_and_work_on_sets(spark):
    rng = np.random.default_rng(2)
    base = [rng.choice(1 << 40, 60, replace=False) for _ in range(800)]
    for s in base[:200]:  # similarity of a copy with k other items: (60 - k) / (60 + k)
        other = s.copy()
        k = int(rng.integers(1, 13))
        other[:k] = rng.choice(1 << 40, k)
        base.append(other)
    want = {}
    sets = [set(s.tolist()) for s in base]
    for i, j in itertools.chain(zip(range(200), range(800, 1000))):
        d = 1 - len(sets[i] & sets[j]) / len(sets[i] | sets[j])
        if d <= 0.4:
            want[(i, j)] = d
    rows = frame(spark, base)
    plan = near_pairs.plan_min_hash(len(base), 0.4)
    keys = near_pairs.keyed(rows, "min_hash", plan)
    sizes = [r.n for r in near_pairs.buckets(keys).collect()]
    assert sum(m * (m - 1) // 2 for m in sizes) < 0.05 * 1000 * 999 / 2
    found = {(r.left, r.right): r.distance for r in near_pairs.near_pairs(keys, "min_hash", 0.4).collect()}
    assert found.keys() <= want.keys() and len(found) >= 0.95 * len(want)
    assert all(abs(d - want[p]) < 1e-12 for p, d in found.items())


def test_a_hot_bucket_is_dealt_in_blocks(spark):
    """Half of all rows are near each other: every pair is found, once, by many pieces of work."""
    rng = np.random.default_rng(3)
    close = np.full((120, 8), 0.5) + rng.normal(size=(120, 8)) * 1e-3
    points = np.concatenate([close, rng.normal(size=(120, 8)) * 5])
    keys = near_pairs.keyed(frame(spark, points), "projection", near_pairs.Plan(2, 6, 1.0))
    found = near_pairs.near_pairs(keys, "projection", 0.2, block=16).collect()
    pairs = [(r.left, r.right) for r in found]
    assert len(pairs) == len(set(pairs))
    assert set(pairs) == exact(points, 0.2).keys()
    work = near_pairs._dealt(keys, 16).groupBy("table", "bucket", "x", "y").count()
    assert work.agg({"count": "max"}).first()[0] <= 4 * 16


def test_plans():
    assert abs(near_pairs.collision(1e9) - 1) < 1e-6 and near_pairs.collision(0) == 0
    # by simulation
    rng = np.random.default_rng(4)
    gap = np.abs(rng.standard_normal(200_000))
    assert abs(np.maximum(0, 1 - gap / 1.7).mean() - near_pairs.collision(1.7)) < 5e-3
    for rows in (10, 10**4, 10**7):
        plan = near_pairs.plan_projection(rows, 0.4, 1.41)
        near = near_pairs.collision(plan.width / 0.4) ** plan.hashes
        assert 1 - (1 - near) ** plan.tables >= 0.99
    assert near_pairs.plan_projection(10**7, 0.4, 1.41).hashes > near_pairs.plan_projection(10, 0.4, 1.41).hashes
    with pytest.raises(ValueError):
        near_pairs.plan_min_hash(10, 0.999)


def test_cases(spark):
    empty = spark.createDataFrame([], "id long, v array<float>")
    assert similarity.near_vectors(empty, "id", "v", 0.5).collect() == []
    rows = [(1, [0.0, 1.0]), (2, [0.0, 1.0]), (3, None), (4, [9.0, 1.0]), (5, [0.0, 1.1])]
    found = similarity.near_vectors(spark.createDataFrame(rows, "id long, v array<float>"), "id", "v", 0.5)
    assert {(r.left, r.right): round(r.distance, 6) for r in found.collect()} == {(1, 2): 0.0, (1, 5): 0.1}
    no_texts = spark.createDataFrame([], "id long, tokens array<string>")
    assert similarity.near_texts(no_texts, "id", 0.5).collect() == []


def test_sketches_are_dealt_and_bound_all_near_pairs(spark):
    points = planted(np.random.default_rng(7), n=300, near=100) * 50
    keys = near_pairs.keyed(frame(spark, points), "projection", near_pairs.Plan(1, 2, 100.0))
    assert not {"row", "keys"} & set(near_pairs._dealt(keys, 16).columns)
    sketches = [bytes(r.sketch) for r in near_pairs.sketched(keys, "projection").orderBy("id").collect()]
    assert len(sketches[0]) == 16 + 64
    every = np.arange(len(points))
    likely = near_pairs._vector_bound(sketches, 15.0)(every, every)
    want = exact(points, 15.0)
    assert want and all(likely[a, b] for a, b in want)
    assert np.triu(likely, 1).sum() < len(want) + 20


def test_all_copies_pair_with_each_other_and_with_what_is_near(spark, monkeypatch):
    """Rows 0 to 5 are copies, 6 and 7 are copies near them; 8 is far, 9 comes twice, 10 has no
    key of its own but 6's vector."""
    monkeypatch.setattr(similarity, "_BLOCK", 2)
    rows = [(k, [1.0, 0.0]) for k in range(6)] + [(6, [1.0, 0.1]), (7, [1.0, 0.1]), (8, [9.0, 0.0])]
    rows += [(9, [5.0, 0.0]), (9, [5.0, 0.0]), (6, [9.0, 0.2]), (None, [1.0, 0.1])]
    found = similarity.near_vectors(
        spark.createDataFrame(rows, "id long, v array<double>"), "id", "v", 0.5, recall=0.9999, all_copies=True
    )
    want = sorted(
        (a[0], b[0], round(float(np.hypot(*np.subtract(a[1], b[1]))), 6))
        for a, b in itertools.product(rows, rows)
        if None not in (a[0], b[0]) and a[0] < b[0] and np.hypot(*np.subtract(a[1], b[1])) <= 0.5
    )
    assert sorted((r.left, r.right, round(r.distance, 6)) for r in found.collect()) == want


def test_sketches_of_sets_bound_all_near_pairs():
    rng = np.random.default_rng(8)
    sets = [rng.choice(1 << 40, int(rng.integers(1, 200)), replace=False) for _ in range(150)]
    sets += [np.concatenate([s[: len(s) * 3 // 4], rng.choice(1 << 40, len(s) // 4)]) for s in sets]
    batch = pa.RecordBatch.from_pydict({"id": range(300), "row": sets, "keys": [[0]] * 300})
    sketches = next(near_pairs._set_sketches([batch])).column(1).to_pylist()
    i, j = np.triu_indices(300, 1)
    likely = near_pairs._set_bound(sketches, 0.5)(np.arange(300), np.arange(300))[i, j]
    likely &= near_pairs._set_overlap(sketches, 0.5)(i, j)
    both = np.array([len(np.intersect1d(sets[a], sets[b])) for a, b in zip(i, j)])
    near = 1 - both / (np.array([len(sets[a]) + len(sets[b]) for a, b in zip(i, j)]) - both) <= 0.5
    assert near.sum() > 100 and likely[near].all() and likely.sum() < near.sum() + 0.01 * len(i)


def test_few_tables_compare_rows_where_they_lie(spark):
    """One bucket of all rows: no sketches or pairs are sent, and the pairs are the same; a key
    that comes twice has each of its rows compared."""
    points = planted(np.random.default_rng(9), n=900, near=200)
    keys = near_pairs.keyed(frame(spark, points), "projection", near_pairs.Plan(1, 1, 1e9))
    found = near_pairs.near_pairs(keys, "projection", 0.3, block=64, tables=1)
    # the only join is that of rows and bucket sizes
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Join") == 1
    want = exact(points, 0.3)
    got = {(r.left, r.right): r.distance for r in found.collect()}
    assert got.keys() == want.keys() and all(abs(d - want[p]) < 1e-12 for p, d in got.items())
    rows = [(1, [0.0, 0.1]), (1, [0.0, 0.1]), (2, [0.0, 0.3])]
    twice = near_pairs.keyed(spark.createDataFrame(rows, "id long, row array<double>"), "projection", near_pairs.Plan(1, 1, 1e9))
    both = [sorted((r.left, r.right) for r in near_pairs.near_pairs(twice, "projection", 0.5, tables=t).collect()) for t in (1, None)]
    assert both[0] == both[1] == [(1, 1)] * 4 + [(1, 2)] * 2


def test_a_row_goes_once_to_a_place_and_sets_are_not_kept(spark):
    """Sixty texts that are all near each other: their sets are sent 60 times to one place, not
    once or twice for each of the 1,770 pairs."""
    words = [f"w{k}" for k in range(40)]
    rows = [(k, words + [f"x{k}"]) for k in range(60)] + [(100, words + ["x0"]), (101, ["other"])]
    tokens = spark.createDataFrame(rows, "doc_id long, tokens array<string>")
    found = {(r.left, r.right): r.distance for r in similarity.near_texts(tokens, "doc_id", 0.5).collect()}
    assert found.keys() == {*itertools.combinations(range(60), 2), (0, 100)} and found[0, 100] == 0
    sets = spark.createDataFrame([(k, [*range(40), 100 + k]) for k in range(60)], "id long, row array<long>")
    keys = near_pairs.keyed(sets, "min_hash", near_pairs.Plan(1, 4))
    sketches = near_pairs.sketched(keys, "min_hash")
    dealt = near_pairs._gathered(near_pairs._dealt(sketches, 2048).join(sketches.select("id", "sketch", "keys"), "id"))
    wanted = dealt.mapInArrow(partial(near_pairs._wanted, 0.5, True), "place long, id long, others array<long>").collect()
    assert sum(len(r.others) for r in wanted) <= 1770 and len(wanted) <= 4 * 60


def test_texts_without_tokens_and_keys(spark):
    rows = [(1, ["a", "b", "c"]), (2, ["a", "b", "c", "d"]), (3, None), (4, []), (None, ["a", "b", "c"]), (2, []), (2, None), (5, ["z"])]
    found = similarity.near_texts(spark.createDataFrame(rows, "doc_id long, tokens array<string>"), "doc_id", 0.5)
    assert [(r.left, r.right, r.distance) for r in found.collect()] == [(1, 2, 0.25)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("transform") == 1 and "LeftSemi" in plan
