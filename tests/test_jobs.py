"""Graphs, patterns, similarity, files, scaling and models on small fixtures."""

import datetime as dt
import itertools

import numpy as np
import pandas as pd
import pytest
from conftest import SMALL
from pyspark.ml.fpm import PrefixSpan
from pyspark.sql import functions as F

from marketlake.catalog.learning import next_hour
from marketlake.functions import udfs
from marketlake.operators import graph, mining, models, scaling, similarity, stats
from marketlake.operators.ordered import exact_quantiles
from marketlake.plans import layers
from marketlake.session import cut_by_key
from marketlake.sources import files

EDGES = [(1, 2), (2, 3), (3, 1), (3, 4), (4, 5), (7, 8), (8, 9)]


def edges(spark, rows=EDGES):
    return spark.createDataFrame(rows, "src long, dst long")


def test_closure_with_a_cycle(spark):
    got = {tuple(r) for r in graph.transitive_closure(edges(spark)).collect()}
    reach = {(a, b) for a in (1, 2, 3) for b in (1, 2, 3, 4, 5)} | {(4, 5), (7, 8), (7, 9), (8, 9)}
    assert got == reach


def test_components_of_a_long_chain(spark):
    chain = [(i, i + 1) for i in range(200)] + [(1000, 1001)]
    got = {r.id: r.component for r in graph.connected_components(edges(spark, chain)).collect()}
    assert set(got.values()) == {0, 1000} and sum(v == 0 for v in got.values()) == 201


def test_triangle_paths_are_not_rows(spark):
    """A hub of 300 ends over one triangle: 300 paths meet in it, one closes."""
    star = [(0, k) for k in range(1, 301)] + [(1, 2)]
    found = graph.triangle_counts(edges(spark, star))
    plan = found._jdf.queryExecution().toString()
    assert "array_intersect" in plan and "onward" in plan
    assert {r.id: r.triangles for r in found.collect() if r.triangles} == {0: 1, 1: 1, 2: 1}


def test_triangles_against_brute_force(spark):
    rng = np.random.default_rng(5)
    pairs = {tuple(sorted(map(int, p))) for p in rng.integers(0, 30, (160, 2)) if p[0] != p[1]} | {(0, k) for k in range(1, 30)}
    want = dict.fromkeys(range(30), 0)
    for a, b, c in itertools.combinations(range(30), 3):
        if {(a, b), (a, c), (b, c)} <= pairs:
            for v in (a, b, c):
                want[v] += 1
    doubled = [(b, a) for a, b in pairs] + list(pairs)
    got = {r.id: r.triangles for r in graph.triangle_counts(edges(spark, doubled)).collect()}
    assert got == want


def test_triangles_in_rounds_release_their_files(spark, monkeypatch):
    """In seven rounds or more the counts are the same, no round sends more than its share, and
    what earlier steps wrote is gone when the next one has begun."""
    rng = np.random.default_rng(6)
    pairs = [(int(a), int(b)) for a, b in rng.integers(0, 200, (4000, 2))]
    whole = {r.id: r.triangles for r in graph.triangle_counts(edges(spark, pairs)).collect()}
    sent, released = [], []
    closed, release = graph._closed, graph.release
    monkeypatch.setattr(graph, "SENT", 2)
    monkeypatch.setattr(graph, "_closed", lambda ends, step, rounds: sent.append((step, rounds)) or closed(ends, step, rounds))
    monkeypatch.setattr(graph, "release", lambda s: released.append(s) or release(s))
    got = {r.id: r.triangles for r in graph.triangle_counts(edges(spark, pairs)).collect()}
    assert got == whole and sum(got.values()) > 1000
    rounds = sent[0][1]
    assert rounds >= 7 and sent == [(k, rounds) for k in range(rounds)] and len(released) == rounds + 2


def test_power_iteration_equals_matrix_products(spark):
    """Two cliques with a weak tie: the same points however the edges lie, and two clusters."""
    ties = [(a, b, 1.0 + a % 3) for c in (0, 20) for a in range(c, c + 12) for b in range(a + 1, c + 12)] + [(0, 20, 0.01)]
    frames = [spark.createDataFrame(rows, "src long, dst long, weight double") for rows in (ties, ties[::-1])]
    start = {r.id: r.x for r in models.power_iteration(frames[0], 0).collect()}
    ids = sorted(start)
    place = {v: k for k, v in enumerate(ids)}
    w = np.zeros((len(ids), len(ids)))
    for a, b, x in ties:
        w[place[a], place[b]] = w[place[b], place[a]] = x
    want = np.array([start[v] for v in ids])
    for _ in range(5):
        want = w @ want / w.sum(axis=1)
        want /= np.abs(want).mean()
    for frame, n in zip(frames, (1, 5)):
        got = {r.id: r.x for r in models.power_iteration(frame.repartition(n), 5).collect()}
        np.testing.assert_allclose([got[v] for v in ids], want, rtol=1e-9)
        found = models.cluster_graph(frame, 2).collect()
        sides = {c: {r.cluster for r in found if (r.id >= 20) == c} for c in (False, True)}
        assert len(found) == 24 and len(sides[False]) == len(sides[True]) == 1 and sides[False] != sides[True]


def test_rounds_do_not_shuffle_the_edges(spark):
    """Edges are dealt once: in the plan of a round, what is checkpointed as links has no exchange."""
    dealt = cut_by_key(edges(spark, [(k % 50, k) for k in range(2000)]), "src")
    ends = spark.range(50).withColumnRenamed("id", "src").hint("merge")
    joined = dealt.join(ends, "src")
    joined.collect()
    plan = joined._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("Exchange hashpartitioning") == 1


def test_shortest_paths_prefer_cheap_detours(spark):
    df = spark.createDataFrame([(1, 2, 10), (1, 3, 1), (3, 4, 1), (4, 2, 1), (9, 1, 1)], "src long, dst long, weight long")
    got = {r.id: r.distance for r in graph.shortest_paths(df, 1).collect()}
    assert got == {1: 0, 3: 1, 4: 2, 2: 3}


def test_pagerank_reaches_its_fixed_point(spark):
    ranks = {r.id: r["rank"] for r in graph.pagerank(edges(spark), 200, tolerance=1e-9).collect()}
    out = {}
    for a, _ in EDGES:
        out[a] = out.get(a, 0) + 1
    for v in ranks:
        assert abs(ranks[v] - (0.15 + 0.85 * sum(ranks[a] / out[a] for a, b in EDGES if b == v))) < 1e-7


def test_patterns_equal_prefix_span(spark):
    rng = np.random.default_rng(4)
    rows = [(int(w), "abc"[rng.integers(3)], i) for i, w in enumerate(rng.integers(0, 12, 70))]
    df = spark.createDataFrame(rows, "who long, item string, event_id long").withColumn("ts", F.timestamp_seconds("event_id"))
    got = {("".join(r.pattern), r.freq) for r in mining.sequential_patterns(df, 0.4, 3).collect()}
    sequences = df.groupBy("who").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("event_id", "item"))), lambda e: F.array(e["item"])).alias("sequence")
    )
    spans = PrefixSpan(minSupport=0.4, maxPatternLength=3).findFrequentSequentialPatterns(sequences)
    assert got == {("".join(i[0] for i in r.sequence), r.freq) for r in spans.collect()}


def _pattern_events(spark, rows):
    df = spark.createDataFrame([(w, i, k) for k, (w, i) in enumerate(rows)], "who long, item string, event_id long")
    return df.withColumn("ts", F.timestamp_seconds("event_id"))


def test_patterns_of_short_sequences_need_no_join_per_length(spark, monkeypatch):
    """Equal sequences are one row with a count; only long ones are joined item by item."""
    monkeypatch.setattr(mining, "asof_join", None)
    df = _pattern_events(spark, [(w, i) for w in range(40) for i in ("ab" if w % 2 else "aab")])
    got = {("".join(r.pattern), r.length, r.freq) for r in mining.sequential_patterns(df, 0.5).collect()}
    assert got == {("a", 1, 40), ("b", 1, 40), ("ab", 2, 40), ("aa", 2, 20), ("aab", 3, 20)}


def test_patterns_of_short_and_long_sequences_add_up(spark):
    rng = np.random.default_rng(8)
    rows = [(int(w), "abcdx"[rng.integers(5)]) for w in rng.integers(0, 9, 60)]
    # x is rare, nobody's row and a null item hold no pattern; the last one has null items only
    rows = [(w, i) for w, i in rows if i != "x" or w == 3] + [(None, "a"), (4, None), (99, None)]
    sequences = {}
    for w, i in rows:
        if w is not None:
            sequences.setdefault(w, []).append(i)

    def held(pattern, sequence):
        rest = iter(sequence)
        return all(item in rest for item in pattern)

    least, want, grown = max(1, -(-4 * len(sequences) // 10)), {}, [""]
    while grown:
        tries = [(p + i, sum(held(p + i, s) for s in sequences.values())) for p in grown for i in "abcdx"]
        grown = [p for p, n in tries if n >= least]
        want |= {p: n for p, n in tries if n >= least}
    assert max(map(len, want)) >= 3
    for listed in (0, 6, 100):
        found = mining.sequential_patterns(_pattern_events(spark, rows), 0.4, listed=listed)
        assert {"".join(r.pattern): r.freq for r in found.collect()} == want


def test_near_pairs_against_all_pairs(spark):
    rng = np.random.default_rng(6)
    base = rng.normal(size=(40, 8))
    points = np.concatenate([base, base + rng.normal(scale=0.01, size=base.shape), base[:3]])
    pdf = pd.DataFrame({"id": range(len(points)), "v": points.tolist()})
    found = similarity.near_vectors(spark.createDataFrame(pdf), "id", "v", 0.5, width=2.0, tables=6)
    every = {(r.left, r.right) for r in found.collect()}
    # rows 80-82 are copies of 0-2 and are represented by them
    copies = {(0, 80), (1, 81), (2, 82)}
    assert copies <= every
    got = every - copies
    want = {
        (i, j) for i, j in itertools.combinations(range(80), 2) if np.linalg.norm(points[i] - points[j]) < 0.5
    }
    assert got <= want and len(got) >= 0.9 * len(want)
    _, members = similarity.copy_groups(spark.createDataFrame(pdf), "id", "v")
    assert {r.id: r.representative for r in members.collect()}[82] == 2


def test_near_texts_by_min_hash(spark):
    words = [f"w{k}" for k in range(40)]
    rows = [(1, words), (2, words[:-2]), (3, [f"x{k}" for k in range(40)]), (4, list(reversed(words))), (5, [])]
    df = spark.createDataFrame(rows, "id long, tokens array<string>")
    got = {(r.left, r.right, round(r.distance, 3)) for r in similarity.near_texts(df, "id", 0.3).collect()}
    assert got == {(1, 2, 0.05), (1, 4, 0.0)}


def test_sampled_cosines_are_close(spark):
    rng = np.random.default_rng(8)
    df = spark.createDataFrame(pd.DataFrame({"v": rng.random((300, 5)).tolist()}))
    exact = similarity.column_cosines(df, "v")
    assert similarity.mean_error(exact, similarity.sampled_column_cosines(df, "v", 0.1)).first()[0] < 0.05


def test_binary_curve_over_chunks(spark):
    rng = np.random.default_rng(9)
    pdf = pd.DataFrame({"score": rng.integers(0, 200, 2000).astype(float), "label": rng.integers(0, 2, 2000)})
    curve = stats.binary_curve(spark.createDataFrame(pdf), chunk=7).toPandas().set_index("score")
    for s in (0.0, 50.0, 199.0):
        assert curve.loc[s, "tp"] == ((pdf.score >= s) & (pdf.label == 1)).sum()


def test_exact_quantiles(spark):
    values = np.random.default_rng(10).random(501)
    df = spark.createDataFrame(pd.DataFrame({"v": values}))
    np.testing.assert_allclose(exact_quantiles(df, "v", [0, 0.1, 0.5, 0.99, 1]), np.quantile(values, [0, 0.1, 0.5, 0.99, 1]))
    assert exact_quantiles(df.filter("v > 5"), "v", [0.5]) == [None]


def test_constant_columns_scale_to_zero(spark):
    df = spark.createDataFrame([(2.0,), (2.0,)], "v double")
    fit = scaling.fit_columns(df, ["v"])["v"]
    row = df.select(scaling.standard("v", fit).alias("a"), scaling.min_max("v", fit).alias("b"), scaling.max_abs("v", fit).alias("c")).first()
    assert tuple(row) == (0.0, 0.5, 1.0)


def test_index_and_back(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("c",), (None,)], "k string")
    index = scaling.category_index(df, "k")
    assert {r.category: r["index"] for r in index.collect()} == {"b": 0, "a": 1, "c": 2}
    back = scaling.from_index(scaling.indexed(df, "k", index, "i"), "i", index, "again")
    assert all(r.k == r.again for r in back.collect())


def test_buffers_over_many_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")
    try:
        df = spark.range(1000).select(F.when(F.col("id") < 700, "hot").otherwise("cold").alias("k"), F.col("id").cast("double").alias("v"))
        got = {r.k: r.mean for r in udfs.moments(df, "k", "v").collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    assert got == {"hot": 349.5, "cold": 849.5}


def test_training_beats_guessing_and_forecasts_are_stored(spark, root):
    split = F.lit("2024-01-20").cast("timestamp")
    train, test = models.split_by_time(next_hour(spark, SMALL), "timestamp", split)
    scored = models.regress(train.filter("label > 0"), test, "linear")
    assert not scored.filter("label IS NULL AND prediction IS NOT NULL").isEmpty()
    assert models.regression_metrics(scored.filter("label IS NOT NULL"))["rmse"] > 0
    layers.store_forecasts(root, scored, dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc))
    assert layers.forecasts_of(spark, root, "view").count() == scored.filter("symbol = 'view'").count()
    labelled = spark.range(200).select(
        F.array(F.col("id") / 200.0, F.lit(1.0)).alias("v"), (F.col("id") > 100).cast("double").alias("label")
    )
    vectors = models.as_vectors(labelled, "v")
    found = models.classification_metrics(models.classify(vectors, vectors, "logistic", regParam=0.0))
    assert found["accuracy"] > 0.95 and found["area_roc"] > 0.95
    assert models.training_history(vectors)[-1] < models.training_history(vectors)[0]


def test_file_options(spark, tmp_path):
    box = tmp_path / "files"
    (box / "deep").mkdir(parents=True)
    (box / "a.csv").write_text('name;note\nx;"two\nlines"\n')
    (box / "deep" / "b.csv").write_text("name;note\ny;z\n")
    (box / "skip.txt").write_text("no")
    read = files.ingest(spark, str(box), "csv", glob="*.csv", recursive=True, sep=";", multiLine="true")
    assert sorted(r.note for r in read.collect()) == ["two\nlines", "z"]
    assert files.ingest(spark, str(box), "csv", schema="name string, note string", glob="*.csv", modified_after="2999-01-01T00:00:00", sep=";").count() == 0
    good = str(tmp_path / "good")
    spark.range(5).coalesce(1).write.parquet(good)
    (tmp_path / "good" / "broken.parquet").write_text("not parquet")
    assert files.ingest(spark, good, "parquet", schema="id long", skip_corrupt_files=True).count() == 5


def test_schema_merge_and_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    files.export(spark.range(3).withColumn("p", F.lit("a")), path, "parquet", partition_by=["p"])
    files.export(spark.range(2).withColumns({"p": F.lit("b"), "more": F.lit(1)}), path, "parquet", "append", partition_by=["p"])
    rows = files.ingest(spark, path, "parquet", merge_schema=True)
    assert set(rows.columns) == {"id", "p", "more"} and rows.filter("p = 'b' AND more = 1").count() == 2
    table = files.external_table(spark, "ext_t", path, "parquet", "id BIGINT, more INT, p STRING", ["p"])
    assert table.count() == 5
    files.load_into(spark.sql("SELECT 9L AS id, 2 AS more, 'c' AS p"), "ext_t")
    assert spark.table("ext_t").filter("p = 'c'").count() == 1
    managed = files.managed_table(spark.range(4), "managed_t")
    assert managed.count() == 4
    assert spark.table(files.temp_view(managed, "v1")).count() == 4
    assert spark.newSession().table(files.temp_view(managed, "v2", everywhere=True)).count() == 4


def test_bucketed_join_needs_no_shuffle(spark, tmp_path):
    for name in ("left_b", "right_b"):
        df = spark.range(1000).withColumn("v", F.col("id") * 2)
        files.save_bucketed(df, name, str(tmp_path / name), ["id"], 4, ["id"])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = spark.table("left_b").join(spark.table("right_b"), "id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and joined.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_buckets_grow_with_the_tables(spark):
    from marketlake.sources import files

    assert files.bucket_count(spark.range(10), spark.range(1000)) == 8
    assert files.bucket_count(spark.range(10), spark.range(1001), least=1, rows=100) == 11


def test_news_texts_stay_out_of_the_join_on_symbols(spark):
    import __spark_entry__ as driver

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = driver.queries()["news_by_symbol"](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    joined = plan.index("Join LeftSemi")
    assert "Aggregate [symbol" in plan[joined : plan.index("Generate", joined)]


def test_recommended_parts_are_the_best_of_all(spark):
    import numpy as np

    import __spark_entry__ as driver
    from conftest import SMALL
    from marketlake.catalog import learning
    from marketlake.operators import models
    from marketlake.session import cut_lineage

    model = models.factor_model(cut_lineage(learning._part_ratings(spark, SMALL)))
    users, items = (
        {r.id: np.array(r.features) for r in x.collect()} for x in (model.userFactors, model.itemFactors)
    )
    table = np.stack(list(items.values()))
    found = {}
    for r in driver.queries()["recommend_parts"](spark, SMALL).collect():
        found.setdefault(r.user, {})[r.place] = r.score
    assert found.keys() == users.keys()
    for user, places in found.items():
        best = np.sort(table @ users[user])[::-1][:5]
        assert np.allclose([places[k] for k in range(1, 6)], best, atol=1e-4)


def test_word_vectors_stay_rows_and_tell_topics_apart(spark):
    """Texts of two kinds in many blocks; texts without words, null and a single word too."""
    import numpy as np

    from marketlake.operators import skipgrams, text

    draw = np.random.default_rng(1)
    kinds = [[f"{k}{i}" for i in range(40)] for k in "ab"]
    rows = [(i, [str(w) for w in draw.choice(kinds[i % 2], 30)]) for i in range(600)]
    rows += [(600, []), (601, None), (602, ["alone"])]
    tokens = spark.createDataFrame(rows, "doc_id long, tokens array<string>")
    for rounds in (1, 3):
        found = {r.doc_id: np.array(r.vector) for r in text.word_vectors(tokens, 8, rounds, block=100).collect()}
        assert found.keys() == {r[0] for r in rows}
        assert not found[600].any() and not found[601].any()
        start = skipgrams._start(["alone"], 8)[0]
        assert np.allclose(found[602], start, atol=0.05) and all(v.shape == (8,) for v in found.values())
    table = np.stack([found[i] for i in range(600)])
    unit = table / np.linalg.norm(table, axis=1, keepdims=True)
    likeness = unit @ unit.T
    assert likeness[::2, ::2].mean() > likeness[::2, 1::2].mean() + 0.2


def test_word_vectors_leave_the_vocabulary_on_the_executors(spark):
    """As many words again must not grow what the driver fetches."""
    from unittest import mock

    from pyspark.ml.feature import Word2Vec

    from marketlake.operators import text

    tokens = spark.range(400).selectExpr("id AS doc_id", "transform(sequence(1, 50), i -> concat('w', id * 50 + i)) AS tokens")
    with mock.patch.object(Word2Vec, "fit", side_effect=AssertionError("the vocabulary on the driver")):
        vectors = text.word_vectors(tokens)
        assert vectors.count() == 400


def test_largest_inner_products_equal_brute_force(spark, monkeypatch):
    """In many blocks, with copies, users without a direction, and fewer items than places."""
    import numpy as np

    from marketlake.operators import inner_products

    draw = np.random.default_rng(1)
    monkeypatch.setattr(inner_products, "FIRST", 50)
    users = np.vstack([draw.normal(size=(297, 4)), np.zeros((1, 4)), np.ones((2, 4))]).astype(np.float32)
    for count in (700, 3):
        items = (draw.normal(size=(count, 4)) * draw.uniform(0.1, 3, (count, 1))).astype(np.float32)
        items[: count // 10] = items[count // 2]
        frames = [
            spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(t)], "id int, features array<float>")
            for t in (users, items)
        ]
        found = {}
        for r in inner_products.largest(*frames, 5, block=64).collect():
            assert np.isclose(users[r.user] @ items[r.item], r.score, atol=1e-4)
            found.setdefault(r.user, {}).setdefault(r.place, (r.item, r.score))
        for user, vector in enumerate(users):
            best = np.sort(items @ vector)[::-1][:5]
            places = found[user]
            assert len({item for item, _ in places.values()}) == len(best)
            assert np.allclose([places[k + 1][1] for k in range(len(best))], best, atol=1e-4)


def test_recommendations_do_not_score_every_pair(spark, monkeypatch):
    from pyspark.ml.recommendation import ALSModel

    import __spark_entry__ as driver

    def all_pairs(*_):
        raise AssertionError("every user against every item")

    monkeypatch.setattr(ALSModel, "recommendForAllUsers", all_pairs)
    assert not driver.queries()["recommend_parts"](spark, SMALL).isEmpty()


def test_frequent_sets_of_any_length_equal_counting(spark, monkeypatch):
    from itertools import combinations

    import numpy as np
    from pyspark.ml import fpm

    from marketlake.operators import mining

    def tree(*_):
        raise AssertionError("a tree that takes each basket by itself")

    monkeypatch.setattr(fpm.FPGrowth, "fit", tree)
    draw = np.random.default_rng(1)
    baskets = [sorted(set(draw.choice(list("abcdefgh"), draw.integers(1, 7)).tolist())) for _ in range(200)]
    rows = [(i, x) for i, b in enumerate(baskets) for x in [*b, b[0]]] + [(999, None)]
    frame = spark.createDataFrame(rows, "basket int, item string")
    sets, rules = mining.frequent_sets(frame, 0.02, 0.3)
    want = {}
    for b in baskets:
        for k in range(1, len(b) + 1):
            for c in combinations(b, k):
                want[c] = want.get(c, 0) + 1
    want = {c: n for c, n in want.items() if n >= np.ceil(0.02 * 201)}
    assert {tuple(r["items"]): r.freq for r in sets.collect()} == want and max(map(len, want)) > 3
    sure = {
        (tuple(x for x in c if x != y), (y,)): n / want[tuple(x for x in c if x != y)]
        for c, n in want.items() if len(c) > 1 for y in c
    }
    assert {(tuple(r.antecedent), tuple(r.consequent)): r.confidence for r in rules.collect()} == {
        k: v for k, v in sure.items() if v >= 0.3
    }


def test_term_weights_are_joined_without_sorting_the_counts(spark):
    import __spark_entry__ as driver

    plan = driver.queries()["term_weights"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
