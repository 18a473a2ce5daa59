import datetime as dt

import duckdb
import numpy as np
import pandas as pd
import pytest
from conftest import SMALL
from oracle import differences
from pyspark.sql import Row
from pyspark.sql import functions as F

import __spark_entry__ as driver
from marketlake.operators.sessions import sessions
from marketlake.sources.lake import LakeTable
from marketlake.streaming import jobs, late, online, stateful

SCHEMA = "event_id long, ts timestamp, user_id long, event_type string, value double"


def land(spark, folder, rows):
    rows = [(i, dt.datetime.fromtimestamp(s, dt.timezone.utc), u, e, v) for i, s, u, e, v in rows]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def test_late_rows_behind_the_watermark_are_dropped(spark, tmp_path):
    box, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))

    def run():
        stream = jobs.word_windows(jobs.file_stream(spark, box, SCHEMA), "event_type", "10 seconds", "10 seconds", "5 seconds")
        jobs.append_files(stream, out, cp)

    land(spark, box, [(1, 1, 1, "a", 0.0), (2, 100, 1, "a", 0.0)])
    run()
    land(spark, box, [(3, 2, 1, "a", 0.0), (4, 101, 1, "a", 0.0), (5, 300, 1, "a", 0.0)])
    run()
    rows = {r.start.second + 60 * r.start.minute: r.n for r in spark.read.parquet(out).collect()}
    assert rows == {0: 1, 100: 2}


def test_stream_word_counts_restart_equals_batch(spark, tmp_path):
    box, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    for line in ("a b a", "b c"):
        spark.createDataFrame([(line,)], "text string").write.mode("append").parquet(box)
        counts = jobs.word_counts(jobs.file_stream(spark, box, "text string"))
        jobs.run_available(counts, jobs.replace_table(out), cp, "complete")
    assert {r.word: r.n for r in spark.read.parquet(out).collect()} == {"a": 2, "b": 2, "c": 1}


def test_running_counts_start_from_the_seed(spark, tmp_path):
    box, cp = str(tmp_path / "in"), str(tmp_path / "cp")
    table = LakeTable(str(tmp_path / "out"), ("word",))
    seed = spark.createDataFrame([("a", 10), ("z", 1)], "word string, n long")
    for words in (["a", "b"], ["a"]):
        spark.createDataFrame([(w,) for w in words], "word string").write.mode("append").parquet(box)
        stream = stateful.running_counts(jobs.file_stream(spark, box, "word string"), seed)
        jobs.run_available(stream, jobs.upsert_into(table), cp, "update")
    assert {r.word: r.n for r in table.read(spark).collect()} == {"a": 12, "b": 1}


def test_closing_sessions_equal_batch_sessions(spark, tmp_path):
    events = spark.read.parquet(f"{SMALL}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    box, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    flush = events.groupBy("user_id").agg(F.lit(-1).cast("long").alias("event_id"))
    slim = events.select("event_id", "ts", "user_id", "event_type", "value")
    slim.write.parquet(box)
    jobs.append_files(stateful.closing_sessions(jobs.file_stream(spark, box, SCHEMA), 7200, "purchase"), out, cp)
    # one far event moves the watermark past every open session
    late = [(10**9, 1_800_000_000, 10**6, "view", 0.0)]
    land(spark, box, late)
    jobs.append_files(stateful.closing_sessions(jobs.file_stream(spark, box, SCHEMA), 7200, "purchase"), out, cp)
    got = sorted((r.user_id, r.first, r.last, r.events, r.closed) for r in spark.read.parquet(out).collect() if r.user_id != 10**6)
    batch = sessions(slim, "user_id", 7200, F.col("event_type") == "purchase")
    want = batch.select(
        "user_id", F.unix_millis("start").alias("a"), F.unix_millis("end").alias("b"), "events", "closed"
    ).collect()
    assert got == sorted(tuple(r) for r in want) and flush.count() > 0


class _OneKey:
    """A handle and a value state in one: what a session processor holds of a key."""

    def __init__(self):
        self.held, self.timers = None, []

    def getValueState(self, name, schema):
        return self

    def get(self):
        return self.held

    def update(self, value):
        self.held = value

    def clear(self):
        self.held = None

    def registerTimer(self, at):
        self.timers.append(at)

    def deleteTimer(self, at):
        self.timers.remove(at)


def test_closing_sessions_keep_one_timer_without_listing_them():
    key, job = _OneKey(), stateful._ClosingSession(100)
    job.init(key)

    def batch(*events):
        rows = iter([Row(user_id=7, event_id=i, closes=closes, ms=ms) for i, (ms, closes) in enumerate(events)])
        return [tuple(r)[1:] for r in job.handleInputRows((7,), rows, None)]

    assert batch((50, None), (10, False)) == [] and (key.held, key.timers) == ((10, 50, 2), [150])
    assert batch((40, False)) == [] and (key.held, key.timers) == ((10, 50, 3), [150])
    assert batch((149, False)) == [] and (key.held, key.timers) == ((10, 149, 4), [249])
    assert batch((249, False)) == [(10, 149, 4, False)] and (key.held, key.timers) == ((249, 249, 1), [349])
    assert batch((260, True)) == [(249, 260, 2, True)] and (key.held, key.timers) == (None, [])
    assert batch((270, True), (280, False)) == [(270, 270, 1, True)] and key.timers == [380]
    assert [tuple(r) for r in job.handleExpiredTimer((7,), None, None)] == [(7, 280, 280, 1, False)]
    assert key.held is None


def test_excluded_words_counters(spark, tmp_path):
    box, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    spark.createDataFrame([(w,) for w in "a b a c".split()], "word string").write.parquet(box)
    excluded = spark.createDataFrame([("a",), ("a",)], "word string")
    jobs.run_available(jobs.file_stream(spark, box, "word string"), jobs.without_excluded(out, excluded), cp)
    assert {r.word: r.n for r in spark.read.parquet(f"{out}/counts").collect()} == {"b": 1, "c": 1}
    counters = spark.read.parquet(f"{out}/counters").first()
    assert (counters.seen, counters.dropped) == (4, 2)


def test_stream_sessions_hold_back_open_ones(spark, tmp_path):
    box, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    land(spark, box, [(1, 0, 1, "a", 0.0), (2, 10, 1, "a", 0.0), (3, 1000, 1, "a", 0.0)])
    jobs.append_files(jobs.session_windows(jobs.file_stream(spark, box, SCHEMA), "user_id", "60 seconds", "1 second"), out, cp)
    assert [(r.events, r.seconds) for r in spark.read.parquet(out).collect()] == [(2, 70.0)]


def test_active_users_counts_each_user_once(spark, tmp_path):
    box, out, cp = (str(tmp_path / n) for n in ("in", "out", "cp"))
    land(spark, box, [(1, 0, 1, "a", 0.0), (2, 1, 1, "a", 0.0), (3, 1, 2, "a", 0.0), (4, 500, 9, "a", 0.0)])
    jobs.append_files(jobs.active_users(jobs.file_stream(spark, box, SCHEMA), "1 second"), out, cp)
    found = {int(r.start.replace(tzinfo=dt.timezone.utc).timestamp()): r.users for r in spark.read.parquet(out).collect()}
    assert found[0] == 2 and max(found.values()) == 2


def vectors(spark, pdf):
    return spark.createDataFrame(pdf)


def test_online_kmeans_finds_the_centres_and_replays(spark, tmp_path):
    rng = np.random.default_rng(0)
    points = np.concatenate([rng.normal(0, 0.1, (200, 2)), rng.normal(5, 0.1, (200, 2))])
    batch = vectors(spark, pd.DataFrame({"features": points.tolist()}))
    path = str(tmp_path / "state")
    model = online.OnlineKMeans([[1.0, 1.0], [4.0, 4.0]], path=path)
    model(batch, 0)
    first = model.centres.copy()
    np.testing.assert_allclose(first, [points[:200].mean(0), points[200:].mean(0)])
    model(batch, 1)
    again = online.OnlineKMeans([[1.0, 1.0], [4.0, 4.0]], path=path)
    again(batch, 1)
    np.testing.assert_allclose(again.centres, model.centres)
    np.testing.assert_allclose(again.weights, [400, 400])


@pytest.mark.parametrize("kind", ["linear", "logistic"])
def test_online_linear_models_learn(spark, kind):
    rng = np.random.default_rng(1)
    x = np.column_stack([np.ones(500), rng.normal(size=500)])
    score = x @ np.array([0.5, 2.0])
    y = score if kind == "linear" else (score > 0).astype(float)
    batch = vectors(spark, pd.DataFrame({"features": x.tolist(), "label": y}))
    model = online.OnlineLinear(2, kind, step=0.5, rounds=15)
    for k in range(2):
        model(batch, k)
    if kind == "linear":
        np.testing.assert_allclose(model.weights, [0.5, 2.0], atol=0.1)
    else:
        assert ((model.predict(x) > 0.5) == (y == 1)).mean() > 0.95


def test_running_significance(spark):
    rng = np.random.default_rng(2)

    def batch(shift):
        a = pd.DataFrame({"arm": 0, "value": rng.normal(0, 1, 200)})
        b = pd.DataFrame({"arm": 1, "value": rng.normal(shift, 1, 200)})
        return spark.createDataFrame(pd.concat([a, b]))

    test = online.RunningTest()
    test(batch(0.0), 0)
    assert not test.done
    test(batch(1.0), 1)
    assert test.done and test.p_value < 0.001
    for t, freedom, p in ((2.0, 10, 0.0733880), (12.706205, 1, 0.05), (1.959964, 1e7, 0.05)):
        assert abs(online.t_test_p_value(t, freedom) - p) < 1e-5


# --- late rows, initial state, state read back ---------------------------------------------


def _at(seconds):
    return dt.datetime.fromtimestamp(seconds, dt.timezone.utc)


def test_windows_keep_late_rows_aside(spark, tmp_path):
    box, cp = str(tmp_path / "in"), str(tmp_path / "cp")
    sink = late.WindowTotals(str(tmp_path / "out"), "event_type", "10 seconds", "10 seconds", "5 seconds")

    def run(*rows):
        land(spark, box, rows)
        jobs.run_available(jobs.file_stream(spark, box, SCHEMA), sink, cp)

    run((1, 1, 1, "a", 0.0), (2, 100, 1, "a", 0.0))
    run((3, 2, 1, "a", 0.0), (4, 101, 1, "a", 0.0), (5, 93, 1, "a", 0.0), (6, 300, 1, "a", 0.0))
    start = F.unix_seconds("start").alias("start")
    counted = {r.start: r.n for r in sink.table.read(spark).select(start, "n").collect()}
    assert counted == {0: 1, 100: 2, 90: 1, 300: 1}
    aside = sink.late(spark).select("event_id", start, "batch").collect()
    assert [tuple(r) for r in aside] == [(3, 0, 1)]
    # a replayed batch changes nothing
    before = sink.table.state(spark)
    sink(spark.createDataFrame([(9, _at(100), 1, "a", 0.0)], SCHEMA), 1)
    assert sink.table.state(spark) == before and sink.late(spark).count() == 1


def test_sessions_keep_late_rows_aside(spark, tmp_path):
    sink = late.SessionTotals(str(tmp_path), "user_id", "10 seconds", "5 seconds")

    def batch(n, *rows):
        sink(spark.createDataFrame([(i, _at(s), u, "a", 0.0) for i, s, u in rows], SCHEMA), n)

    batch(0, (1, 0, 1), (2, 4, 1), (3, 30, 1), (4, 0, 2))
    batch(1, (5, 1, 1), (6, 38, 1), (7, 22, 1), (8, 60, 2))
    batch(2, (9, 16, 1), (10, 47, 1), (11, 200, 3))
    start, end = F.unix_seconds("start").alias("start"), F.unix_seconds("end").alias("end")
    found = sink.closed.read(spark).select("user_id", start, end, "events").collect()
    # the row at 47 is not late, but the session up to 38 has been closed
    want = [(1, 0, 4, 2), (1, 22, 38, 3), (1, 47, 47, 1), (2, 0, 0, 1), (2, 60, 60, 1)]
    assert sorted(map(tuple, found)) == want
    assert [(r.user_id, r.events) for r in sink.open.read(spark).collect()] == [(3, 1)]
    assert sorted((r.event_id, r.batch) for r in sink.late(spark).collect()) == [(5, 1), (9, 2)]


def test_late_and_counted_rows_add_up(spark, tmp_path):
    """The given events in eight batches, in no order of time."""
    events = spark.read.parquet(f"{SMALL}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    events = events.select("event_id", "ts", "user_id", "event_type", "value")
    windows = late.WindowTotals(str(tmp_path / "w"), "event_type", "1 hour", "1 hour", "2 days")
    users = late.SessionTotals(str(tmp_path / "s"), "user_id", "30 minutes", "2 days")
    for n in range(4):
        part = events.filter(F.pmod(F.xxhash64("event_id"), F.lit(2)) == n % 2).filter(
            (F.dayofmonth("ts") >= 15) == (n // 2 == 0)
        )
        windows(part, n)
        users(part, n)
    total = events.count()
    assert windows.table.read(spark).agg(F.sum("n")).first()[0] + windows.late(spark).count() == total
    held = [users.open.read(spark), users.closed.read(spark)]
    assert sum(t.agg(F.sum("events")).first()[0] or 0 for t in held) + users.late(spark).count() == total
    assert windows.late(spark).count() > 0 and users.late(spark).count() > 0


def test_seeded_counts_live_in_the_state(spark, tmp_path):
    box, cp = str(tmp_path / "in"), str(tmp_path / "cp")
    table = LakeTable(str(tmp_path / "out"), ("word",))
    seed = spark.createDataFrame([("a", 10), ("z", 1), ("z", 2)], "word string, n long")
    for words in (["a", "b", None], ["a", "a"]):
        spark.createDataFrame([(w,) for w in words], "word string").write.mode("append").parquet(box)
        stream = stateful.seeded_counts(jobs.file_stream(spark, box, "word string"), seed)
        jobs.run_available(stream, jobs.upsert_into(table), cp, "update")
    assert {r.word: r.n for r in table.read(spark).collect()} == {"a": 13, "b": 1}
    state = stateful.stored_state(spark, cp, "total").select("word", "value.n").collect()
    assert {r.word: r.n for r in state} == {"a": 13, "b": 1, "z": 3}


def test_items_last_seen_are_a_map(spark, tmp_path):
    box, cp, out = (str(tmp_path / n) for n in ("in", "cp", "out"))
    table = LakeTable(out, ("user_id",))
    for rows in ([(1, 5, 1, "a", 0.0), (2, 9, 1, "b", 0.0), (3, 1, 2, "a", 0.0)], [(4, 7, 1, "a", 0.0), (5, 2, 1, "c", 0.0)]):
        land(spark, box, rows)
        stream = stateful.items_last_seen(jobs.file_stream(spark, box, SCHEMA), "event_type", "7 days")
        # with a clock of its own, such a query never comes to an end by itself
        jobs.start(stream, jobs.upsert_into(table), cp, "update", once=True).awaitTermination(60)
    got = {r.user_id: (r.items, r.newest) for r in table.read(spark).collect()}
    assert got == {1: (3, 9000), 2: (1, 1000)}
    state = stateful.stored_state(spark, cp, "seen")
    seen = {(r.user_id, r.user_map_key.item): r.user_map_value["value"].ms if "value" in r.user_map_value.asDict() else r.user_map_value.ms for r in state.collect()}
    assert seen == {(1, "a"): 7000, (1, "b"): 9000, (1, "c"): 2000, (2, "a"): 1000}


@pytest.mark.parametrize("name", ["stream_word_counts", "stream_sentiment", "stream_excluded_words", "stream_page_counts"])
def test_streams_read_tables_of_many_files(spark, tmp_path, name):
    for table in ("conversations", "documents", "labels", "benchmark", "events"):
        rows = spark.read.parquet(f"{SMALL}/{table}.parquet")
        rows.repartition(3).write.parquet(str(tmp_path / f"{table}.parquet"))
    run = driver.queries()[name]
    whole = run(spark, SMALL)
    parts = run(spark, str(tmp_path))
    assert sorted(map(tuple, parts.collect())) == sorted(map(tuple, whole.collect())) != []


def test_online_kmeans_of_midway_points_equals_sql(spark, tmp_path):
    rows = spark.read.parquet(f"{SMALL}/events.parquet")
    midway = rows.withColumn("value", F.when(F.col("event_id") % 10 == 0, 55.0).otherwise(F.col("value")))
    midway.coalesce(1).write.parquet(str(tmp_path / "events.parquet"))
    name = "stream_online_kmeans"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
    assert differences(driver.queries()[name](spark, str(tmp_path)), con, driver.oracle_sql()[name]) is None
