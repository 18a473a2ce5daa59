"""Streaming jobs run to the end of what is there, compared with batch answers."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from marketlake.catalog import views as V
from marketlake.catalog.entry import Book, millis, rounded, sql6
from marketlake.catalog.events import _DURATION, _ISLANDS, _windows
from marketlake.catalog.market import BAR_SQL
from marketlake.catalog.texts import _LEXICON
from marketlake.operators import clicks, text
from marketlake.plans import tables
from marketlake.session import scratch_path
from marketlake.sources import adapters
from marketlake.sources.lake import LakeTable, hash_bucket
from marketlake.sources.tables import driver_table
from marketlake.streaming import jobs, late, online, stateful
from marketlake.streaming.router import Router, message_stream

book = Book()
_AT = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)
_EVENTS = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE"


def _event_stream(spark, sf):
    driver_table(spark, sf, "events")  # pins the session's settings
    rows = jobs.table_stream(spark, sf, "events", _EVENTS)
    return rows.withColumn("ts", F.col("ts").cast("timestamp"))


def _text_stream(spark, sf, table):
    driver_table(spark, sf, table)
    return jobs.table_stream(spark, sf, table, "text STRING")


@book.add(
    "stream_ingest",
    V.with_views(V.TICKS, V.bars()) + f"SELECT symbol, epoch_ms(ts) AS timestamp, {BAR_SQL} FROM bars",
)
def stream_ingest(spark, sf):
    """Bars as JSON messages, through the router, into the bronze price table."""
    root = scratch_path(spark, "stream-ingest")
    adapters.price_messages(spark, sf).write.parquet(f"{root}/inbox")
    router = Router(root, adapters.NEWS_SYMBOLS, _AT)
    stream = message_stream(spark, "parquet", {}, f"{root}/inbox")
    router.start(stream, f"{root}/checkpoint", availableNow=True).awaitTermination()
    bars = tables.price_table(root, "bronze").read(spark).drop("day", "updated_at")
    return rounded(bars, "volume_weighted")


@book.add(
    "stream_word_counts",
    r"SELECT word, count(*) AS n FROM (SELECT unnest(regexp_split_to_array(text, '[ \n]')) AS word FROM conversations) GROUP BY word",
)
def stream_word_counts(spark, sf):
    root = scratch_path(spark, "stream-words")
    counts = jobs.word_counts(_text_stream(spark, sf, "conversations"))
    jobs.run_available(counts, jobs.replace_table(f"{root}/out"), f"{root}/checkpoint", "complete")
    return spark.read.parquet(f"{root}/out")


@book.add(
    "stream_word_windows",
    _windows(600, 300) + 'SELECT start, "end", event_type AS word, count(*) AS n FROM windowed GROUP BY ALL',
)
def stream_word_windows(spark, sf):
    """Changed windows of each batch replace their older versions."""
    root = scratch_path(spark, "stream-windows")
    counts = jobs.word_windows(_event_stream(spark, sf), "event_type", "10 minutes", "5 minutes", "1 hour")
    table = LakeTable(f"{root}/out", ("start", "word"), {"day": F.to_date("start")})
    jobs.run_available(counts, jobs.upsert_into(table), f"{root}/checkpoint", "update")
    return millis(table.read(spark), "start", "end").select("start", "end", "word", "n")


@book.add(
    "stream_sentiment",
    f"""WITH {_LEXICON},
counts AS (SELECT word, count(*) AS n FROM (
  SELECT unnest(regexp_split_to_array(text, '[ \\n]')) AS word FROM conversations) GROUP BY word)
SELECT word, n, score * n AS sentiment FROM counts JOIN lexicon USING (word)""",
)
def stream_sentiment(spark, sf):
    root = scratch_path(spark, "stream-sentiment")
    docs = driver_table(spark, sf, "documents").select("doc_id", "text")
    # computed once, then static for every batch
    text.quality_lexicon(docs, driver_table(spark, sf, "labels")).write.parquet(f"{root}/lexicon")
    lexicon = spark.read.parquet(f"{root}/lexicon")
    scored = jobs.sentiment(_text_stream(spark, sf, "conversations"), lexicon)
    jobs.run_available(scored, jobs.replace_table(f"{root}/out"), f"{root}/checkpoint", "complete")
    return spark.read.parquet(f"{root}/out")


@book.add(
    "stream_error_rates",
    _windows(30, 2, "(SELECT e.*, c_nationkey AS area FROM events e JOIN customer ON user_id = c_custkey)")
    + f"""SELECT start, "end", area, {sql6("avg(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END)")} AS error_rate,
  count(*) AS views, avg(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) > 0.05 AS alert
FROM windowed GROUP BY start, "end", area""",
)
def stream_error_rates(spark, sf):
    root = scratch_path(spark, "stream-errors")
    areas = driver_table(spark, sf, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_nationkey").alias("area")
    )
    rates = jobs.error_rates(_event_stream(spark, sf), areas, "1 hour")
    table = LakeTable(f"{root}/out", ("start", "area"), {"day": F.to_date("start")})
    jobs.run_available(rates, jobs.upsert_into(table), f"{root}/checkpoint", "update")
    out = millis(table.read(spark), "start", "end").drop("day", "updated_at")
    return rounded(out, "error_rate")


@book.add(
    "stream_excluded_words",
    r"""WITH w AS (SELECT unnest(regexp_split_to_array(text, '[ \n]')) AS word FROM conversations),
x AS (SELECT word FROM (SELECT unnest(regexp_split_to_array(text, '[ \n]')) AS word FROM benchmark) GROUP BY word)
SELECT 'kept' AS kind, count(*) AS n FROM w WHERE word NOT IN (SELECT word FROM x)
UNION ALL SELECT 'dropped', count(*) FROM w WHERE word IN (SELECT word FROM x)""",
)
def stream_excluded_words(spark, sf):
    """Words of the benchmark are excluded; the counters must add up."""
    root = scratch_path(spark, "stream-excluded")
    excluded = driver_table(spark, sf, "benchmark").select(F.explode(F.split("text", "[ \n]")).alias("word"))
    words = _text_stream(spark, sf, "conversations").select(F.explode(F.split("text", "[ \n]")).alias("word"))
    jobs.run_available(words, jobs.without_excluded(f"{root}/out", excluded), f"{root}/checkpoint")
    kept = spark.read.parquet(f"{root}/out/counts").agg(F.sum("n").alias("n")).select(F.lit("kept").alias("kind"), "n")
    dropped = spark.read.parquet(f"{root}/out/counters").agg(F.sum("dropped").alias("n"))
    return kept.union(dropped.select(F.lit("dropped").alias("kind"), "n"))


@book.add("stream_sql_per_batch", "SELECT event_type, count(*) AS n, max(value) AS high FROM events GROUP BY 1")
def stream_sql_per_batch(spark, sf):
    root = scratch_path(spark, "stream-sql")
    statement = "SELECT event_type, count(*) AS n, max(value) AS high FROM batch_rows GROUP BY event_type"
    jobs.run_available(_event_stream(spark, sf), jobs.sql_over_batch(f"{root}/out", statement), f"{root}/checkpoint")
    parts = spark.read.parquet(f"{root}/out")
    return parts.groupBy("event_type").agg(F.sum("n").alias("n"), F.max("high").alias("high"))


@book.add(
    "stream_running_counts",
    """SELECT word, n + s AS n FROM (SELECT event_type AS word, count(*) AS n FROM events GROUP BY 1)
JOIN (SELECT event_type AS word, count(DISTINCT user_id) AS s FROM events GROUP BY 1) USING (word)""",
)
def stream_running_counts(spark, sf):
    """Counts that start from a seed: the number of users of each event type."""
    root = scratch_path(spark, "stream-running")
    seed = driver_table(spark, sf, "events").groupBy(F.col("event_type").alias("word")).agg(
        F.count_distinct("user_id").alias("n")
    )
    words = _event_stream(spark, sf).select(F.col("event_type").alias("word"))
    table = LakeTable(f"{root}/out", ("word",), {"bucket": hash_bucket("word", buckets=4)})
    counts = stateful.running_counts(words, seed)
    jobs.run_available(counts, jobs.upsert_into(table), f"{root}/checkpoint", "update")
    return table.read(spark).select("word", "n")


def _upserted(spark, name, frame, keys):
    """The newest version of every row of an update-mode stream."""
    root = scratch_path(spark, name)
    table = LakeTable(f"{root}/out", keys, {"bucket": hash_bucket(*keys, buckets=4)})
    jobs.run_available(frame, jobs.upsert_into(table), f"{root}/checkpoint", "update")
    return table.read(spark).drop("bucket", "updated_at")


@book.add("stream_page_counts", "SELECT event_type, count(*) AS views FROM events GROUP BY 1")
def stream_page_counts(spark, sf):
    return _upserted(spark, "stream-pages", clicks.page_counts(_event_stream(spark, sf)), ("event_type",))


@book.add(
    "stream_sliding_page_counts",
    _windows(10, 2) + 'SELECT start, "end", event_type, count(*) AS views FROM windowed GROUP BY ALL',
)
def stream_sliding_page_counts(spark, sf):
    counts = clicks.sliding_page_counts(_event_stream(spark, sf).withWatermark("ts", "1 hour"))
    return millis(_upserted(spark, "stream-sliding", counts, ("start", "event_type")), "start", "end")


@book.add(
    "stream_active_users",
    _windows(15, 2)
    + """SELECT start, "end", count(DISTINCT user_id) AS users FROM windowed
WHERE "end" <= (SELECT epoch_ms(max(ts)) - 3600000 FROM events) GROUP BY ALL""",
)
def stream_active_users(spark, sf):
    """Windows that the watermark, an hour behind the newest event, has closed."""
    root = scratch_path(spark, "stream-active")
    jobs.append_files(jobs.active_users(_event_stream(spark, sf), "1 hour"), f"{root}/out", f"{root}/checkpoint")
    return millis(spark.read.parquet(f"{root}/out"), "start", "end")


@book.add(
    "stream_known_users",
    """SELECT user_id, c_name AS name, count(*) AS views FROM events
JOIN customer ON user_id = c_custkey GROUP BY ALL""",
)
def stream_known_users(spark, sf):
    users = driver_table(spark, sf, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name")
    )
    seen = clicks.known_users_seen(_event_stream(spark, sf), users)
    return _upserted(spark, "stream-known", seen, ("user_id",))


@book.add(
    "stream_session_windows",
    """SELECT user_id, start, "end" + 1800000 AS "end", ("end" + 1800000 - start) / 1000 AS seconds, events FROM ("""
    + _ISLANDS.format(gap=1800 * 10**6, close="", duration=_DURATION, closed="FALSE")
    + """) WHERE "end" + 1800000 <= (SELECT epoch_ms(max(ts)) - 10000 FROM events)""",
)
def stream_session_windows(spark, sf):
    """Sessions the watermark has closed; the last ones stay open."""
    root = scratch_path(spark, "stream-sessions")
    found = jobs.session_windows(_event_stream(spark, sf), "user_id", "30 minutes", "10 seconds")
    jobs.append_files(found, f"{root}/out", f"{root}/checkpoint")
    return millis(spark.read.parquet(f"{root}/out"), "start", "end")


@book.add(
    "stream_closing_sessions",
    """SELECT user_id, start AS first, "end" AS last, events, closed FROM ("""
    + _ISLANDS.format(
        gap=86400 * 10**6,
        close="OR prev_type = 'purchase'",
        duration=_DURATION,
        closed="bool_or(event_type = 'purchase')",
    )
    + """) WHERE closed OR "end" + 86400000 <= (SELECT epoch_ms(max(ts)) - 10000 FROM events)""",
)
def stream_closing_sessions(spark, sf):
    root = scratch_path(spark, "stream-closing")
    found = stateful.closing_sessions(_event_stream(spark, sf), 86400, "purchase")
    jobs.append_files(found, f"{root}/out", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/out")


# --- rows in any order, and what is left in the state ------------------------------------


def _unsorted_files(spark, sf, name, files=4):
    """The events in files that follow no order of time: the later half of the month first."""
    root = scratch_path(spark, name)
    events = driver_table(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    half = F.when(F.dayofmonth("ts") >= 15, F.lit(0)).otherwise(F.lit(1))
    part = half * (files // 2) + F.pmod(F.xxhash64("event_id"), F.lit(files // 2))
    rows = events.select("event_id", "ts", "user_id", "event_type", "value", part.alias("part"))
    for n in range(files):
        rows.filter(F.col("part") == n).drop("part").coalesce(1).write.mode("append").parquet(f"{root}/inbox")
    return root


_TIMED = _EVENTS.replace("TIMESTAMP_NTZ", "TIMESTAMP")


def _one_file_a_batch(spark, root):
    return jobs.file_stream(spark, f"{root}/inbox", _TIMED, maxFilesPerTrigger="1")


@book.add(
    "stream_windows_with_late",
    _windows(600, 300)
    + """SELECT start, "end", event_type AS word, count(*) AS n, TRUE AS some_were_late FROM windowed GROUP BY ALL""",
)
def stream_windows_with_late(spark, sf):
    """Windows counted in time plus those of rows set aside as late: the batch answer."""
    root = _unsorted_files(spark, sf, "stream-late-windows")
    sink = late.WindowTotals(f"{root}/out", "event_type", "10 minutes", "5 minutes", "1 hour")
    jobs.run_available(_one_file_a_batch(spark, root), sink, f"{root}/checkpoint")
    aside = sink.late(spark)
    some = F.lit(aside.count() > 0).alias("some_were_late")
    missed = aside.groupBy("start", "end", "event_type").agg(F.count(F.lit(1)).alias("n"))
    counted = sink.table.read(spark).select("start", "end", "event_type", "n")
    total = counted.union(missed).groupBy("start", "end", F.col("event_type").alias("word"))
    return millis(total.agg(F.sum("n").alias("n")), "start", "end").withColumn("some_were_late", some)


@book.add(
    "stream_sessions_with_late",
    "SELECT user_id, count(*) AS events, TRUE AS some_were_late FROM events GROUP BY 1",
)
def stream_sessions_with_late(spark, sf):
    """Events in closed and open sessions, plus those set aside as late: all of a user's."""
    root = _unsorted_files(spark, sf, "stream-late-sessions")
    sink = late.SessionTotals(f"{root}/out", "user_id", "30 minutes", "1 day")
    jobs.run_available(_one_file_a_batch(spark, root), sink, f"{root}/checkpoint")
    aside = sink.late(spark)
    some = F.lit(aside.count() > 0).alias("some_were_late")
    held = sink.closed.read(spark).select("user_id", "events").union(
        sink.open.read(spark).select("user_id", "events")
    )
    every = held.union(aside.select("user_id", F.lit(1).cast("long")))
    return every.groupBy("user_id").agg(F.sum("events").alias("events")).withColumn("some_were_late", some)


@book.add(
    "stream_seeded_state",
    """SELECT event_type AS word, count(*) + 1000 AS n FROM events GROUP BY 1
UNION ALL SELECT 'never seen', 7""",
)
def stream_seeded_state(spark, sf):
    """Counts on top of an initial state, over a restart, read from the state itself."""
    root = _unsorted_files(spark, sf, "stream-seeded", files=2)
    seed = driver_table(spark, sf, "events").select(F.col("event_type").alias("word")).distinct()
    seed = seed.withColumn("n", F.lit(1000)).union(spark.createDataFrame([("never seen", 7)], "word string, n int"))
    for _ in range(2):  # the second start finds nothing new and the same state
        words = _one_file_a_batch(spark, root).select(F.col("event_type").alias("word"))
        counts = stateful.seeded_counts(words, seed)
        jobs.run_available(counts, jobs.replace_table(f"{root}/out"), f"{root}/checkpoint", "update")
    state = stateful.stored_state(spark, f"{root}/checkpoint", "total")
    return state.select("word", F.col("value.n").alias("n"))


@book.add(
    "stream_open_sessions",
    """SELECT user_id, start AS first, "end" AS last, events FROM ("""
    + _ISLANDS.format(
        gap=86400 * 10**6,
        close="OR prev_type = 'purchase'",
        duration=_DURATION,
        closed="bool_or(event_type = 'purchase')",
    )
    + """) WHERE NOT closed AND "end" + 86400000 > (SELECT epoch_ms(max(ts)) - 10000 FROM events)""",
)
def stream_open_sessions(spark, sf):
    """Sessions that are still open when the stream stops, read from the state."""
    root = scratch_path(spark, "stream-open")
    found = stateful.closing_sessions(_event_stream(spark, sf), 86400, "purchase")
    jobs.append_files(found, f"{root}/out", f"{root}/checkpoint")
    state = stateful.stored_state(spark, f"{root}/checkpoint", "open")
    return state.select("user_id", "value.first", "value.last", "value.events")


# --- models and a test that learn from the stream -----------------------------------------


def _learnt(spark, name, stream, model_of):
    """Run a model over the stream and read its state back from where it keeps it."""
    root = scratch_path(spark, name)
    model = model_of(f"{root}/state")
    jobs.run_available(stream, model, f"{root}/checkpoint")
    return model.kept.after(spark, model.kept.last)


@book.add(
    "stream_online_kmeans",
    f"""SELECT CASE WHEN value < 55 THEN 0 ELSE 1 END AS cluster, count(*) AS n, {sql6("avg(value)")} AS centre
FROM events GROUP BY 1""",
)
def stream_online_kmeans(spark, sf):
    """Centres that begin at 10 and 100 and move to the mean of the points nearest to them."""
    points = _event_stream(spark, sf).select(F.array("value").alias("features"))
    state = _learnt(
        spark, "stream-kmeans", points, lambda path: online.OnlineKMeans([[10.0], [100.0]], path=path)
    )
    rows = [(k, int(n), float(c[0])) for k, (n, c) in enumerate(zip(state["weights"], state["centres"]))]
    return rounded(spark.createDataFrame(rows, "cluster int, n long, centre double"), "centre")


_STEPS, _RATE = 20, 0.5


@book.add(
    "stream_online_linear",
    f"""WITH RECURSIVE rows AS (SELECT value / 100 AS x, CAST(json_extract_string(props, '$.k') AS DOUBLE) / 10 AS y FROM events),
sums AS (SELECT avg(x) AS x, avg(x * x) AS xx, avg(y) AS y, avg(x * y) AS xy FROM rows),
steps AS (
  SELECT 1 AS turn, CAST(0 AS DOUBLE) AS a, CAST(0 AS DOUBLE) AS b
  UNION ALL
  SELECT turn + 1, a - {_RATE} / sqrt(turn) * (a + b * x - y), b - {_RATE} / sqrt(turn) * (a * x + b * xx - xy)
  FROM steps, sums WHERE turn <= {_STEPS})
SELECT {sql6("a")} AS intercept, {sql6("b")} AS slope FROM steps WHERE turn = {_STEPS} + 1""",
)
def stream_online_linear(spark, sf):
    """Weights after the gradient steps of the one batch that the events come in."""
    driver_table(spark, sf, "events")
    stream = jobs.table_stream(spark, sf, "events", _EVENTS + ", props STRING")
    number = F.get_json_object("props", "$.k").cast("double") / 10
    rows = stream.select(
        F.array(F.lit(1.0), F.col("value") / 100).alias("features"), number.alias("label")
    )
    state = _learnt(
        spark, "stream-linear", rows,
        lambda path: online.OnlineLinear(2, "linear", step=_RATE, rounds=_STEPS, path=path),
    )
    found = spark.createDataFrame([tuple(state["weights"])], "intercept double, slope double")
    return rounded(found, "intercept", "slope")


@book.add(
    "stream_online_logistic",
    "SELECT TRUE AS steps_down, TRUE AS sign_is_right",
)
def stream_online_logistic(spark, sf):
    """Events above a value against the others: the loss falls below that of a coin, and the
    weight of the value is positive."""
    labelled = _event_stream(spark, sf).select(
        F.array(F.lit(1.0), F.col("value") / 100).alias("features"),
        (F.col("value") > 40).cast("double").alias("label"),
    )
    state = _learnt(
        spark, "stream-logistic", labelled,
        lambda path: online.OnlineLinear(2, "logistic", step=1.0, rounds=15, path=path),
    )
    a, b = state["weights"]
    events = driver_table(spark, sf, "events")
    chance = 1 / (1 + F.exp(-(F.lit(a) + F.lit(b) * F.col("value") / 100)))
    loss = F.avg(-F.when(F.col("value") > 40, F.log(chance)).otherwise(F.log(1 - chance)))
    return events.agg((loss < 0.6931).alias("steps_down"), F.lit(b > 0).alias("sign_is_right"))


@book.add(
    "stream_running_test",
    f"""WITH arms AS (SELECT user_id % 2 AS arm, count(value) AS n, avg(value) AS mean, var_samp(value) AS var FROM events GROUP BY 1),
sides AS (SELECT a.n AS n0, b.n AS n1, a.mean AS m0, b.mean AS m1, (a.mean - b.mean) / sqrt(a.var / a.n + b.var / b.n) AS t
  FROM arms a JOIN arms b ON a.arm = 0 AND b.arm = 1)
SELECT n0, n1, {sql6("m0")} AS mean0, {sql6("m1")} AS mean1, abs(t) > 1.9602 AS significant FROM sides""",
)
def stream_running_test(spark, sf):
    """Even against odd users: what the test holds of both arms, and its verdict."""
    rows = _event_stream(spark, sf).select((F.col("user_id") % 2).alias("arm"), "value")
    held = {}

    def test_at(path):
        held["test"] = online.RunningTest(path=path)
        return held["test"]

    state = _learnt(spark, "stream-test", rows, test_at)
    arms = state["batches"][-1]
    (n0, t0, _), (n1, t1, _) = arms["0"], arms["1"]
    found = [(int(n0), int(n1), t0 / n0, t1 / n1, bool(held["test"].done))]
    return rounded(
        spark.createDataFrame(found, "n0 long, n1 long, mean0 double, mean1 double, significant boolean"),
        "mean0", "mean1",
    )
