"""User functions, file round trips, and the lake merge."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from marketlake.catalog import views as V
from marketlake.catalog.entry import Book, millis, rounded, sql6
from marketlake.functions import udfs
from marketlake.operators.bars import build_bars
from marketlake.plans import tables
from marketlake.session import cut_lineage, scratch_path
from marketlake.sources import adapters, files
from marketlake.sources.lake import LakeTable, day_of
from marketlake.sources.tables import driver_table

book = Book()


def _events(spark, sf):
    return driver_table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")


# --- user functions -------------------------------------------------------------------


@book.add("udaf_mean", f"SELECT event_type, {sql6('avg(value)')} AS result FROM events GROUP BY 1")
def udaf_mean(spark, sf):
    found = udfs.moments(_events(spark, sf), "event_type", "value")
    return rounded(found.select("event_type", F.col("mean").alias("result")), "result")


@book.add(
    "udaf_moments",
    f"""SELECT event_type, count(value) AS n, {sql6("avg(value)")} AS mean, {sql6("stddev_pop(value)")} AS deviation
FROM events GROUP BY 1""",
)
def udaf_moments(spark, sf):
    return rounded(udfs.moments(_events(spark, sf), "event_type", "value"), "mean", "deviation")


@book.add(
    "typed_aggregates",
    f"""SELECT event_type, {sql6("sum(value)")} AS total, count(value) AS n, {sql6("avg(value)")} AS mean,
  min(value) AS low, max(value) AS high FROM events GROUP BY 1""",
)
def typed_aggregates(spark, sf):
    return rounded(udfs.typed_aggregates(_events(spark, sf), "event_type", "value"), "total", "mean")


@book.add(
    "udf_scalar",
    f"SELECT event_id, {sql6('(value - 50) ** 2')} AS squared FROM events WHERE value > 100",
)
def udf_scalar(spark, sf):
    """User functions in SELECT and WHERE of SQL text."""
    udfs.register_all(spark)
    _events(spark, sf).createOrReplaceTempView("udf_events")
    found = spark.sql("SELECT event_id, centred_square(value) AS squared FROM udf_events WHERE is_high(value)")
    return rounded(found, "squared")


@book.add(
    "udf_nondeterministic",
    "SELECT event_id, TRUE AS in_range, (SELECT count(*) FROM events) > 1 AS vary FROM events",
)
def udf_nondeterministic(spark, sf):
    """Draws differ from run to run; what can be said of them is that they lie in [0, 1)
    and are not all the same."""
    drawn = cut_lineage(_events(spark, sf).select("event_id", udfs.random_draw().alias("draw")))
    low, high = drawn.agg(F.min("draw"), F.max("draw")).first()
    within = (F.col("draw") >= 0) & (F.col("draw") < 1)
    return drawn.select("event_id", within.alias("in_range"), F.lit(low < high).alias("vary"))


@book.add("udf_iterator", "SELECT doc_id, length(trim(text, ' ' || chr(9) || chr(10) || chr(13))) AS n FROM documents")
def udf_iterator(spark, sf):
    docs = driver_table(spark, sf, "documents")
    return docs.select("doc_id", udfs.text_lengths("text").alias("n"))


# Groups below are the hours of one symbol's day: 24 rows at most, at any scale.


def _hours(spark, sf):
    bars = build_bars(adapters.ticks(spark, sf), "1 hour")
    day = F.date_format("timestamp", "yyyy-MM-dd").alias("day")
    return bars.select("symbol", day, F.unix_millis("timestamp").alias("timestamp"), "close")


_HOURS = V.with_views(V.TICKS, V.bars("hour"), """hours AS (
  SELECT symbol, strftime(ts, '%Y-%m-%d') AS day, epoch_ms(ts) AS timestamp, close FROM bars)""")


@book.add(
    "udf_series_to_scalar",
    _HOURS + f"SELECT symbol, day, {sql6('max(close) - min(close)')} AS spread FROM hours GROUP BY ALL",
)
def udf_series_to_scalar(spark, sf):
    return rounded(_hours(spark, sf).groupBy("symbol", "day").agg(udfs.spread("close").alias("spread")), "spread")


@book.add(
    "udf_window",
    _HOURS
    + f"""SELECT symbol, timestamp, {sql6("max(close) OVER w - min(close) OVER w")} AS spread
FROM hours WINDOW w AS (PARTITION BY symbol, day)""",
)
def udf_window(spark, sf):
    over = udfs.spread("close").over(Window.partitionBy("symbol", "day"))
    return rounded(_hours(spark, sf).select("symbol", "timestamp", over.alias("spread")), "spread")


@book.add(
    "udf_grouped_map",
    _HOURS
    + f""", scaled AS (
  SELECT *, (close - median(close) OVER w) / coalesce(nullif(max(close) OVER w - min(close) OVER w, 0), 1) AS s
  FROM hours WINDOW w AS (PARTITION BY symbol, day))
SELECT symbol, day, timestamp, close, {sql6("s")} AS close_standing,
  rank() OVER (PARTITION BY symbol, day ORDER BY round(s, 9)) AS place FROM scaled""",
)
def udf_grouped_map(spark, sf):
    placed = udfs.standing_in_group(_hours(spark, sf), ["symbol", "day"], ["close"])
    return rounded(placed, "close_standing")


@book.add(
    "udf_cogrouped_map",
    _HOURS
    + f""", clock AS (SELECT *, timestamp % 86400000 AS hour FROM hours),
before AS (SELECT symbol, strftime(CAST(day AS DATE) + INTERVAL 1 DAY, '%Y-%m-%d') AS day, hour, close FROM clock)
SELECT symbol, day, count(a.close) AS n_today, count(b.close) AS n_before, count(a.close - b.close) AS n_both,
  {sql6("avg(a.close - b.close)")} AS mean_change
FROM clock a FULL JOIN before b USING (symbol, day, hour) GROUP BY ALL""",
)
def udf_cogrouped_map(spark, sf):
    """Each day's hours against the same hours of the day before."""
    clock = _hours(spark, sf).select(
        "symbol", "day", (F.col("timestamp") % 86_400_000).alias("hour"), "close"
    )
    next_day = F.date_format(F.date_add(F.to_date("day"), 1), "yyyy-MM-dd")
    before = clock.withColumn("day", next_day)
    return rounded(udfs.day_on_day(clock, before, ["symbol", "day"], "hour", "close"), "mean_change")


@book.add(
    "udf_map_batches",
    """SELECT event_id, unnest(range(1, CAST(ceil(value / 50) AS BIGINT) + 1)) AS step
FROM events WHERE value > 0""",
)
def udf_map_batches(spark, sf):
    return udfs.started_steps(_events(spark, sf), "event_id", "value", 50.0)


@book.add(
    "udtf_words",
    """SELECT conv_id, turn, words[i] AS word, CAST(i - 1 AS INTEGER) AS place FROM (
  SELECT conv_id, turn, string_split(text, ' ') AS words, unnest(range(1, len(string_split(text, ' ')) + 1)) AS i FROM conversations)""",
)
def udtf_words(spark, sf):
    turns = driver_table(spark, sf, "conversations").withColumn("pair", F.struct("conv_id", "turn"))
    turns.createOrReplaceTempView("udtf_turns")
    found = udfs.word_positions(spark, "udtf_turns", "pair", "text")
    return found.select("pair.*", "word", "place")


@book.add(
    "udtf_sessions",
    f"""SELECT event_id, user_id, CAST(coalesce(sum(CASE WHEN gap >= 1800 THEN 1 ELSE 0 END) OVER w, 0) AS BIGINT) AS session,
  {sql6("gap")} AS gap FROM (
  SELECT event_id, user_id, ts, epoch_us(ts) / 1e6 - lag(epoch_us(ts)) OVER (PARTITION BY user_id ORDER BY ts) / 1e6 AS gap FROM events)
WINDOW w AS (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING)""",
)
def udtf_sessions(spark, sf):
    """A table function over a table: its columns, and two more."""
    _events(spark, sf).select("event_id", "user_id", "ts").createOrReplaceTempView("udtf_events")
    found = udfs.mark_sessions(spark, "udtf_events", "user_id", "ts", 1800)
    return rounded(found, "gap").drop("ts")


# --- files ---------------------------------------------------------------------------------

_FLAT = "event_id BIGINT, ts_text STRING, user_id BIGINT, event_type STRING, value DOUBLE"
_FLAT_SQL = "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts_text, user_id, event_type, value FROM events"


def _flat(spark, sf):
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts_text")
    return _events(spark, sf).select("event_id", text, "user_id", "event_type", "value")


def _round_trip(fmt):
    def run(spark, sf):
        path = scratch_path(spark, f"files-{fmt}")
        files.export(_flat(spark, sf), path, fmt)
        return files.ingest(spark, path, fmt, schema=_FLAT)

    book.add(f"files_{fmt}", _FLAT_SQL)(run)


for _fmt in ("csv", "json", "orc", "parquet"):
    _round_trip(_fmt)


@book.add("files_partitioned", "SELECT event_type, count(*) AS n, max(value) AS high FROM events WHERE event_type IN ('view', 'click') GROUP BY 1")
def files_partitioned(spark, sf):
    """Partition folders per event type; the filter reads two of them."""
    path = scratch_path(spark, "files-partitioned")
    files.export(_flat(spark, sf), path, "parquet", partition_by=["event_type"])
    rows = files.ingest(spark, path, "parquet", glob="*.parquet").filter(F.col("event_type").isin("view", "click"))
    return rows.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"), F.max("value").alias("high"))


@book.add("files_text", "SELECT text, count(*) AS n FROM (SELECT unnest(string_split(text, chr(10))) AS text FROM benchmark) GROUP BY 1")
def files_text(spark, sf):
    path = scratch_path(spark, "files-text")
    lines = driver_table(spark, sf, "benchmark").select(F.explode(F.split("text", "\n")).alias("value"))
    files.export(lines, path, "text")
    return files.ingest(spark, path, "text").groupBy(F.col("value").alias("text")).agg(F.count(F.lit(1)).alias("n"))


# --- lake merge ------------------------------------------------------------------------------

_T1, _T2 = (dt.datetime(2024, 2, d, tzinfo=dt.timezone.utc) for d in (1, 2))


@book.add(
    "lake_merge",
    V.with_views(V.TICKS, V.bars("hour"))
    + """SELECT symbol, epoch_ms(ts) AS timestamp,
  CASE WHEN ts >= TIMESTAMP '2024-01-15' THEN close + 1 ELSE close END AS close,
  CASE WHEN ts >= TIMESTAMP '2024-01-15' THEN volume END AS volume,
  CASE WHEN ts >= TIMESTAMP '2024-01-15' THEN 'second' ELSE 'first' END AS run FROM bars""",
)
def lake_merge(spark, sf):
    """Two runs over one lake table: the second overlaps the first by five days,
    changes a price and brings a new column."""
    bars = build_bars(adapters.ticks(spark, sf), "1 hour").select("symbol", "timestamp", "close", "volume")
    lake = LakeTable(scratch_path(spark, "lake-merge"), ("symbol", "timestamp"), {"day": day_of()})
    first = bars.filter(F.col("timestamp") < F.lit("2024-01-20").cast("timestamp")).drop("volume")
    second = bars.filter(F.col("timestamp") >= F.lit("2024-01-15").cast("timestamp"))
    lake.merge(first.withColumns({"run": F.lit("first"), "updated_at": F.lit(_T1)}))
    lake.merge(
        second.withColumns({"close": F.col("close") + 1, "run": F.lit("second"), "updated_at": F.lit(_T2)})
    )
    return millis(lake.read(spark), "timestamp").select("symbol", "timestamp", "close", "volume", "run")


@book.add(
    "lake_news_merge",
    V.with_views(V.NEWS)
    + "SELECT id, publisher || '-new' AS publisher FROM news WHERE list_contains(tickers, 'view') UNION ALL"
    " SELECT id, publisher FROM news WHERE NOT list_contains(tickers, 'view')",
)
def lake_news_merge(spark, sf):
    """News keyed by article: a later run replaces the copies it brings again."""
    articles = adapters.news_articles(spark, sf).select("id", "publisher", "published_utc", "tickers")
    lake = tables.news_table(scratch_path(spark, "lake-news"), "bronze")
    lake.merge(articles.withColumn("updated_at", F.lit(_T1)))
    again = articles.filter(F.array_contains("tickers", "view"))
    lake.merge(
        again.withColumns({"publisher": F.concat("publisher", F.lit("-new")), "updated_at": F.lit(_T2)})
    )
    return lake.read(spark).select("id", "publisher")
