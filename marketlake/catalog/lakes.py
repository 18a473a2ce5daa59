"""Lake upkeep, layers, landed news, the router's other families, catalogued tables."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from marketlake.catalog import views as V
from marketlake.catalog.entry import Book, millis, r6, rounded, sql6
from marketlake.catalog.market import INDICATOR_ROWS_SQL
from marketlake.operators.bars import build_bars
from marketlake.plans import layers, tables
from marketlake.plans.news import first_seen
from marketlake.session import scratch_path
from marketlake.sources import adapters, files, messages
from marketlake.sources.lake import LakeTable, day_of
from marketlake.sources.tables import driver_table
from marketlake.streaming.router import Router, message_stream

book = Book()
_AT = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)


# --- landed news ----------------------------------------------------------------------


@book.add(
    "landed_news_pages",
    V.with_views(V.NEWS)
    + """SELECT id, publisher, strftime(published_utc, '%Y-%m-%dT%H:%M:%SZ') AS published_utc,
  len(tickers) AS n_tickers, length(description) AS n_chars FROM news""",
)
def landed_news_pages(spark, sf):
    """A page per ticker and day, as fetched; an article of two tickers lands twice and is
    kept once."""
    articles = adapters.news_articles(spark, sf)
    wire = articles.withColumns(
        {
            "day": F.to_date("published_utc"),
            "published_utc": F.date_format("published_utc", "yyyy-MM-dd'T'HH:mm:ss'Z'"),
            "name": F.col("publisher"),
        }
    ).withColumn("publisher", F.struct("name"))
    article = F.struct("id", "description", "published_utc", "publisher", "tickers")
    fetched = wire.select(F.explode("tickers").alias("ticker"), "day", article.alias("article"))
    pages = fetched.groupBy("ticker", "day").agg(F.collect_list("article").alias("results"))
    pages = pages.select("ticker", "day", F.to_json(F.struct("results")).alias("body"))
    rows = messages.unpack_news_pages(
        pages.select(F.concat_ws("/", "ticker", "day").alias("fetched"), "body")
    )
    return first_seen(rows, ["fetched", "place"]).select(
        "id",
        "publisher",
        "published_utc",
        F.size("tickers").cast("long").alias("n_tickers"),
        F.length("description").cast("long").alias("n_chars"),
    )


# --- router ---------------------------------------------------------------------------


def _landed(spark, name, inbox):
    root = scratch_path(spark, name)
    inbox.write.parquet(f"{root}/inbox")
    router = Router(root, adapters.NEWS_SYMBOLS, _AT)
    stream = message_stream(spark, "parquet", {}, f"{root}/inbox")
    router.start(stream, f"{root}/checkpoint", availableNow=True).awaitTermination()
    return root, router


@book.add(
    "stream_ingest_indicators",
    V.with_views(*V.INDICATOR_VIEWS, recursive=True) + INDICATOR_ROWS_SQL,
)
def stream_ingest_indicators(spark, sf):
    root, _ = _landed(spark, "stream-indicators", adapters.indicator_messages(spark, sf))
    rows = tables.indicator_table(root, "bronze").read(spark).drop("day", "updated_at")
    return rounded(rows, "value", "signal", "histogram")


@book.add(
    "stream_ingest_quotes",
    V.with_views(V.TICKS, V.bars())
    + f"""SELECT symbol, epoch_ms(ts) + 60000 AS end_time, volume, open, close, high, low,
  {sql6("volume_weighted")} AS volume_weighted, transactions AS total_trades FROM bars""",
)
def stream_ingest_quotes(spark, sf):
    root, _ = _landed(spark, "stream-quotes", adapters.quote_messages(spark, sf))
    rows = tables.quote_table(root).read(spark)
    return rounded(rows, "volume_weighted").select(
        "symbol", "end_time", "volume", "open", "close", "high", "low", "volume_weighted", "total_trades"
    )


@book.add(
    "stream_quarantine",
    V.with_views(V.TICKS, V.bars())
    + """SELECT 'price' AS family, count(*) AS rejected FROM bars WHERE close < 20
UNION ALL SELECT 'quotes', count(*) FROM bars WHERE close < 10 HAVING count(*) > 0""",
)
def stream_quarantine(spark, sf):
    """Messages of cheap bars arrive cut off; the router sets them aside by family."""
    bars = adapters.price_rows(spark, sf)
    text = F.to_json(F.struct(F.col("timestamp").alias("t"), F.col("close").alias("c"), "symbol"))
    prices = bars.select(
        F.col("symbol").alias("topic"),
        F.when(F.col("close") < 20, F.substring(text, 1, 9)).otherwise(text).cast("binary").alias("value"),
    )
    quotes = bars.filter("close < 10").select(
        F.lit("websocket").alias("topic"), F.lit("[{").cast("binary").alias("value")
    )
    _, router = _landed(spark, "stream-quarantine", prices.union(quotes))
    aside = spark.read.parquet(router.quarantine_path())
    return aside.groupBy("family").agg(F.count(F.lit(1)).alias("rejected"))


# --- lake upkeep ----------------------------------------------------------------------


def _hour_bars(spark, sf):
    return build_bars(adapters.ticks(spark, sf), "1 hour").select("symbol", "timestamp", "close")


def _run_thrice(spark, sf, name):
    """A table created, merged into and created anew."""
    bars = _hour_bars(spark, sf).withColumn("updated_at", F.lit(_AT))
    lake = LakeTable(scratch_path(spark, name), ("symbol", "timestamp"), {"day": day_of()})
    early = F.col("timestamp") < F.lit("2024-01-15").cast("timestamp")
    lake.create(bars.filter(early), batch_id=0)
    lake.merge(bars, batch_id=1)
    lake.merge(bars.withColumn("close", F.lit(0.0)), batch_id=1)  # a replay
    lake.create(bars.filter(~early), batch_id=2)
    return lake


_HOUR_BARS = V.with_views(V.TICKS, V.bars("hour"))


@book.add(
    "lake_refresh",
    _HOUR_BARS
    + "SELECT symbol, epoch_ms(ts) AS timestamp, close FROM bars WHERE ts >= TIMESTAMP '2024-01-15'",
)
def lake_refresh(spark, sf):
    """Full refresh: the rows of the last one, and no others."""
    rows = _run_thrice(spark, sf, "lake-refresh").read(spark)
    return millis(rows, "timestamp").select("symbol", "timestamp", "close")


@book.add(
    "lake_history",
    _HOUR_BARS
    + """, n AS (SELECT count(*) AS total, count(*) FILTER (WHERE ts < TIMESTAMP '2024-01-15') AS early FROM bars)
SELECT 0 AS batch_id, 'CREATE' AS operation, early AS inserted, 0 AS updated FROM n
UNION ALL SELECT 1, 'MERGE', total - early, early FROM n
UNION ALL SELECT 2, 'CREATE', total - early, 0 FROM n""",
)
def lake_history(spark, sf):
    """The audit outlives refreshes, and a replayed batch leaves no trace."""
    log = _run_thrice(spark, sf, "lake-history").history(spark)
    return log.select("batch_id", "operation", "inserted", "updated")


@book.add(
    "lake_compaction",
    _HOUR_BARS + "SELECT symbol, epoch_ms(ts) AS timestamp, close, TRUE AS one_file_a_day FROM bars",
)
def lake_compaction(spark, sf):
    """Three merges, then one file per day, sorted by symbol and time."""
    bars = _hour_bars(spark, sf).withColumn("updated_at", F.lit(_AT))
    lake = LakeTable(
        scratch_path(spark, "lake-compaction"), ("symbol", "timestamp"), {"day": day_of()},
        cluster_by=("symbol", "timestamp"),
    )
    for part in range(3):
        lake.merge(bars.filter(F.pmod(F.hour("timestamp"), F.lit(3)) == part))
    lake.compact(spark, files=1)
    rows = lake.read(spark)
    days = rows.select("day").distinct().count()
    tidy = len(rows.inputFiles()) == days
    return millis(rows, "timestamp").select(
        "symbol", "timestamp", "close", F.lit(tidy).alias("one_file_a_day")
    )


@book.add(
    "lake_older_version",
    _HOUR_BARS
    + """SELECT symbol, epoch_ms(ts) AS timestamp, close, version FROM bars, (SELECT unnest([1, 2, 3]) AS version)
WHERE version = 2 OR (ts < TIMESTAMP '2024-01-15') = (version = 1)""",
)
def lake_older_version(spark, sf):
    """Each version of a table that has been merged into and refreshed since."""
    lake = _run_thrice(spark, sf, "lake-versions")
    parts = [lake.read(spark, v).withColumn("version", F.lit(v)) for v in (1, 2, 3)]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return millis(rows, "timestamp").select("symbol", "timestamp", "close", "version")


@book.add(
    "lake_changed_rows",
    _HOUR_BARS
    + """SELECT symbol, epoch_ms(ts) AS timestamp,
  CASE WHEN symbol = 'view' THEN close + 1 ELSE close END AS close FROM bars
WHERE ts >= TIMESTAMP '2024-01-20' OR (ts >= TIMESTAMP '2024-01-15' AND symbol = 'view')""",
)
def lake_changed_rows(spark, sf):
    """The feed after a merge that repeats some rows, changes those of one symbol and adds
    days: rows that came again as they were are not in it."""
    bars = _hour_bars(spark, sf).withColumn("updated_at", F.lit(_AT))
    lake = LakeTable(scratch_path(spark, "lake-feed"), ("symbol", "timestamp"), {"day": day_of()})
    lake.create(bars.filter(F.col("timestamp") < F.lit("2024-01-20").cast("timestamp")))
    later = bars.filter(F.col("timestamp") >= F.lit("2024-01-15").cast("timestamp"))
    raised = F.when(F.col("symbol") == "view", F.col("close") + 1).otherwise(F.col("close"))
    lake.merge(later.withColumns({"close": raised, "updated_at": F.lit(_AT + dt.timedelta(days=1))}))
    return millis(lake.changed(spark, since=1), "timestamp").select("symbol", "timestamp", "close")


_PARTS, _SUPPLIERS = 40, 7


@book.add(
    "lake_zorder_skipping",
    f"""SELECT 'l_partkey' AS filtered, count(*) AS matching, TRUE AS skips, TRUE AS skips_with_curve
FROM lineitem WHERE l_partkey = {_PARTS} UNION ALL
SELECT 'l_suppkey', count(*), FALSE, TRUE FROM lineitem WHERE l_suppkey = {_SUPPLIERS}""",
)
def lake_zorder_skipping(spark, sf):
    """Files whose range meets a filter on one column, of files sorted by (part, supplier) and of
    files along the curve over both.  Sorted files skip by the first column only; along the
    curve at least a third is skipped by either."""
    rows = driver_table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.lit(_AT).alias("updated_at")
    )
    lake = LakeTable(
        scratch_path(spark, "lake-curve"), ("l_orderkey", "l_linenumber"),
        cluster_by=("l_partkey", "l_suppkey"),
    )
    lake.create(rows)
    filters = {"l_partkey": _PARTS, "l_suppkey": _SUPPLIERS}

    def share_hit():
        file = F.input_file_name().alias("file")
        ranges = lake.read(spark).groupBy(file).agg(
            *[
                F.lit(v).between(F.min(c), F.max(c)).cast("int").alias(c)
                for c, v in filters.items()
            ]
        )
        return ranges.agg(*[F.avg(c).alias(c) for c in filters]).first()

    shares = []
    for by in ((), ("l_partkey", "l_suppkey")):
        lake.compact(spark, files=32, zorder=by)
        shares.append(share_hit())
    table, out = lake.read(spark), None
    for column, value in filters.items():
        row = table.filter(F.col(column) == value).agg(F.count(F.lit(1)).alias("matching")).select(
            F.lit(column).alias("filtered"),
            "matching",
            *[
                F.lit(share[column] <= 2 / 3).alias(name)
                for name, share in zip(("skips", "skips_with_curve"), shares)
            ],
        )
        out = row if out is None else out.union(row)
    return out


# --- layers ---------------------------------------------------------------------------


@book.add(
    "layers_gold",
    V.with_views(*V.GOLD_VIEWS, recursive=True)
    + f"""SELECT symbol, epoch_ms(ts) AS timestamp, {sql6("avg_close")} AS avg_close,
  {sql6("avg_ema")} AS avg_ema, {sql6("avg_macd")} AS avg_macd, len(news_descriptions) AS articles FROM gold""",
)
def layers_gold(spark, sf):
    """Bronze to gold and serving through the lake's own tables."""
    root = scratch_path(spark, "layers")
    prices = adapters.price_rows(spark, sf)
    indicators = messages.split_valid(
        messages.parse_indicators(adapters.indicator_messages(spark, sf)), ["symbol", "timestamp"]
    ).valid
    layers.run_layers(spark, root, prices, indicators, adapters.news_articles(spark, sf), _AT)
    rows = tables.gold_table(root).read(spark)
    return rounded(millis(rows, "timestamp"), "avg_close", "avg_ema", "avg_macd").select(
        "symbol",
        "timestamp",
        "avg_close",
        "avg_ema",
        "avg_macd",
        F.size("news_descriptions").cast("long").alias("articles"),
    )


def _two_runs(spark, sf, name):
    """The layers after all days but the last two, and again after those."""
    root = scratch_path(spark, name)
    prices = adapters.price_rows(spark, sf)
    indicators = messages.split_valid(
        messages.parse_indicators(adapters.indicator_messages(spark, sf)), ["symbol", "timestamp"]
    ).valid
    articles = adapters.news_articles(spark, sf)
    border = F.unix_millis(F.lit("2024-01-29").cast("timestamp"))
    at = F.lit("2024-01-29").cast("timestamp")
    early = [prices.filter(F.col("timestamp") < border), indicators.filter(F.col("timestamp") < border)]
    late = [prices.filter(F.col("timestamp") >= border), indicators.filter(F.col("timestamp") >= border)]
    layers.run_layers(spark, root, *early, articles.filter(F.col("published_utc") < at), _AT)
    layers.run_layers(
        spark, root, *late, articles.filter(F.col("published_utc") >= at), _AT + dt.timedelta(days=1)
    )
    return root


@book.add(
    "layers_incremental",
    V.with_views(*V.GOLD_VIEWS, recursive=True)
    + f"""SELECT symbol, epoch_ms(ts) AS timestamp, {sql6("avg_close")} AS avg_close,
  {sql6("avg_ema")} AS avg_ema, {sql6("avg_rsi")} AS avg_rsi, len(news_descriptions) AS articles FROM gold""",
)
def layers_incremental(spark, sf):
    """Two runs, the second with new days only: the rows of one run over everything."""
    rows = tables.gold_table(_two_runs(spark, sf, "layers-twice")).read(spark)
    return rounded(millis(rows, "timestamp"), "avg_close", "avg_ema", "avg_rsi").select(
        "symbol",
        "timestamp",
        "avg_close",
        "avg_ema",
        "avg_rsi",
        F.size("news_descriptions").cast("long").alias("articles"),
    )


@book.add(
    "layers_touched",
    V.with_views(V.TICKS, V.bars())
    + """, days AS (SELECT DISTINCT strftime(ts, '%Y-%m-%d') AS day FROM bars WHERE ts >= TIMESTAMP '2024-01-29'),
layers AS (SELECT unnest(['bronze/price', 'silver/price', 'silver/indicators', 'gold/features']) AS layer)
SELECT layer, 'day=' || day AS partition FROM layers, days""",
)
def layers_touched(spark, sf):
    """The partitions that the second run has rewritten, from the tables' logs: the new days."""
    root = _two_runs(spark, sf, "layers-touched")
    found = None
    for table in (
        tables.price_table(root, "bronze"),
        tables.price_table(root, "silver"),
        tables.indicator_table(root, "silver"),
        tables.gold_table(root),
    ):
        layer = "/".join(table.path.split("/")[-2:])
        rows = table.history(spark).filter("version > 1").select(
            F.lit(layer).alias("layer"), F.explode("touched").alias("partition")
        )
        found = rows if found is None else found.union(rows)
    return found


@book.add(
    "forecasts_of_symbol",
    _HOUR_BARS
    + f"""SELECT epoch_ms(ts) + 3600000 AS timestamp,
  {sql6("close + coalesce(close - lag(close) OVER (PARTITION BY symbol ORDER BY ts), 0)")} AS close
FROM bars WHERE symbol = 'view' ORDER BY 1""",
)
def forecasts_of_symbol(spark, sf):
    """Forecasts that go on with the last change, stored and read back; the hour after the
    newest bar is among them."""
    bars = _hour_bars(spark, sf)
    before = F.lag("close").over(Window.partitionBy("symbol").orderBy("timestamp"))
    scored = bars.withColumn("prediction", F.col("close") + F.coalesce(F.col("close") - before, F.lit(0.0)))
    root = scratch_path(spark, "forecasts")
    layers.store_forecasts(root, scored, _AT)
    return rounded(millis(layers.forecasts_of(spark, root, "view"), "timestamp"), "close")


# --- catalogued tables ----------------------------------------------------------------


@book.add(
    "tables_bucketed",
    """SELECT o_orderstatus, count(*) AS lines, CAST(sum(l_linenumber) AS BIGINT) AS numbers
FROM orders JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1""",
)
def tables_bucketed(spark, sf):
    """Orders and lines bucketed on the order key: their join needs no shuffle."""
    names = {}
    keys = {"orders": "o_orderkey", "lineitem": "l_orderkey"}
    buckets = files.bucket_count(*[driver_table(spark, sf, name) for name in keys])
    for name, key in keys.items():
        names[name] = f"bucketed_{name}_{uuid.uuid4().hex}"
        rows = driver_table(spark, sf, name).withColumn("order_key", F.col(key))
        path = scratch_path(spark, f"bucketed-{name}")
        files.save_bucketed(rows, names[name], path, ["order_key"], buckets, ["order_key"])
    joined = spark.table(names["orders"]).join(spark.table(names["lineitem"]), "order_key")
    return joined.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("l_linenumber").cast("long").alias("numbers")
    )


@book.add(
    "tables_managed_and_views",
    "SELECT n_regionkey, count(*) AS customers, "
    f"{sql6('avg(c_acctbal)')} AS balance FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1",
)
def tables_managed_and_views(spark, sf):
    """A managed table filled in two goes, and a view over it for all sessions."""
    name = f"managed_customers_{uuid.uuid4().hex}"
    nations = driver_table(spark, sf, "nation").select("n_nationkey", "n_regionkey")
    rows = driver_table(spark, sf, "customer").join(
        nations, F.col("c_nationkey") == F.col("n_nationkey")
    ).select("c_custkey", "c_acctbal", "n_regionkey")
    files.managed_table(rows.filter("c_custkey % 2 = 0"), name)
    files.load_into(rows.filter("c_custkey % 2 <> 0"), name)
    view = files.temp_view(spark.table(name), f"view_{name}", everywhere=True)
    return spark.sql(f"SELECT * FROM {view}").groupBy("n_regionkey").agg(
        F.count(F.lit(1)).alias("customers"), r6(F.avg("c_acctbal")).alias("balance")
    )
