"""Bars, indicators, messages, gold table and serving queries."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from marketlake.catalog import views as V
from marketlake.catalog.entry import Book, millis, rounded, sql6
from marketlake.functions.columns import millis_to_text, text_to_timestamp
from marketlake.operators import indicators as ind
from marketlake.operators.bars import build_bars
from marketlake.plans import gold, news, serving
from marketlake.sources import adapters, messages
from marketlake.sources.tables import driver_table

book = Book()
AS_OF = dt.datetime(2024, 4, 20, tzinfo=dt.timezone.utc)
BAR_SQL = (
    "open, high, low, close, volume, " + sql6("volume_weighted") + " AS volume_weighted, transactions"
)
BAR_COLUMNS = ["open", "high", "low", "close", "volume", "volume_weighted", "transactions"]


# --- bars and indicators -----------------------------------------------------


def _bars_query(width, unit):
    def run(spark, sf):
        bars = build_bars(adapters.ticks(spark, sf), width)
        return rounded(millis(bars, "timestamp"), "volume_weighted")

    sql = V.with_views(V.TICKS, V.bars(unit)) + (
        f"SELECT symbol, epoch_ms(ts) AS timestamp, {BAR_SQL} FROM bars"
    )
    return run, sql


for _name, _width, _unit in [
    ("bars_second", "1 second", "second"),
    ("bars_minute", "1 minute", "minute"),
    ("bars_hour", "1 hour", "hour"),
]:
    _run, _sql = _bars_query(_width, _unit)
    book.add(_name, _sql)(_run)


def _indicator_sql(*columns, where="TRUE"):
    shown = ", ".join(f"{sql6(c.split(' AS ')[0])} AS {c.split(' AS ')[-1]}" for c in columns)
    return (
        V.with_views(*V.INDICATOR_VIEWS, recursive=True)
        + f"SELECT symbol, epoch_ms(ts) AS timestamp, {shown} FROM ind WHERE {where}"
    )


def _numbered(spark, sf):
    return ind.number_bars(adapters.minute_bars(spark, sf))


@book.add(
    "indicator_sma",
    V.with_views(V.TICKS, V.bars())
    + f"""SELECT symbol, epoch_ms(ts) AS timestamp, {sql6('''avg(close) OVER (
  PARTITION BY symbol ORDER BY ts ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)''')} AS value FROM bars""",
)
def indicator_sma(spark, sf):
    return rounded(millis(ind.sma(_numbered(spark, sf)), "timestamp"), "value")


@book.add("indicator_ema", _indicator_sql("ema AS value"))
def indicator_ema(spark, sf):
    return rounded(millis(ind.ema(_numbered(spark, sf)), "timestamp"), "value")


@book.add("indicator_macd", _indicator_sql("macd AS value", "signal", "histogram"))
def indicator_macd(spark, sf):
    frame = millis(ind.macd(_numbered(spark, sf)), "timestamp")
    return rounded(frame, "value", "signal", "histogram")


@book.add("indicator_rsi", _indicator_sql("rsi AS value", where="rsi IS NOT NULL"))
def indicator_rsi(spark, sf):
    frame = ind.rsi(_numbered(spark, sf)).filter("value IS NOT NULL")
    return rounded(millis(frame, "timestamp"), "value")


# --- landed pages, messages, news --------------------------------------------


def _price_pages(spark, sf):
    """One landed page per symbol and day.  A day that starts below 10 answers with
    an error body, whose ``results`` is not a list."""
    bars = adapters.price_rows(spark, sf)
    fields = [F.col(n).alias(w) for w, n in messages.PRICE_NAMES.items()]
    pages = bars.groupBy("symbol", F.to_date(F.timestamp_millis("timestamp")).alias("day")).agg(
        F.collect_list(F.struct(*fields)).alias("results"), F.min_by("close", "timestamp").alias("first")
    )
    good = F.to_json(F.struct(F.lit("OK").alias("status"), "results"))
    failed = F.lit('{"status":"ERROR","error":"no data"}')
    return pages.select("symbol", F.when(F.col("first") >= 10, good).otherwise(failed).alias("body"))


@book.add(
    "landed_price_pages",
    V.with_views(V.TICKS, V.bars())
    + f"""SELECT symbol, epoch_ms(ts) AS timestamp, {BAR_SQL} FROM (
  SELECT *, first_value(close) OVER (PARTITION BY symbol, CAST(ts AS DATE) ORDER BY ts) AS f FROM bars) WHERE f >= 10""",
)
def landed_price_pages(spark, sf):
    return rounded(messages.unpack_price_pages(_price_pages(spark, sf)), "volume_weighted")


@book.add(
    "landed_indicator_pages",
    V.with_views(V.TICKS, V.bars("hour"))
    + f"SELECT symbol, epoch_ms(ts) AS timestamp, {sql6('close')} AS value FROM bars",
)
def landed_indicator_pages(spark, sf):
    bars = build_bars(adapters.ticks(spark, sf), "1 hour")
    value = F.struct(F.unix_millis("timestamp").alias("timestamp"), F.col("close").alias("value"))
    body = F.to_json(F.struct(F.struct(F.collect_list(value).alias("values")).alias("results")))
    day = F.to_date("timestamp").alias("day")
    pages = bars.groupBy("symbol", day).agg(body.alias("body"))
    return rounded(messages.unpack_indicator_pages(pages), "value")


@book.add(
    "parse_price_messages",
    V.with_views(V.TICKS, V.bars()) + f"SELECT symbol, epoch_ms(ts) AS timestamp, {BAR_SQL} FROM bars",
)
def parse_price_messages(spark, sf):
    stream = adapters.price_messages(spark, sf)
    parsed = messages.parse_prices(messages.of_topics(stream, adapters.NEWS_SYMBOLS))
    return rounded(messages.split_valid(parsed, ["symbol", "timestamp"]).valid, "volume_weighted")


INDICATOR_ROWS_SQL = f"""SELECT indicator, symbol, epoch_ms(ts) AS timestamp, {sql6("value")} AS value,
  {sql6("signal")} AS signal, {sql6("histogram")} AS histogram FROM (
  SELECT 'ema' AS indicator, symbol, ts, ema AS value, NULL AS signal, NULL AS histogram FROM ind UNION ALL
  SELECT 'macd', symbol, ts, macd, signal, histogram FROM ind UNION ALL
  SELECT 'sma', symbol, ts, sma, NULL, NULL FROM ind UNION ALL
  SELECT 'rsi', symbol, ts, rsi, NULL, NULL FROM ind WHERE rsi IS NOT NULL)"""


@book.add(
    "parse_indicator_messages",
    V.with_views(*V.INDICATOR_VIEWS, recursive=True)
    + INDICATOR_ROWS_SQL,
)
def parse_indicator_messages(spark, sf):
    topics = [*messages.INDICATOR_TOPICS, messages.MACD_TOPIC]
    stream = messages.of_topics(adapters.indicator_messages(spark, sf), topics)
    valid = messages.split_valid(messages.parse_indicators(stream), ["symbol", "timestamp"]).valid
    return rounded(valid, "value", "signal", "histogram")


@book.add(
    "parse_quote_messages",
    V.with_views(V.TICKS, V.bars())
    + f"""SELECT 'A' AS event, symbol, volume, volume AS agg_volume, open AS open_price,
  {sql6("volume_weighted")} AS volume_weighted, open, close, high, low,
  {sql6("volume_weighted")} AS avg_price, transactions AS total_trades,
  epoch_ms(ts) AS start_time, epoch_ms(ts) + 60000 AS end_time FROM bars""",
)
def parse_quote_messages(spark, sf):
    parsed = messages.parse_quotes(adapters.quote_messages(spark, sf))
    valid = messages.split_valid(parsed, ["symbol", "start_time", "end_time"]).valid
    return rounded(valid, "volume_weighted", "avg_price")


@book.add(
    "quarantined_messages",
    "SELECT event_type AS topic, count(*) AS rejected FROM events"
    " WHERE value < 20 GROUP BY 1",
)
def quarantined_messages(spark, sf):
    """Cheap trades arrive broken (no symbol, or cut-off JSON) and are set aside."""
    t = adapters.ticks(spark, sf)
    whole = F.to_json(
        F.struct(F.unix_millis("ts").alias("t"), F.col("price").alias("c"), F.col("symbol"))
    )
    no_symbol = F.to_json(F.struct(F.unix_millis("ts").alias("t"), F.col("price").alias("c")))
    value = (
        F.when(F.col("price") < 10, no_symbol)
        .when(F.col("price") < 20, F.concat(F.lit('{"t":'), F.col("symbol")))
        .otherwise(whole)
    )
    stream = t.select(F.col("symbol").alias("topic"), value.cast("binary").alias("value"))
    # one topic at a time, as a message that lacks its symbol doesn't say whose it was
    found = None
    for topic in adapters.NEWS_SYMBOLS:
        parsed = messages.parse_prices(messages.of_topics(stream, [topic]))
        rejected = messages.split_valid(parsed, ["symbol", "timestamp"]).rejected
        counted = rejected.agg(F.count(F.lit(1)).alias("rejected"))
        counted = counted.filter("rejected > 0").select(F.lit(topic).alias("topic"), "rejected")
        found = counted if found is None else found.union(counted)
    return found


@book.add(
    "backfill_days",
    V.with_views(V.TICKS)
    + """SELECT symbol, strftime(d, '%Y-%m-%d') AS day FROM (
  SELECT symbol, unnest(generate_series(CAST(min(ts) AS DATE), CAST(max(ts) AS DATE), INTERVAL 1 DAY)) AS d
  FROM ticks GROUP BY symbol)""",
)
def backfill_days(spark, sf):
    return messages.backfill_days(_day_ranges(spark, sf)).withColumn("day", F.col("day").cast("string"))


@book.add(
    "backfill_weeks",
    V.with_views(V.TICKS)
    + """SELECT symbol, strftime(d, '%Y-%m-%d') AS from_day, strftime(d + INTERVAL 7 DAY, '%Y-%m-%d') AS to_day
FROM (SELECT symbol, unnest(generate_series(CAST(min(ts) AS DATE), CAST(max(ts) AS DATE), INTERVAL 7 DAY)) AS d
  FROM ticks GROUP BY symbol)""",
)
def backfill_weeks(spark, sf):
    weeks = messages.backfill_weeks(_day_ranges(spark, sf))
    return weeks.withColumns({c: F.col(c).cast("string") for c in ["from_day", "to_day"]})


def _day_ranges(spark, sf):
    day = F.to_date("ts")
    return (
        adapters.ticks(spark, sf)
        .groupBy("symbol")
        .agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))
    )


@book.add(
    "news_first_seen",
    V.with_views(V.NEWS)
    + """SELECT id, symbol AS fetched_for, strftime(published_utc, '%Y-%m-%d %H:%M:%S') AS published_utc
FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY symbol) AS seen FROM symbol_news)
WHERE seen = 1""",
)
def news_first_seen(spark, sf):
    """Every ticker's fetch returns its articles; an article of two tickers comes twice."""
    fetched = news.articles_by_symbol(adapters.news_articles(spark, sf))
    kept = news.first_seen(fetched.select("id", "symbol", "published_utc"), ["symbol"])
    return kept.select(
        "id",
        F.col("symbol").alias("fetched_for"),
        F.date_format("published_utc", "yyyy-MM-dd HH:mm:ss").alias("published_utc"),
    )


@book.add(
    "news_by_symbol",
    V.with_views(V.NEWS)
    + """SELECT symbol, count(*) AS articles, count(DISTINCT publisher) AS publishers,
  CAST(sum(length(description)) AS BIGINT) AS chars FROM symbol_news GROUP BY symbol""",
)
def news_by_symbol(spark, sf):
    """Articles are counted by symbol and publisher first: the few symbols would otherwise each
    send all of their texts to one task of the join."""
    symbols = adapters.ticks(spark, sf).select("symbol")
    counted = (
        news.articles_by_symbol(adapters.news_articles(spark, sf))
        .groupBy("symbol", "publisher")
        .agg(F.count(F.lit(1)).alias("articles"), F.sum(F.length("description")).alias("chars"))
    )
    rows = news.of_symbols(counted, symbols)
    return rows.groupBy("symbol").agg(
        F.sum("articles").alias("articles"),
        F.count("publisher").alias("publishers"),
        F.sum("chars").alias("chars"),
    )


@book.add(
    "news_for_symbol",
    V.with_views(V.NEWS) + "SELECT id, publisher FROM news WHERE list_contains(tickers, 'purchase')",
)
def news_for_symbol(spark, sf):
    return news.articles_for(adapters.news_articles(spark, sf), "purchase").select("id", "publisher")


@book.add(
    "news_newest_on_day",
    V.with_views(V.NEWS)
    + """SELECT id, epoch_ms(published_utc) AS published_ms FROM news
WHERE list_contains(tickers, 'view') AND CAST(published_utc AS DATE) = DATE '2024-01-05'
ORDER BY published_utc DESC, id DESC LIMIT 5""",
)
def news_newest_on_day(spark, sf):
    rows = news.newest_on_day(adapters.news_articles(spark, sf), "view", dt.date(2024, 1, 5))
    return rows.select("id", F.unix_millis("published_utc").alias("published_ms"))


@book.add(
    "all_symbols_union",
    V.with_views(V.TICKS, V.bars("hour"))
    + """SELECT 'bars' AS source, symbol, count(*) AS n, count(close) AS with_close, 0 AS with_price
FROM bars GROUP BY symbol UNION ALL
SELECT 'ticks', symbol, count(*), 0, count(price) FROM ticks GROUP BY symbol""",
)
def all_symbols_union(spark, sf):
    """Tables of different width stacked into one; missing columns are null."""
    t = adapters.ticks(spark, sf)
    stacked = build_bars(t, "1 hour").withColumn("source", F.lit("bars")).unionByName(
        t.withColumn("source", F.lit("ticks")), allowMissingColumns=True
    )
    return stacked.groupBy("source", "symbol").agg(
        F.count(F.lit(1)).alias("n"),
        F.count("close").alias("with_close"),
        F.count("price").alias("with_price"),
    )


@book.add(
    "millis_to_text",
    """SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS text,
  epoch_ms(date_trunc('second', ts)) AS parsed_ms FROM events""",
)
def millis_text(spark, sf):
    t = adapters.ticks(spark, sf).select("event_id", F.unix_millis("ts").alias("t"))
    return t.select("event_id", millis_to_text("t").alias("text")).select(
        "event_id", "text", F.unix_millis(text_to_timestamp("text")).alias("parsed_ms")
    )


@book.add("distinct_symbols", "SELECT DISTINCT event_type AS symbol FROM events")
def distinct_symbols(spark, sf):
    return adapters.ticks(spark, sf).select("symbol").distinct()


# --- gold ---------------------------------------------------------------------


def _gold_sql(body: str, *more: str) -> str:
    return V.with_views(*V.GOLD_VIEWS, *more, recursive=True) + body


def _features_list(columns, source=None):
    return ", ".join(f"{sql6(c)} AS {c}" for c in columns)


def _inputs(spark, sf):
    bars = _numbered(spark, sf)
    return bars.rows, ind.long_form(ind.all_indicators(bars))


@book.add(
    "hourly_price_means",
    V.with_views(V.TICKS, V.bars())
    + f"""SELECT symbol, epoch_ms(date_trunc('hour', ts)) AS timestamp,
  {", ".join(f"{sql6(f'avg({c})')} AS avg_{c}" for c in BAR_COLUMNS)} FROM bars GROUP BY ALL""",
)
def hourly_price_means(spark, sf):
    frame = gold.hourly_prices(adapters.minute_bars(spark, sf))
    return rounded(millis(frame, "timestamp"), *[f"avg_{c}" for c in BAR_COLUMNS])


@book.add(
    "hourly_indicator_means",
    _gold_sql(
        f"SELECT symbol, epoch_ms(ts) AS timestamp, {_features_list(V.FEATURES[7:])} FROM hourly_ind"
    ),
)
def hourly_indicator_means(spark, sf):
    _, indicators = _inputs(spark, sf)
    frame = gold.hourly_indicators(indicators)
    return rounded(millis(frame, "timestamp"), *V.FEATURES[7:])


@book.add(
    "hourly_news_lists",
    V.with_views(V.NEWS)
    + """SELECT symbol, epoch_ms(date_trunc('hour', published_utc)) AS timestamp, count(*) AS articles,
  md5(array_to_string(list(description ORDER BY published_utc, id), '|')) AS descriptions_md5
FROM symbol_news GROUP BY ALL""",
)
def hourly_news_lists(spark, sf):
    rows = gold.hourly_news(news.articles_by_symbol(adapters.news_articles(spark, sf)))
    return millis(rows, "timestamp").select(
        "symbol",
        "timestamp",
        F.size("news_descriptions").cast("bigint").alias("articles"),
        F.md5(F.array_join("news_descriptions", "|")).alias("descriptions_md5"),
    )


@book.add(
    "hourly_features_joined",
    _gold_sql(f"SELECT symbol, epoch_ms(ts) AS timestamp, {_features_list(V.FEATURES)} FROM features"),
)
def hourly_features_joined(spark, sf):
    frame = gold.hourly_features(*_inputs(spark, sf))
    return rounded(millis(frame, "timestamp"), *gold.FEATURES)


@book.add(
    "forward_filled_hours",
    _gold_sql(
        f"SELECT symbol, epoch_ms(ts) AS timestamp, {_features_list(V.FEATURES)} FROM dense_filled",
        """spine AS (
  SELECT symbol, unnest(generate_series(min(ts), max(ts), INTERVAL 1 HOUR)) AS ts FROM features GROUP BY symbol),
dense AS (SELECT * FROM spine LEFT JOIN features USING (symbol, ts))""",
        V.fill(V.FEATURES, "dense", "dense_filled"),
    ),
)
def forward_filled_hours(spark, sf):
    """Dense hourly spine; hours without trades repeat the last known values."""
    frame = gold.fill_hours(gold.dense_hours(gold.hourly_features(*_inputs(spark, sf))))
    return rounded(millis(frame, "timestamp"), *gold.FEATURES)


@book.add(
    "gold_features",
    _gold_sql(
        f"""SELECT symbol, epoch_ms(ts) AS timestamp, {_features_list(V.FEATURES)},
  len(news_descriptions) AS articles, md5(array_to_string(news_descriptions, '|')) AS news_md5 FROM gold"""
    ),
)
def gold_features(spark, sf):
    frame = _gold(spark, sf)
    return rounded(millis(frame, "timestamp"), *gold.FEATURES).select(
        "symbol",
        "timestamp",
        *gold.FEATURES,
        F.size("news_descriptions").cast("bigint").alias("articles"),
        F.md5(F.array_join("news_descriptions", "|")).alias("news_md5"),
    )


def _gold(spark, sf):
    articles = news.articles_by_symbol(adapters.news_articles(spark, sf))
    return gold.build_gold(*_inputs(spark, sf), articles)


@book.add(
    "front_end_features",
    _gold_sql(
        f"""SELECT symbol, epoch_ms(ts) AS timestamp,
  {", ".join(f"{sql6('avg_' + c)} AS {c}" for c in
   ["close", "volume", "volume_weighted", "transactions", "ema", "macd", "rsi", "sma"])},
  '2024-04-20 00:00:00' AS updated_at
FROM gold WHERE ts > TIMESTAMP '2024-04-20' - INTERVAL 100 DAY ORDER BY ts, symbol"""
    ),
)
def front_end_features(spark, sf):
    stamp = F.lit(AS_OF)
    shown = serving.front_end(serving.since(_gold(spark, sf), AS_OF, 100), stamp)
    columns = [c for c in shown.columns if c not in ("symbol", "timestamp", "updated_at")]
    frame = rounded(millis(shown, "timestamp"), *columns)
    return frame.withColumn(
        "updated_at", F.date_format("updated_at", "yyyy-MM-dd HH:mm:ss")
    ).orderBy("timestamp", "symbol")


# --- serving ------------------------------------------------------------------


@book.add(
    "latest_bars",
    V.with_views(V.TICKS, V.bars())
    + f"""SELECT symbol, strftime(ts, '%Y-%m-%d %H:%M:%S') AS timestamp, {BAR_SQL} FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts DESC) AS r FROM bars) WHERE r <= 10""",
)
def latest_bars(spark, sf):
    rows = serving.latest_per_symbol(adapters.price_rows(spark, sf), serving.LATEST_BARS)
    return rounded(rows.withColumn("timestamp", millis_to_text("timestamp")), "volume_weighted")


@book.add(
    "latest_bars_of_symbol",
    V.with_views(V.TICKS, V.bars())
    + f"""SELECT symbol, epoch_ms(ts) AS timestamp, {BAR_SQL} FROM bars
WHERE symbol = 'purchase' ORDER BY ts DESC LIMIT 10""",
)
def latest_bars_of_symbol(spark, sf):
    rows = serving.latest_of_symbol(
        adapters.price_rows(spark, sf), "purchase", serving.LATEST_BARS
    )
    return rounded(rows, "volume_weighted")


@book.add(
    "latest_indicator_values",
    V.with_views(*V.INDICATOR_VIEWS, recursive=True)
    + f"""SELECT symbol, epoch_ms(ts) AS timestamp, {sql6("ema")} AS value FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY ts DESC) AS r FROM ind) WHERE r <= 300""",
)
def latest_indicator_values(spark, sf):
    rows = serving.latest_per_symbol(ind.ema(_numbered(spark, sf)), serving.LATEST_INDICATORS)
    return rounded(millis(rows, "timestamp"), "value")


@book.add(
    "latest_version_per_key",
    """SELECT user_id, event_type, event_id, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS r
  FROM events) WHERE r = 1""",
)
def latest_version_per_key(spark, sf):
    rows = driver_table(spark, sf, "events").select("user_id", "event_type", "event_id", "value", "ts")
    return serving.latest_version(rows, ["user_id", "event_type"], "ts", "event_id").drop("ts")


def _quotes(spark, sf):
    parsed = messages.parse_quotes(adapters.quote_messages(spark, sf))
    return messages.split_valid(parsed, ["symbol", "start_time", "end_time"]).valid


@book.add(
    "bar_changes",
    V.with_views(V.TICKS, V.bars())
    + f"""SELECT symbol, epoch_ms(ts) + 60000 AS end_time, close, volume, transactions AS total_trades,
  {sql6("close - pc")} AS close_change, volume - pv AS volume_change, transactions - pt AS total_trades_change
FROM (SELECT *, lag(close) OVER w AS pc, lag(volume) OVER w AS pv, lag(transactions) OVER w AS pt,
  row_number() OVER (PARTITION BY symbol ORDER BY ts DESC) AS r
  FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY ts)) WHERE r = 1""",
)
def bar_changes(spark, sf):
    return rounded(serving.bar_changes(_quotes(spark, sf)), "close_change")


@book.add(
    "symbol_history",
    V.with_views(V.TICKS, V.bars())
    + """SELECT epoch_ms(ts) + 60000 AS end_time, close, volume FROM bars
WHERE symbol = 'view' ORDER BY ts DESC""",
)
def symbol_history(spark, sf):
    return serving.history_of_symbol(_quotes(spark, sf), "view").select("end_time", "close", "volume")


@book.add(
    "close_series",
    V.with_views(V.TICKS, V.bars("hour"))
    + f"""SELECT epoch_ms(ts) AS timestamp, close FROM bars
WHERE symbol = 'click' AND ts > TIMESTAMP '2024-04-20' - INTERVAL 100 DAY""",
)
def close_series(spark, sf):
    bars = build_bars(adapters.ticks(spark, sf), "1 hour")
    return millis(serving.close_series(bars, "click", AS_OF), "timestamp")


# --- smoke job ----------------------------------------------------------------


@book.add(
    "factorial_sum",
    "SELECT CAST(sum(factorial(CAST(event_id % 10 AS INTEGER))) AS BIGINT) AS total FROM events",
)
def factorial_sum(spark, sf):
    ids = driver_table(spark, sf, "events").select("event_id")
    return ids.agg(F.sum(F.factorial((F.col("event_id") % 10).cast("int"))).alias("total"))


@book.add(
    "parity_sums",
    """SELECT CASE WHEN event_id % 2 = 0 THEN 'even' ELSE 'odd' END AS key, CAST(sum(event_id) AS BIGINT) AS total
FROM events GROUP BY 1""",
)
def parity_sums(spark, sf):
    """Key every number by its parity and add up per key."""
    ids = driver_table(spark, sf, "events").select("event_id")
    parity = F.when(F.col("event_id") % 2 == 0, "even").otherwise("odd")
    return ids.groupBy(parity.alias("key")).agg(F.sum("event_id").alias("total"))
