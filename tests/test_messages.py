import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from marketlake.functions.columns import millis_to_text, millis_to_timestamp, text_to_timestamp
from marketlake.plans import gold, news, serving
from marketlake.schemas import PRICE_TABLE, SchemaMismatch, assert_schema, schema_differences
from marketlake.sources import messages
from marketlake.sources.tables import read_table

UTC = dt.timezone.utc


def stream(spark, *values, topic="aapl"):
    rows = [(topic, bytearray(v if isinstance(v, str) else json.dumps(v), "utf8")) for v in values]
    return spark.createDataFrame(rows, "topic string, value binary")


def test_bad_json_missing_symbol_and_wrong_field(spark):
    parsed = messages.parse_prices(
        stream(spark, "{nope", {"t": 1, "c": 2.0}, {"t": 2, "c": "x", "symbol": "A"}, {"t": 3, "c": 1.5, "symbol": "A"})
    )
    split = messages.split_valid(parsed, ["symbol", "timestamp"])
    assert sorted((r.timestamp, r.close) for r in split.valid.collect() if r.close) == [(3, 1.5)]
    assert split.valid.count() == 2 and split.rejected.count() == 2


def test_a_lone_object_counts_as_a_list_of_one(spark):
    quote = {"ev": "A", "sym": "X", "s": 1, "e": 2}
    parsed = messages.parse_quotes(stream(spark, quote, [quote, quote], "[broken"))
    split = messages.split_valid(parsed, ["symbol", "start_time", "end_time"])
    assert (split.valid.count(), split.rejected.count()) == (3, 1)


def test_price_and_indicator_pages(spark):
    bodies = ['{"results":[{"t":1,"c":2.0},{"t":2}]}', '{"status":"ERROR"}', '{"results":"x"}']
    pages = spark.createDataFrame([("A", b) for b in bodies], "symbol string, body string")
    assert sorted(r.timestamp for r in messages.unpack_price_pages(pages).collect()) == [1, 2]
    body = '{"results":{"values":[{"timestamp":5,"value":1.5}]}}'
    page = spark.createDataFrame([("A", body), ("B", '{"results":{}}')], "symbol string, body string")
    assert [tuple(r) for r in messages.unpack_indicator_pages(page).collect()] == [("A", 5, 1.5)]


def test_epochs_negative_and_below_a_second(spark):
    df = spark.createDataFrame([(-1500,), (1500,), (0,)], "t long")
    rows = df.select(millis_to_text("t").alias("s"), F.unix_millis(millis_to_timestamp("t")).alias("back")).collect()
    assert [r.s for r in rows] == ["1969-12-31 23:59:58", "1970-01-01 00:00:01", "1970-01-01 00:00:00"]
    assert [r.back for r in rows] == [-1500, 1500, 0]
    bad = spark.createDataFrame([("not a date",)], "s string").select(text_to_timestamp("s").alias("t"))
    assert bad.first().t is None


def test_news_first_copy_and_null_tickers(spark):
    rows = [("n1", 2, ["A"]), ("n1", 1, ["B"]), ("n2", 3, None)]
    df = spark.createDataFrame(rows, "id string, fetched int, tickers array<string>")
    kept = {r.id: r.fetched for r in news.first_seen(df, ["fetched"]).collect()}
    assert kept == {"n1": 1, "n2": 3}
    assert news.articles_by_symbol(df).count() == 2
    assert news.articles_for(df, "A").count() == 1


def hour(h, minute=0):
    return dt.datetime(2024, 1, 1, h, minute, tzinfo=UTC)


def test_gold_keeps_the_price_spine_fills_gaps_and_defaults_news(spark):
    prices = spark.createDataFrame(
        [("A", hour(h), 1.0, 1.0, 1.0, float(h), 1, 1.0, 1) for h in (0, 1, 2, 4)],
        "symbol string, timestamp timestamp, open double, high double, low double, close double,"
        " volume long, volume_weighted double, transactions long",
    )
    # the indicators start at hour 1, miss hour 2, and have an hour without a price
    values = [("A", hour(h), i, 10.0 * h) for h in (1, 3, 4) for i in ("ema", "macd", "rsi", "sma")]
    indicators = spark.createDataFrame(values, "symbol string, timestamp timestamp, indicator string, value double")
    articles = spark.createDataFrame(
        [("A", hour(4, 30), "b", "later"), ("A", hour(4, 10), "a", "earlier"), ("A", hour(9), "c", "no price")],
        "symbol string, published_utc timestamp, id string, description string",
    )
    rows = gold.build_gold(prices, indicators, articles).orderBy("timestamp").collect()
    assert [r.timestamp.hour for r in rows] == [1, 2, 4]
    assert [r.avg_ema for r in rows] == [10.0, 10.0, 40.0]
    assert [r.news_descriptions for r in rows] == [["NoNews"], ["NoNews"], ["earlier", "later"]]
    dense = gold.build_gold(prices, indicators, articles, dense=True).orderBy("timestamp").collect()
    assert [(r.timestamp.hour, r.avg_close) for r in dense] == [(1, 1.0), (2, 2.0), (3, 2.0), (4, 4.0)]


def test_latest_rows_and_changes(spark):
    quotes = spark.createDataFrame(
        [("A", e, float(e), 10 * e, e) for e in (1, 2, 5)] + [("B", 1, 1.0, 1, 1)],
        "symbol string, end_time long, close double, volume long, total_trades long",
    )
    assert serving.latest_per_symbol(quotes, 2, "end_time").count() == 3
    changes = {r.symbol: (r.close_change, r.volume_change) for r in serving.bar_changes(quotes).collect()}
    assert changes == {"A": (3.0, 30), "B": (None, None)}


def test_schema_contract(spark):
    ddl = ", ".join(f"{n} {t}" for n, t in PRICE_TABLE.items())
    good = spark.createDataFrame([], ddl)
    assert assert_schema(good, PRICE_TABLE) is good
    bad = good.withColumn("volume", F.col("volume").cast("double")).drop("open").withColumn("extra", F.lit(1))
    assert schema_differences(bad, PRICE_TABLE) == [
        ("extra", None, "int"),
        ("open", "double", None),
        ("volume", "bigint", "double"),
    ]
    with pytest.raises(SchemaMismatch):
        assert_schema(bad, PRICE_TABLE)


def test_keyed_table_scan(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "price" / "aapl"))
    assert read_table(spark, "price", "aapl", options={"root": str(tmp_path)}).count() == 3
