import datetime as dt
import json

from conftest import SMALL

from marketlake.operators import indicators as ind
from marketlake.plans import layers, tables
from marketlake.sources import adapters
from marketlake.streaming.router import Router, message_stream

AT = dt.datetime(2024, 2, 1, tzinfo=dt.timezone.utc)
PRICE = {"t": 1000, "o": 1.0, "h": 2.0, "l": 0.5, "c": 1.5, "v": 10, "vw": 1.2, "n": 3, "symbol": "AAPL"}


def land(spark, path, rows):
    rows = [(t, bytearray(v if isinstance(v, str) else json.dumps(v), "utf8")) for t, v in rows]
    spark.createDataFrame(rows, "topic string, value binary").coalesce(1).write.mode("append").parquet(path)


def run(spark, root, inbox):
    router = Router(root, ["aapl", "msft"], AT)
    stream = message_stream(spark, "parquet", {}, inbox)
    router.start(stream, f"{root}/checkpoint", availableNow=True).awaitTermination()
    return router


def test_routes_parses_merges_and_quarantines(spark, root, tmp_path):
    inbox = str(tmp_path / "inbox")
    quote = {"ev": "A", "sym": "AAPL", "v": 1, "c": 1.5, "z": 2, "s": 1, "e": 2}
    land(
        spark,
        inbox,
        [
            ("aapl", PRICE),
            ("aapl", PRICE),
            ("aapl", "{broken"),
            ("msft", {**PRICE, "symbol": None}),
            ("sma", {"timestamp": 1000, "value": 1.0, "symbol": "AAPL"}),
            ("macd", {"timestamp": 1000, "value": 1.0, "signal": 0.5, "histogram": 0.5, "symbol": "AAPL"}),
            ("websocket", [quote, {**quote, "e": 3}, {**quote, "sym": None}]),
            ("websocket", quote),
            ("other", "ignored"),
        ],
    )
    router = run(spark, root, inbox)
    prices = tables.price_table(root, "bronze").read(spark).collect()
    assert [(p.symbol, p.timestamp, p.close, p.updated_at) for p in prices] == [("AAPL", 1000, 1.5, AT.replace(tzinfo=None))]
    values = tables.indicator_table(root, "bronze").read(spark).collect()
    assert {(v.indicator, v.signal) for v in values} == {("sma", None), ("macd", 0.5)}
    assert tables.quote_table(root).read(spark).count() == 2
    rejected = spark.read.parquet(router.quarantine_path()).groupBy("family").count().collect()
    assert {r.family: r["count"] for r in rejected} == {"price": 2, "quotes": 1}


def test_restart_continues_at_stored_offsets(spark, root, tmp_path):
    inbox = str(tmp_path / "inbox")
    land(spark, inbox, [("aapl", PRICE)])
    run(spark, root, inbox)
    run(spark, root, inbox)
    land(spark, inbox, [("aapl", {**PRICE, "c": 9.0}), ("msft", {**PRICE, "symbol": "MSFT"})])
    run(spark, root, inbox)
    lake = tables.price_table(root, "bronze")
    assert sorted((r.symbol, r.close) for r in lake.read(spark).collect()) == [("AAPL", 9.0), ("MSFT", 1.5)]
    assert lake.history(spark).count() == 2


def test_a_replayed_batch_changes_nothing(spark, root, tmp_path):
    router = Router(root, ["aapl"], AT)
    batch = spark.createDataFrame([("aapl", bytearray(json.dumps(PRICE), "utf8"))], "topic string, value binary")
    router(batch, 0)
    router(batch, 0)
    lake = tables.price_table(root, "bronze")
    assert lake.read(spark).count() == 1 and lake.history(spark).count() == 1


def test_layers_end_to_end_equal_direct_gold(spark, root):
    from marketlake.plans import gold, news

    bars = ind.number_bars(adapters.minute_bars(spark, SMALL))
    wide = ind.long_form(ind.all_indicators(bars))
    articles = adapters.news_articles(spark, SMALL)
    from pyspark.sql import functions as F

    prices = bars.rows.drop("_pos").withColumn("timestamp", F.unix_millis("timestamp"))
    feed = wide.withColumn("timestamp", F.unix_millis("timestamp"))
    layers.run_layers(spark, root, prices, feed, articles, AT)
    got = tables.gold_table(root).read(spark)
    want = gold.build_gold(bars.rows, wide, news.articles_by_symbol(articles))
    columns = ["symbol", "timestamp", "avg_close", "avg_rsi", "news_descriptions"]
    key = lambda r: (r.symbol, r.timestamp)
    left, right = (sorted(d.select(*columns).collect(), key=key) for d in (got, want))
    assert len(left) == len(right) > 0
    for a, b in zip(left, right):
        assert key(a) == key(b) and abs(a.avg_close - b.avg_close) < 1e-9 and a.news_descriptions == b.news_descriptions
    serving = tables.serving_table(root).read(spark)
    assert serving.count() == len(left)
    layers.run_layers(spark, root, prices, feed, articles, AT)
    assert tables.gold_table(root).read(spark).count() == len(left)
