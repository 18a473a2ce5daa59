"""Shape the driver tables into the market domain: ticks, bars, messages, news."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.operators import indicators as ind
from marketlake.operators.bars import build_bars
from marketlake.schemas import PRICE_NAMES
from marketlake.sources.tables import driver_table

# the symbols news articles are assigned to, by position
NEWS_SYMBOLS = ["click", "error", "purchase", "signup", "view"]


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return driver_table(spark, sf_dir, "events").select(
        F.col("event_type").alias("symbol"),
        "ts",
        "event_id",
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("bigint").alias("size"),
    )


def minute_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_bars(ticks(spark, sf_dir), "1 minute")


def price_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minute bars with epoch-millisecond ``timestamp``, as the price table has them."""
    return minute_bars(spark, sf_dir).withColumn("timestamp", F.unix_millis("timestamp"))


def price_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(topic, value): one JSON message per bar, as the stream delivers them."""
    bars = price_rows(spark, sf_dir)
    fields = [F.col(name).alias(wire) for wire, name in PRICE_NAMES.items()]
    return bars.select(
        F.col("symbol").alias("topic"),
        F.to_json(F.struct(*fields, "symbol")).cast("binary").alias("value"),
    )


def indicator_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON message per indicator value; the topic is the indicator.  JSON leaves out
    what is null, so only MACD messages have a signal and a histogram."""
    bars = ind.number_bars(minute_bars(spark, sf_dir))
    values = ind.long_form(ind.all_indicators(bars))
    body = F.struct(
        F.unix_millis("timestamp").alias("timestamp"), "value", "signal", "histogram", "symbol"
    )
    return values.select(
        F.col("indicator").alias("topic"), F.to_json(body).cast("binary").alias("value")
    )


def quote_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Websocket-style aggregates: each message is a JSON array with one entry
    per symbol that traded in that minute."""
    bars = price_rows(spark, sf_dir)
    entry = F.struct(
        F.lit("A").alias("ev"),
        F.col("symbol").alias("sym"),
        F.col("volume").alias("v"),
        F.col("volume").alias("av"),
        F.col("open").alias("op"),
        F.col("volume_weighted").alias("vw"),
        F.col("open").alias("o"),
        F.col("close").alias("c"),
        F.col("high").alias("h"),
        F.col("low").alias("l"),
        F.col("volume_weighted").alias("a"),
        F.col("transactions").alias("z"),
        F.col("timestamp").alias("s"),
        (F.col("timestamp") + 60_000).alias("e"),
    )
    return bars.groupBy("timestamp").agg(F.collect_list(entry).alias("entries")).select(
        F.lit("websocket").alias("topic"), F.to_json("entries").cast("binary").alias("value")
    )


def news_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = driver_table(spark, sf_dir, "documents")
    known = F.array(*[F.lit(s) for s in NEWS_SYMBOLS])
    count = len(NEWS_SYMBOLS)
    first = F.get(known, (F.col("doc_id") % count).cast("int"))
    second = F.get(known, ((F.col("doc_id") + 1) % count).cast("int"))
    return docs.select(
        F.col("doc_id").cast("string").alias("id"),
        F.col("text").alias("description"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id") * 3600).alias(
            "published_utc"
        ),
        F.col("source").alias("publisher"),
        F.when(F.col("doc_id") % 3 == 0, F.array(first, second))
        .otherwise(F.array(first))
        .alias("tickers"),
    )
