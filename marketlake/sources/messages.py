"""Wire messages to rows: landed API pages, stream messages, quarantine."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.schemas import (
    MACD_MESSAGE,
    NEWS_ROW,
    PRICE_MESSAGE,
    PRICE_NAMES,
    QUOTE_MESSAGE,
    QUOTE_NAMES,
)

INDICATOR_TOPICS = ["sma", "ema", "rsi"]
MACD_TOPIC = "macd"
QUOTE_TOPIC = "websocket"


def of_topics(stream: DataFrame, topics: Sequence[str]) -> DataFrame:
    return stream.filter(F.col("topic").isin(*topics))


def parse_prices(messages: DataFrame) -> DataFrame:
    """Price bars.  Malformed JSON leaves nulls; the raw text stays beside them so
    that ``split_valid`` can set such rows aside."""
    raw = F.col("value").cast("string")
    return (
        messages.select(raw.alias("_raw"), F.from_json(raw, PRICE_MESSAGE).alias("p"))
        .select("_raw", "p.*")
        .withColumnsRenamed(PRICE_NAMES)
    )


def parse_indicators(messages: DataFrame) -> DataFrame:
    """Indicator values; the topic names the indicator.  All indicator topics are
    read through the widest message (fields a topic lacks come out null)."""
    raw = F.col("value").cast("string")
    return messages.select(
        F.col("topic").alias("indicator"), raw.alias("_raw"), F.from_json(raw, MACD_MESSAGE).alias("p")
    ).select("indicator", "_raw", "p.*")


def parse_quotes(messages: DataFrame) -> DataFrame:
    """Websocket aggregates: every message is a list.  ``explode_outer`` keeps an
    unreadable message as one row of nulls for the quarantine."""
    raw = F.col("value").cast("string")
    return (
        messages.select(raw.alias("_raw"), F.from_json(raw, QUOTE_MESSAGE).alias("list"))
        .select("_raw", F.explode_outer("list").alias("q"))
        .select("_raw", "q.*")
        .withColumnsRenamed(QUOTE_NAMES)
    )


@dataclass(frozen=True)
class Split:
    valid: DataFrame
    rejected: DataFrame


def split_valid(parsed: DataFrame, required: Sequence[str]) -> Split:
    """Rows with all key columns, and the raw text of the others."""
    missing = F.lit(False)
    for name in required:
        missing = missing | F.col(name).isNull()
    return Split(
        parsed.na.drop(subset=list(required)).drop("_raw"),
        parsed.filter(missing).select("_raw", F.lit(",".join(required)).alias("required")),
    )


def _envelope(results: str) -> str:
    return f"STRUCT<ticker: STRING, status: STRING, results: {results}>"


def unpack_price_pages(pages: DataFrame) -> DataFrame:
    """Landed API pages (``symbol``, ``body``) to price rows.

    Only pages whose ``results`` is a list count; the symbol comes from the
    request, not from the body."""
    fields = [f for f in T.StructType.fromDDL(PRICE_MESSAGE).fields if f.name != "symbol"]
    bar = T.StructType([T.StructField(f.name, f.dataType) for f in fields])
    page = T.StructType([T.StructField("results", T.ArrayType(bar))])
    return (
        pages.select("symbol", F.from_json("body", page).alias("page"))
        .select("symbol", F.explode("page.results").alias("bar"))
        .select("symbol", "bar.*")
        .withColumnsRenamed(PRICE_NAMES)
    )


def unpack_indicator_pages(pages: DataFrame) -> DataFrame:
    """Same for indicator pages, where the list sits in ``results.values``."""
    values = "STRUCT<values: ARRAY<STRUCT<timestamp: BIGINT, value: DOUBLE>>>"
    return (
        pages.select("symbol", F.from_json("body", _envelope(values)).alias("page"))
        .select("symbol", F.explode("page.results.values").alias("v"))
        .select("symbol", "v.*")
    )


def unpack_news_pages(pages: DataFrame) -> DataFrame:
    """Landed news pages (``body``, and the place in the fetch order) to article rows of
    the fixed schema, with the publisher's name for the publisher."""
    article = T.StructType.fromDDL(NEWS_ROW)
    page = T.StructType([T.StructField("results", T.ArrayType(article))])
    rows = (
        pages.select("fetched", F.from_json("body", page).alias("page"))
        .select("fetched", F.posexplode("page.results").alias("place", "article"))
        .select("fetched", "place", "article.*")
    )
    return rows.withColumn("publisher", F.col("publisher.name"))


def backfill_days(symbols: DataFrame) -> DataFrame:
    """Requests to make: one per symbol and day, both ends included.
    Input: ``symbol``, ``first_day``, ``last_day``."""
    return symbols.select(
        "symbol", F.explode(F.sequence("first_day", "last_day")).alias("day")
    )


def backfill_weeks(symbols: DataFrame) -> DataFrame:
    """News requests: contiguous half-open seven-day windows from ``first_day``."""
    return symbols.select(
        "symbol",
        F.explode(F.expr("sequence(first_day, last_day, interval 7 days)")).alias("from_day"),
    ).withColumn("to_day", F.date_add("from_day", 7))
