"""Serving queries: latest rows, recency filters, bar-to-bar changes."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# fixed limits of the serving queries
LATEST_BARS, LATEST_INDICATORS, LATEST_QUOTES = 10, 300, 2
SERVING_DAYS, CLOSE_SERIES_DAYS = 365, 100


def front_end(gold: DataFrame, updated_at) -> DataFrame:
    """Feature columns without their ``avg_`` prefix, plus the audit column."""
    kept = [
        "close",
        "volume",
        "volume_weighted",
        "transactions",
        "ema",
        "macd",
        "rsi",
        "sma",
    ]
    return gold.select(
        "symbol",
        "timestamp",
        *[F.col(f"avg_{c}").alias(c) for c in kept],
        updated_at.alias("updated_at"),
    )


def since(df: DataFrame, as_of: dt.datetime, days: int, column: str = "timestamp") -> DataFrame:
    """Rows newer than ``days`` before ``as_of``; a literal bound, so it is pushed
    to the scan."""
    return df.filter(F.col(column) > F.lit(as_of - dt.timedelta(days=days)))


def latest_per_symbol(df: DataFrame, n: int, column: str = "timestamp") -> DataFrame:
    """Newest ``n`` rows of every symbol.  Each task keeps its own top ``n`` before
    the shuffle, so a dominant symbol does not pile up anywhere."""
    w = Window.partitionBy("symbol").orderBy(F.desc(column))
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= n).drop("_rank")


def latest_of_symbol(df: DataFrame, symbol: str, n: int, column: str = "timestamp") -> DataFrame:
    return df.filter(F.col("symbol") == symbol).orderBy(F.desc(column)).limit(n)


def history_of_symbol(df: DataFrame, symbol: str, column: str = "end_time") -> DataFrame:
    return df.filter(F.col("symbol") == symbol).orderBy(F.desc(column))


def latest_version(df: DataFrame, keys: list[str], *version) -> DataFrame:
    """Newest row per key, by descending version columns."""
    w = Window.partitionBy(*keys).orderBy(*[F.desc(v) for v in version])
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def bar_changes(quotes: DataFrame) -> DataFrame:
    """Change of close, volume and trades between the last two bars of a symbol."""
    pair = latest_per_symbol(quotes, LATEST_QUOTES, "end_time")
    w = Window.partitionBy("symbol").orderBy("end_time")
    measures = ["close", "volume", "total_trades"]
    return (
        pair.withColumns({f"{m}_change": F.col(m) - F.lag(m).over(w) for m in measures})
        .withColumn("_newest", F.row_number().over(w.orderBy(F.desc("end_time"))))
        .filter("_newest = 1")
        .select("symbol", "end_time", *measures, *[f"{m}_change" for m in measures])
    )


def close_series(serving: DataFrame, symbol: str, as_of: dt.datetime) -> DataFrame:
    return since(serving.filter(F.col("symbol") == symbol), as_of, CLOSE_SERIES_DAYS).select(
        "timestamp", "close"
    )
