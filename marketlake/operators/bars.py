"""Price bars from ticks."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_ID_DIGITS = Decimal(10) ** 19


def build_bars(ticks: DataFrame, width: str) -> DataFrame:
    """Open, high, low, close, volume, vwap and trade count per symbol and window.

    Open and close are the first and last trade by (ts, event_id).  That pair is
    packed into one decimal so that the aggregate keeps fixed-width buffers and
    Spark can hash-aggregate it before the shuffle."""
    moment = (
        F.unix_micros("ts").cast("decimal(18,0)") * F.lit(_ID_DIGITS)
        + F.col("event_id").cast("decimal(20,0)")
    ).cast("decimal(38,0)")
    return (
        ticks.withColumn("_moment", moment)
        .groupBy("symbol", F.window("ts", width).alias("w"))
        .agg(
            F.min_by("price", "_moment").alias("open"),
            F.max("price").alias("high"),
            F.min("price").alias("low"),
            F.max_by("price", "_moment").alias("close"),
            F.sum("size").alias("volume"),
            (F.sum(F.col("price") * F.col("size")) / F.nullif(F.sum("size"), F.lit(0))).alias(
                "volume_weighted"
            ),
            F.count(F.lit(1)).alias("transactions"),
        )
        .select(
            "symbol",
            F.col("w.start").alias("timestamp"),
            "open",
            "high",
            "low",
            "close",
            "volume",
            "volume_weighted",
            "transactions",
        )
    )
