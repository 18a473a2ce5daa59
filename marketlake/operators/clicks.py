"""Windowed click-stream measures.

The plain forms serve batch and stream frames alike.  A sliding window copies every event
into each of its windows; the ``by_slot`` forms, for batch frames, sum up per slide first and
copy those sums."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# fixed window sizes of the click-stream report
PAGE_WINDOW, PAGE_SLIDE = "10 seconds", "2 seconds"
ERROR_WINDOW, ERROR_SLIDE, ERROR_LIMIT = "30 seconds", "2 seconds", 0.05
ACTIVE_WINDOW, ACTIVE_SLIDE = "15 seconds", "2 seconds"


def _bounds(df: DataFrame, *columns: str) -> DataFrame:
    return df.select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), *columns)


def word_windows(events: DataFrame, word: str, size: str, slide: str) -> DataFrame:
    """Count of each word per sliding window."""
    counted = events.groupBy(F.window("ts", size, slide).alias("w"), F.col(word).alias("word"))
    return _bounds(counted.agg(F.count(F.lit(1)).alias("n")), "word", "n")


def page_counts(events: DataFrame) -> DataFrame:
    return events.groupBy("event_type").agg(F.count(F.lit(1)).alias("views"))


def sliding_page_counts(events: DataFrame) -> DataFrame:
    counted = events.groupBy(F.window("ts", PAGE_WINDOW, PAGE_SLIDE).alias("w"), "event_type")
    return _bounds(counted.agg(F.count(F.lit(1)).alias("views")), "event_type", "views")


def error_rates(events: DataFrame, area: str, limit: float = ERROR_LIMIT) -> DataFrame:
    """Share of error events per area and sliding window, flagged above a limit."""
    failed = F.when(F.col("event_type") == "error", 1).otherwise(0)
    rate = events.groupBy(F.window("ts", ERROR_WINDOW, ERROR_SLIDE).alias("w"), area).agg(
        F.avg(failed).alias("error_rate"), F.count(F.lit(1)).alias("views")
    )
    return _bounds(rate, area, "error_rate", "views").withColumn(
        "alert", F.col("error_rate") > limit
    )


def _slots(events: DataFrame, slide: str, *keys: str):
    return events.groupBy(F.window("ts", slide)["start"].alias("slot"), *keys)


def _in_windows(slots: DataFrame, size: str, slide: str) -> DataFrame:
    """Each slot once for every window that holds it; sizes are whole slides."""
    first = F.expr(f"slot - INTERVAL {size} + INTERVAL {slide}")
    starts = F.sequence(first, F.col("slot"), F.expr(f"INTERVAL {slide}"))
    return slots.withColumn("start", F.explode(starts)).withColumn(
        "end", F.expr(f"start + INTERVAL {size}")
    )


def sliding_page_counts_by_slot(events: DataFrame) -> DataFrame:
    slots = _slots(events, PAGE_SLIDE, "event_type").agg(F.count(F.lit(1)).alias("n"))
    spread = _in_windows(slots, PAGE_WINDOW, PAGE_SLIDE)
    return spread.groupBy("start", "end", "event_type").agg(F.sum("n").alias("views"))


def error_rates_by_slot(events: DataFrame, area: str, limit: float = ERROR_LIMIT) -> DataFrame:
    failed = F.sum((F.col("event_type") == "error").cast("long"))
    slots = _slots(events, ERROR_SLIDE, area).agg(F.count(F.lit(1)).alias("n"), failed.alias("failed"))
    spread = _in_windows(slots, ERROR_WINDOW, ERROR_SLIDE).groupBy("start", "end", area)
    rate = F.sum("failed") / F.sum("n")
    return spread.agg(
        rate.alias("error_rate"), F.sum("n").alias("views"), (rate > limit).alias("alert")
    )


def active_users_by_slot(events: DataFrame) -> DataFrame:
    """Users are made distinct per second before they are spread over windows; the
    window is 15 seconds, which is no whole number of slides."""
    seen = events.select(F.date_trunc("second", "ts").alias("ts"), "user_id").distinct()
    return active_users(seen)


def active_users(events: DataFrame) -> DataFrame:
    counted = events.groupBy(F.window("ts", ACTIVE_WINDOW, ACTIVE_SLIDE).alias("w"))
    return _bounds(counted.agg(F.count_distinct("user_id").alias("users")), "users")


def known_users_seen(events: DataFrame, users: DataFrame) -> DataFrame:
    """Events per known user.  Counting first leaves one row per user to join."""
    seen = events.groupBy("user_id").agg(F.count(F.lit(1)).alias("views"))
    return seen.join(users, "user_id")
