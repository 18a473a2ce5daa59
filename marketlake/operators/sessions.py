"""Sessions per key: a pause longer than the gap, or a closing event, ends one."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.operators.ordered import (
    CHUNK,
    POS,
    WARMUP,
    fill_forward,
    halo_chunks,
    number_rows,
)


def sessions(
    events: DataFrame,
    key: str,
    gap_seconds: int,
    closes: Column | None = None,
    chunk: int | None = None,
) -> DataFrame:
    """(key, start, end, duration_seconds, events, closed) per session.

    ``events`` has ``key``, ``ts`` and a tie-breaking ``event_id``.  As in Spark's
    session windows an event exactly one gap after the previous one starts a new
    session.  ``closes`` marks events that end their session at once.

    Each session is named by the position of its first event; that position is
    carried forward over chunks, so neither a busy key nor one endless session
    has to fit into a task."""
    closes = F.lit(False) if closes is None else closes
    slim = events.select(key, "ts", "event_id", closes.alias("_closes"))
    numbered = number_rows(slim, [key], ["ts", "event_id"])
    previous = Window.partitionBy(key, CHUNK).orderBy(POS)
    before = F.lag(F.struct("ts", "_closes")).over(previous)
    gap = F.unix_micros("ts") - F.unix_micros(before["ts"]) >= gap_seconds * 1_000_000
    marked = (
        halo_chunks(numbered, 1, chunk)
        .withColumn("_starts", before.isNull() | gap | before["_closes"])
        .filter(~F.col(WARMUP))
        .drop(CHUNK, WARMUP)
        .withColumn("_session", F.when(F.col("_starts"), F.col(POS)))
    )
    return (
        fill_forward(replace(numbered, rows=marked), ["_session"], chunk)
        .groupBy("_session", key)
        .agg(
            F.min("ts").alias("start"),
            F.max("ts").alias("last"),
            F.count(F.lit(1)).alias("events"),
            F.max("_closes").alias("closed"),
        )
        .select(
            key,
            "start",
            F.col("last").alias("end"),
            ((F.unix_micros("last") - F.unix_micros("start")) / 1_000_000).alias("duration_seconds"),
            "events",
            "closed",
        )
    )


def session_windows(events: DataFrame, key: str, gap_seconds: int) -> DataFrame:
    """The same by Spark's own window type, for streams (needs a watermark there).
    ``end`` is the close of the window, one gap after the last event."""
    return (
        events.groupBy(key, F.session_window("ts", f"{gap_seconds} seconds").alias("w"))
        .agg(F.count(F.lit(1)).alias("events"))
        .select(key, F.col("w.start").alias("start"), F.col("w.end").alias("end"), "events")
    )
