"""Streaming jobs.  Functions take and return streaming frames; the runners at the
end start them with a checkpoint."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marketlake.operators import clicks, text
from marketlake.sources.lake import LakeTable


# Files per micro-batch, so that a backlog comes in pieces.
FILES_PER_BATCH = "1000"


def file_stream(spark: SparkSession, folder: str, schema: str, fmt: str = "parquet", **options: str) -> DataFrame:
    options = {"maxFilesPerTrigger": FILES_PER_BATCH, **options}
    return spark.readStream.format(fmt).options(**options).schema(schema).load(folder)


def table_stream(spark: SparkSession, folder: str, table: str, schema: str) -> DataFrame:
    """Rows of the parquet table ``table`` in a folder, whether it is one file or many."""
    # a glob of one alternative: as a plain path, a single file is no base path for a stream
    return file_stream(spark, f"{folder.rstrip('/')}/{{{table}.parquet}}", schema)


def word_counts(lines: DataFrame) -> DataFrame:
    """Running count per word; use complete or update mode."""
    return text.word_counts(lines)


def word_windows(events: DataFrame, word: str, size: str, slide: str, late: str) -> DataFrame:
    """Sliding counts that accept rows up to ``late`` behind the newest one."""
    return clicks.word_windows(events.withWatermark("ts", late), word, size, slide)


def session_windows(events: DataFrame, key: str, gap: str, late: str) -> DataFrame:
    """A session comes out once the watermark has passed its end."""
    counted = (
        events.withWatermark("ts", late)
        .groupBy(key, F.session_window("ts", gap).alias("w"))
        .agg(F.count(F.lit(1)).alias("events"))
    )
    start, end = F.col("w.start"), F.col("w.end")
    # with a dynamic start, the window itself reaches one gap past the last event
    return counted.select(
        key, start.alias("start"), end.alias("end"),
        ((F.unix_millis(end) - F.unix_millis(start)) / 1000).alias("seconds"), "events",
    )


def sentiment(lines: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Stream-static join of the words with their scores, then a running total."""
    tokens = lines.select(F.explode(F.split("text", "[ \n]")).alias("word"))
    scored = tokens.join(lexicon, "word")
    return scored.groupBy("word").agg(
        F.count(F.lit(1)).alias("n"), F.sum("score").cast("bigint").alias("sentiment")
    )


def error_rates(events: DataFrame, areas: DataFrame, late: str) -> DataFrame:
    """Windowed error share per area; ``areas``: user_id and ``area``, static."""
    located = events.withWatermark("ts", late).join(areas, "user_id")
    return clicks.error_rates(located, "area")


def active_users(events: DataFrame, late: str) -> DataFrame:
    """Distinct users cannot be counted exactly in a streaming aggregate, so users
    are made distinct per window first."""
    seen = (
        events.withWatermark("ts", late)
        .select(F.window("ts", clicks.ACTIVE_WINDOW, clicks.ACTIVE_SLIDE).alias("w"), "user_id")
        .dropDuplicates(["w", "user_id"])
    )
    return seen.groupBy("w").agg(F.count(F.lit(1)).alias("users")).select(
        F.col("w.start").alias("start"), F.col("w.end").alias("end"), "users"
    )


def lines_matching(streams: list[DataFrame], pattern: str) -> DataFrame:
    return text.lines_matching(streams, pattern)


# --- micro-batch sinks ---------------------------------------------------------------


def replace_table(path: str) -> Callable[[DataFrame, int], None]:
    """For complete mode: every batch is the whole result."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    return write


def upsert_into(table: LakeTable) -> Callable[[DataFrame, int], None]:
    """For update mode: changed rows replace their older versions."""

    def write(batch: DataFrame, batch_id: int) -> None:
        table.merge(batch.withColumn("updated_at", F.lit(batch_id)), batch_id)

    return write


def without_excluded(path: str, excluded: DataFrame, word: str = "word"):
    """Count the words that are not on a list; how many were dropped is written
    beside each batch.  Every batch has its own folder, so a replay overwrites it."""

    def write(batch: DataFrame, batch_id: int) -> None:
        marked = batch.join(excluded.select(word).distinct().withColumn("_out", F.lit(True)), word, "left")
        marked = marked.persist()
        try:
            kept = marked.filter("_out IS NULL").groupBy(word).agg(F.count(F.lit(1)).alias("n"))
            kept.write.mode("overwrite").parquet(f"{path}/counts/batch={batch_id}")
            marked.agg(F.count(F.lit(1)).alias("seen"), F.count("_out").alias("dropped")).write.mode(
                "overwrite"
            ).parquet(f"{path}/counters/batch={batch_id}")
        finally:
            marked.unpersist()

    return write


def sql_over_batch(path: str, statement: str, view: str = "batch_rows"):
    """Run SQL text over each micro-batch, seen as a view."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.createOrReplaceTempView(view)
        batch.sparkSession.sql(statement).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return write


# --- runners ---------------------------------------------------------------------------


def start(
    stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append", **trigger
) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(sink)
        .outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": "10 seconds"}))
        .start()
    )


def run_available(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str, mode: str = "append") -> None:
    """Work off what is there, then stop."""
    start(stream, sink, checkpoint, mode, availableNow=True).awaitTermination()


def append_files(stream: DataFrame, path: str, checkpoint: str) -> None:
    """Append mode into parquet files, exactly once, for what is there now."""
    (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
        .awaitTermination()
    )
