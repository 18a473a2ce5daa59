"""File jobs: read and write the common formats, and managed or external tables."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# fixed options per format; callers may override them
READ_DEFAULTS = {
    "csv": {"header": "true", "multiLine": "false", "mode": "PERMISSIVE"},
    "json": {"mode": "PERMISSIVE"},
    "parquet": {},
    "orc": {},
    "text": {},
    "binaryFile": {},
    "jdbc": {},
}
WRITE_DEFAULTS = {"csv": {"header": "true"}}


def ingest(
    spark: SparkSession,
    path: str | Sequence[str] | None,
    fmt: str,
    schema: str | None = None,
    glob: str | None = None,
    recursive: bool = False,
    modified_after: str | None = None,
    modified_before: str | None = None,
    skip_corrupt_files: bool = False,
    merge_schema: bool = False,
    **options: str,
) -> DataFrame:
    """Read files (or a JDBC source, ``path=None``).  Without a schema the format's
    own inference runs, which for CSV and JSON costs an extra pass."""
    chosen = {**READ_DEFAULTS[fmt], **options}
    if fmt in ("csv", "json") and schema is None and fmt == "csv":
        chosen.setdefault("inferSchema", "true")
    if glob:
        chosen["pathGlobFilter"] = glob
    if recursive:
        chosen["recursiveFileLookup"] = "true"
    if modified_after:
        chosen["modifiedAfter"] = modified_after
    if modified_before:
        chosen["modifiedBefore"] = modified_before
    if skip_corrupt_files:
        chosen["ignoreCorruptFiles"] = "true"
    if merge_schema:
        chosen["mergeSchema"] = "true"
    reader = spark.read.format(fmt).options(**chosen)
    if schema is not None:
        reader = reader.schema(schema)
    if path is None:
        return reader.load()
    return reader.load(path if isinstance(path, str) else list(path))


def export(
    df: DataFrame, path: str, fmt: str, mode: str = "error", partition_by: Sequence[str] = (), **options: str
) -> None:
    """Write files.  Partitioned output is rebalanced first: a partition value gets
    few files, and a very large one is still written by several tasks."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    writer = df.write.format(fmt).mode(mode).options(**{**WRITE_DEFAULTS.get(fmt, {}), **options})
    (writer.partitionBy(*partition_by) if partition_by else writer).save(path)


def save_bucketed(
    df: DataFrame, table: str, path: str, keys: Sequence[str], buckets: int, sort_by: Sequence[str] = (), mode: str = "error"
) -> None:
    """External table hashed into buckets: joins and groups on the keys skip their
    shuffle.  Rows are moved to their bucket first, so each bucket is one file."""
    placed = df.repartition(buckets, *keys)
    writer = placed.write.format("parquet").mode(mode).bucketBy(buckets, *keys)
    if sort_by:
        writer = writer.sortBy(*sort_by)
    writer.option("path", path).saveAsTable(table)


def bucket_count(*tables: DataFrame, least: int = 8, rows: int = 2_000_000) -> int:
    """Buckets for tables that are joined on their buckets: one holds about ``rows`` rows of the
    largest at most, so a task's memory does not grow with the tables."""
    return max(least, *[math.ceil(t.count() / rows) for t in tables])


def external_table(spark: SparkSession, table: str, path: str, fmt: str, schema: str, partitions: Sequence[str] = ()) -> DataFrame:
    """Table over existing files; partition folders are found and registered."""
    by = f" PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({schema}) USING {fmt}{by} LOCATION '{path}'")
    if partitions:
        spark.catalog.recoverPartitions(table)
    return spark.table(table)


def managed_table(df: DataFrame, table: str, partitions: Sequence[str] = (), mode: str = "overwrite") -> DataFrame:
    df.write.format("parquet").mode(mode).saveAsTable(table, partitionBy=list(partitions) or None)
    return df.sparkSession.table(table)


def load_into(df: DataFrame, table: str, overwrite: bool = False) -> None:
    """Insert by position into an existing table."""
    df.write.insertInto(table, overwrite=overwrite)


def temp_view(df: DataFrame, name: str, everywhere: bool = False) -> str:
    """Register a view for this session, or for all sessions of the application."""
    if everywhere:
        df.createOrReplaceGlobalTempView(name)
        return f"global_temp.{name}"
    df.createOrReplaceTempView(name)
    return name
