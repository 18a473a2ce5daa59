"""Session set-up, and the one place that decides where durable scratch data goes."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on.  Cluster sizing (executors, memory, number of
# shuffle partitions) belongs to spark-submit and is left alone.
RUNTIME_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


# Only a new session takes these: files of checkpoints nobody refers to any more go.
START_DEFAULTS = {"spark.cleaner.referenceTracking.cleanCheckpoints": "true"}


def build_session(
    app_name: str = "marketlake",
    master: str | None = None,
    settings: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or fetch) a session.  Stores, catalogs and credentials arrive in
    ``settings``; nothing secret is kept in code."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**START_DEFAULTS, **RUNTIME_DEFAULTS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_runtime(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for key, value in RUNTIME_DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder that all executors can reach, for checkpoints and scratch tables.

    The cluster names it in ``spark.checkpoint.dir``.  A temporary folder is
    used only when the whole of Spark runs inside this one process."""
    sc = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        named = tempfile.mkdtemp(prefix="marketlake-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(named)
    return named


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: the rows survive the loss of any executor."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def cut_by_key(df: DataFrame, key: str) -> DataFrame:
    """Reliable checkpoint, dealt and sorted by a key: loops that join or group on the key
    read it where it lies, round after round.

    Adaptive plans don't tell how their rows are dealt, so it is made without them."""
    return cut_as_dealt(df.repartition(slice_count(df.sparkSession), key).sortWithinPartitions(key))


def cut_as_dealt(df: DataFrame) -> DataFrame:
    """Reliable checkpoint of rows that lie dealt and sorted as the plan has it."""
    spark = df.sparkSession
    shared_folder(spark)
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return df.checkpoint(eager=True)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def release(spark: SparkSession) -> None:
    """Files of shuffles and checkpoints that nobody refers to any more go now, not when the
    driver's memory happens to be full."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def slice_count(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
