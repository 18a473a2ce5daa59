"""Reading keyed tables, lake tables and the driver's parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.session import pin_runtime


def driver_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the parquet test tables; zone-less timestamps become UTC instants."""
    pin_runtime(spark)
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    naive = [f.name for f in df.schema.fields if f.dataType.typeName() == "timestamp_ntz"]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in naive}) if naive else df


def read_table(
    spark: SparkSession,
    namespace: str,
    table: str,
    fmt: str = "parquet",
    options: dict[str, str] | None = None,
) -> DataFrame:
    """Scan a table of the serving store.

    With a connector format (say a wide-column store) the names go in as
    options; with a file format they form the path below ``options['root']``."""
    options = dict(options or {})
    root = options.pop("root", None)
    reader = spark.read.format(fmt).options(**options)
    if root is not None:
        return reader.load(f"{root.rstrip('/')}/{namespace}/{table}")
    return reader.options(keyspace=namespace, table=table).load()
