"""Streaming ingest: one micro-batch, three message families, one merge each."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marketlake.plans import tables
from marketlake.plans.layers import stamped
from marketlake.sources import messages

STREAM_SCHEMA = "topic STRING, value BINARY"


def message_stream(
    spark: SparkSession, fmt: str, options: dict[str, str], path: str | None = None
) -> DataFrame:
    """(topic, value) rows.  ``fmt`` is kafka in production (options such as
    ``subscribe``, ``kafka.bootstrap.servers``); any file format works too.  Batches are
    bounded unless the options say otherwise."""
    bound = {"maxOffsetsPerTrigger": "5000000"} if fmt == "kafka" else {"maxFilesPerTrigger": "1000"}
    reader = spark.readStream.format(fmt).options(**{**bound, **options})
    if fmt == "kafka":
        reader = reader.option("failOnDataLoss", options.get("failOnDataLoss", "false"))
        return reader.load().select("topic", "value")
    return reader.schema(STREAM_SCHEMA).load(path)


class Router:
    """``foreachBatch`` callback that lands every message family in the lake.

    Delivery is at least once: merges are keyed, and each table remembers the
    batches it has taken, so a replay is harmless."""

    def __init__(self, root: str, symbols: Sequence[str], at: dt.datetime | None = None):
        self.root = root
        self.symbols = [s.lower() for s in symbols]
        self.at = at

    def families(self):
        return [
            (self.symbols, messages.parse_prices, tables.price_table(self.root, "bronze")),
            (
                [*messages.INDICATOR_TOPICS, messages.MACD_TOPIC],
                messages.parse_indicators,
                tables.indicator_table(self.root, "bronze"),
            ),
            ([messages.QUOTE_TOPIC], messages.parse_quotes, tables.quote_table(self.root)),
        ]

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()
        try:
            known = [t for topics, _, _ in self.families() for t in topics]
            present = {r[0] for r in messages.of_topics(batch, known).select("topic").distinct().collect()}
            for topics, parse, table in self.families():
                wanted = [t for t in topics if t in present]
                if not wanted or table.applied(batch.sparkSession, batch_id):
                    continue
                # parsed once for both outputs
                parsed = parse(messages.of_topics(batch, wanted)).persist()
                split = messages.split_valid(parsed, table.keys)
                self._reject(split.rejected, table.path, batch_id)
                table.merge(stamped(split.valid, self.at), batch_id)
                parsed.unpersist()
        finally:
            batch.unpersist()

    def quarantine_path(self) -> str:
        return f"{self.root}/quarantine"

    def _reject(self, rejected: DataFrame, table: str, batch_id: int) -> None:
        """A replayed batch overwrites its own folder."""
        family = table.rsplit("/", 1)[-1]
        rejected.withColumns({"family": F.lit(family), "batch_id": F.lit(batch_id)}).write.mode(
            "overwrite"
        ).partitionBy("family", "batch_id").parquet(self.quarantine_path())

    def start(self, stream: DataFrame, checkpoint: str, **trigger) -> StreamingQuery:
        return (
            stream.writeStream.foreachBatch(self)
            .outputMode("append")
            .option("checkpointLocation", checkpoint)
            .trigger(**(trigger or {"processingTime": "10 seconds"}))
            .start()
        )
