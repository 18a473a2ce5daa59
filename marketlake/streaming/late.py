"""Windows and sessions of out-of-order input, with a side table of the rows that came too late.

Spark's own watermark drops late rows and says only how many groups it dropped.  These sinks
keep them.  Each is a ``foreachBatch`` callback whose state is a lake table; the watermark, the
greatest time of the batches before less the delay, is noted in the table's commits, in the same
step as the batch that moved it.  A replayed batch finds the same watermark, writes the same late
rows over its own folder, and changes nothing where it has been committed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketlake.operators.sessions import sessions
from marketlake.sources.commits import State
from marketlake.sources.lake import LakeTable, day_of, path_exists
from marketlake.streaming.stateful import seconds_of

_MARK = "watermark_us"


class _Sink:
    def __init__(self, root: str, delay: str):
        self.root, self.delay = root, seconds_of(delay) * 1_000_000

    @property
    def late_path(self) -> str:
        return f"{self.root}/late"

    def late(self, spark: SparkSession) -> DataFrame | None:
        """The rows that came too late, with their batch."""
        return spark.read.parquet(self.late_path) if path_exists(spark, self.late_path) else None

    def _set_aside(self, rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.late_path}/batch={batch_id}")

    def _moved(self, state: State, batch: DataFrame) -> dict[str, int]:
        """The watermark after a batch: it never goes back."""
        newest = batch.agg(F.unix_micros(F.max("ts"))).first()[0]
        marks = [state.consumed[_MARK]] if _MARK in state.consumed else []
        if newest is not None:
            marks.append(newest - self.delay)
        return {_MARK: max(marks)} if marks else {}


class WindowTotals(_Sink):
    """Counts per sliding window and ``key``.  A row is late for those of its windows that end
    at the watermark or before it; the others count it."""

    def __init__(self, root: str, key: str, size: str, slide: str, delay: str):
        super().__init__(root, delay)
        self.key, self.size, self.slide = key, size, slide

    @property
    def table(self) -> LakeTable:
        return LakeTable(f"{self.root}/windows", ("start", self.key), {"day": day_of("start")})

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, table = batch.sparkSession, self.table
        state = table.state(spark)
        if state.applied(batch_id):
            return
        batch = batch.persist()
        try:
            mark = state.consumed.get(_MARK)
            placed = batch.withColumn("w", F.window("ts", self.size, self.slide))
            placed = placed.withColumns({"start": F.col("w.start"), "end": F.col("w.end")}).drop("w")
            final = F.unix_micros("end") <= F.lit(mark) if mark is not None else F.lit(False)
            self._set_aside(placed.filter(final), batch_id)
            counted = placed.filter(~final).groupBy("start", "end", self.key).agg(F.count(F.lit(1)).alias("n"))
            known = table.read(spark)
            if known is not None:
                open_ = known.filter(F.unix_micros("end") > F.lit(mark)) if mark is not None else known
                counted = (
                    counted.unionByName(open_.select("start", "end", self.key, "n"))
                    .groupBy("start", "end", self.key)
                    .agg(F.sum("n").alias("n"))
                    # windows that the batch adds nothing to stay unwritten
                    .join(counted.select("start", self.key), ["start", self.key], "left_semi")
                )
            stamped = counted.withColumn("updated_at", F.lit(batch_id))
            table.merge(stamped, batch_id, self._moved(state, batch))
        finally:
            batch.unpersist()


class SessionTotals(_Sink):
    """Sessions per ``key`` with a gap.  A row is late if a session of its own would have ended
    at the watermark or before it.  Sessions that the watermark has passed move from the table of
    open ones, rewritten with each batch, to that of closed ones."""

    def __init__(self, root: str, key: str, gap: str, delay: str):
        super().__init__(root, delay)
        self.key, self.gap = key, seconds_of(gap)

    @property
    def open(self) -> LakeTable:
        return LakeTable(f"{self.root}/open", (self.key, "start"))

    @property
    def closed(self) -> LakeTable:
        return LakeTable(f"{self.root}/closed", (self.key, "start"), {"day": day_of("start")})

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        state = self.open.state(spark)
        if state.applied(batch_id):
            return
        batch = batch.persist()
        try:
            gap = self.gap * 1_000_000
            mark = state.consumed.get(_MARK)
            over = F.unix_micros("ts") + gap <= F.lit(mark) if mark is not None else F.lit(False)
            self._set_aside(batch.filter(over), batch_id)
            columns = [self.key, "start", "end", "events"]
            # a busy key's rows become sessions in chunks, before they meet the open ones
            found = sessions(batch.filter(~over), self.key, self.gap).select(*columns)
            known = self.open.read(spark)
            merged = found if known is None else self._joined(found.unionByName(known.select(*columns)))
            moved = self._moved(state, batch)
            after = moved.get(_MARK)
            done = F.unix_micros("end") + gap <= F.lit(after) if after is not None else F.lit(False)
            merged = merged.withColumn("updated_at", F.lit(batch_id)).persist()
            # closed ones first: a crash in between repeats them as they are
            self.closed.merge(merged.filter(done), batch_id)
            self.open.create(merged.filter(~done), batch_id, moved)
            merged.unpersist()
        finally:
            batch.unpersist()

    def _joined(self, parts: DataFrame) -> DataFrame:
        """Sessions less than a gap apart become one; few rows per key, as the events of a batch
        are sessions already."""
        order = Window.partitionBy(self.key).orderBy("start", "end")
        before = order.rowsBetween(Window.unboundedPreceding, -1)
        upto = F.max(F.unix_micros("end")).over(before)
        starts = upto.isNull() | (F.unix_micros("start") - upto >= self.gap * 1_000_000)
        return (
            parts.withColumn("_starts", starts.cast("int"))
            .withColumn("_session", F.sum("_starts").over(order))
            .groupBy(self.key, "_session")
            .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("events").alias("events"))
            .drop("_session")
        )
