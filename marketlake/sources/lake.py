"""Lake tables: parquet folders with keys, merged partition by partition.

Every write puts its files into a folder of its own and then appends one commit that names the
partitions which that folder holds from now on (``commits``).  A write that fails or is refused
leaves the table as it was, over all its partitions; readers of an older version go on reading
it, and ``read`` takes a version to go back to.

A merge rewrites the partitions its source touches and no others.  This needs the
partition of a row to follow from its keys; a table keyed by something else than
time (news) is partitioned by a hash of its keys.  Where the Delta package is
installed the same call runs Delta's own MERGE.

``changed`` is the feed of a table: the rows that differ from an older version, found by
comparing the partitions touched since with their older files."""

from __future__ import annotations

import importlib.util
import uuid
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.operators.zorder import curve
from marketlake.plans.serving import latest_version
from marketlake.session import cut_lineage, slice_count
from marketlake.sources.commits import Commit, CommitLog, ConcurrentWrite, State

_FOLDER = "_commit"
_NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def day_of_millis(column: str = "timestamp") -> Column:
    return F.to_date(F.timestamp_millis(F.col(column)))


def day_of(column: str = "timestamp") -> Column:
    return F.to_date(F.col(column))


def hash_bucket(*keys: str, buckets: int = 64) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def delta_available(spark: SparkSession) -> bool:
    return (
        importlib.util.find_spec("delta") is not None
        and "DeltaSparkSessionExtension" in spark.conf.get("spark.sql.extensions", "")
    )


@dataclass(frozen=True)
class LakeTable:
    """``partitions`` maps partition columns to the expression that derives them.  The rows of a
    ``wide`` table are long and their keys cheap to read, so a merge reads the keys first and
    deals out whole rows by key only where a key is repeated."""

    path: str
    keys: tuple[str, ...]
    partitions: dict[str, Column] = field(default_factory=dict)
    version: tuple[str, ...] = ("updated_at",)
    cluster_by: tuple[str, ...] = ()
    wide: bool = False

    # --- reading ---------------------------------------------------------------

    def log(self, spark: SparkSession) -> CommitLog:
        return CommitLog(spark, f"{self.path}/log")

    def state(self, spark: SparkSession, version: int | None = None) -> State:
        log = self.log(spark)
        return log.latest() if version is None else log.state(version)

    def history(self, spark: SparkSession) -> DataFrame | None:
        return self.log(spark).history()

    def last_operation(self, spark: SparkSession) -> Commit | None:
        log = self.log(spark)
        return log.commit(log.latest().version)

    @property
    def _data(self) -> str:
        return f"{self.path}/data"

    def _folder(self, commit: str) -> str:
        return f"{self._data}/{_FOLDER}={commit}"

    def _rows(self, spark: SparkSession, state: State, only: Iterable[str] | None = None) -> DataFrame:
        """The partitions of a state, or some of them, each from its own folder.  The schema
        comes from the log, so older partitions need no footer scan to learn of new columns."""
        chosen = state.partitions if only is None else state.partitions.keys() & set(only)
        paths = [f"{self._folder(state.partitions[p])}/{p}".rstrip("/") for p in sorted(chosen)]
        if not paths:
            return spark.createDataFrame([], state.schema)
        return (
            spark.read.schema(f"{state.schema}, `{_FOLDER}` STRING")
            .option("basePath", self._data)
            .parquet(*paths)
            .drop(_FOLDER)
        )

    def read(self, spark: SparkSession, version: int | None = None) -> DataFrame | None:
        """The table, now or as it was at a version; None before the first write."""
        state = self.state(spark, version)
        return None if state.schema is None else self._rows(spark, state)

    def changed(
        self, spark: SparkSession, since: int = 0, upto: int | None = None
    ) -> DataFrame | None:
        """Rows of version ``upto`` (the newest) that are new or other than at version
        ``since``, in columns besides the version columns; None if nothing has been written
        in between.  Reads the partitions touched meanwhile only.  Where older files have been
        vacuumed, all rows of these partitions count."""
        log = self.log(spark)
        state = log.latest() if upto is None else log.state(upto)
        moved: set[str] = set()
        for commit in log.commits(since, state.version):
            if commit.operation != "COMPACT":
                moved |= state.partitions.keys() if commit.whole else set(commit.touched)
        if not moved:
            return None
        rows = self._rows(spark, state, moved)
        before = log.state(since)
        then = moved & before.partitions.keys()
        folders = {before.partitions[p] for p in then}
        if not then or not all(path_exists(spark, self._folder(f)) for f in folders):
            return rows
        old = self._rows(spark, before, then)
        return differing(rows, old, self.keys, (*self.version, *self.partitions))

    def applied(self, spark: SparkSession, batch_id: int) -> bool:
        return self.state(spark).applied(batch_id)

    # --- writing ---------------------------------------------------------------

    def _partitioned(self, df: DataFrame) -> DataFrame:
        return df.withColumns(self.partitions) if self.partitions else df

    def _write(self, df: DataFrame, commit: str, evenly: bool = True) -> list[str]:
        """Write a folder of its own; returns the paths of the partitions in it."""
        spark, folder = df.sparkSession, self._folder(commit)
        if evenly:
            df = self._spread(df)
        df.write.partitionBy(*self.partitions).parquet(folder)
        root = spark._jvm.org.apache.hadoop.fs.Path(folder)
        fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
        found = [(root, "")]
        for name in self.partitions:
            found = [
                (s.getPath(), f"{path}/{s.getPath().getName()}".lstrip("/"))
                for place, path in found
                for s in fs.listStatus(place)
                if s.getPath().getName().startswith(f"{name}=")
            ]
        return sorted(path for _, path in found)

    def _drop_folder(self, spark: SparkSession, commit: str) -> str:
        path = spark._jvm.org.apache.hadoop.fs.Path(self._folder(commit))
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        return path.toString()

    def _append(self, spark: SparkSession, base: State, commit: Commit) -> None:
        try:
            self.log(spark).append(base, commit)
        except ConcurrentWrite:
            self._drop_folder(spark, commit.folder)
            raise

    def _spread(self, df: DataFrame) -> DataFrame:
        """Few files per partition, and several writers for a very large one.  AQE
        does that; inside a stateful stream it is off, and ranges of the keys do."""
        names = list(self.partitions)
        if not names:
            return df
        spark = df.sparkSession
        if spark.conf.get("spark.sql.adaptive.enabled") == "true":
            return df.hint("rebalance", *names)
        return df.repartitionByRange(slice_count(spark), *names, *self.keys)

    # Row counts come from parquet footers, read back after the write.  (Observation
    # objects would count on the way, but a session that has used one can no longer
    # serialise some ML models.)

    def create(
        self,
        df: DataFrame,
        batch_id: int | None = None,
        consumed: dict[str, int] | None = None,
    ) -> None:
        """First write, or full refresh of an existing table."""
        spark = df.sparkSession
        base = self.state(spark)
        out, folder = self._partitioned(df), uuid.uuid4().hex
        touched = self._write(out, folder)
        rows = spark.read.schema(out.schema).parquet(self._folder(folder)).count()
        schema = _schema_text(out)
        commit = Commit(
            "CREATE", folder, touched, schema, True, batch_id, rows, 0, rows, {}, consumed or {}
        )
        self._append(spark, base, commit)

    def merge(
        self,
        source: DataFrame,
        batch_id: int | None = None,
        consumed: dict[str, int] | None = None,
    ) -> None:
        """Update rows whose keys exist, insert the others.

        The source may repeat keys (the newest version wins) and may bring new
        columns or lack some; replaying a ``batch_id`` changes nothing.  ``consumed`` notes
        the versions of other tables that the source was made from."""
        spark = source.sparkSession
        base = self.state(spark)
        if batch_id is not None and base.applied(batch_id):
            return
        if self.wide and base.schema is not None:
            source = cut_lineage(source)  # its keys are read before its rows
        newest = self._newest(source)
        if delta_available(spark):
            return self._merge_delta(newest)
        if base.schema is None:
            return self.create(newest, batch_id, consumed)
        newest = self._partitioned(newest)
        if not self.wide:
            newest = cut_lineage(newest)  # used several times below: compute it once, durably
        target = self._rows(spark, base, self._met(newest, base))
        old, incoming = target.count(), newest.count()
        kept = target.join(newest.select(*self.keys), list(self.keys), "left_anti")
        merged = kept.unionByName(newest, allowMissingColumns=True)
        folder = uuid.uuid4().hex
        touched = self._write(merged, folder)
        written = spark.read.schema(merged.schema).parquet(self._folder(folder)).count()
        inserted = written - old
        commit = Commit(
            "MERGE",
            folder,
            touched,
            _schema_text(merged),
            False,
            batch_id,
            written,
            incoming - inserted,
            inserted,
            {"keys": ",".join(self.keys)},
            consumed or {},
        )
        self._append(spark, base, commit)

    def _newest(self, source: DataFrame) -> DataFrame:
        """The newest version of every key."""
        keys = list(self.keys)
        if not self.wide:
            return latest_version(source, keys, *self.version)
        counted = source.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
        again = cut_lineage(counted.filter("_n > 1").select(*keys))
        if again.isEmpty():
            return source
        same = [F.col(f"new.`{k}`").eqNullSafe(F.col(f"again.`{k}`")) for k in keys]
        once, more = (
            source.alias("new").join(again.alias("again"), same, how) for how in ("left_anti", "left_semi")
        )
        return once.unionByName(cut_lineage(latest_version(more, keys, *self.version)))

    def _met(self, source: DataFrame, state: State) -> list[str]:
        """Partitions of the state that the source writes to.  One row per partition reaches
        the driver, as in the log."""
        names = list(self.partitions)
        if not names:
            return list(state.partitions)
        rows = source.select(*[F.col(n).cast("string") for n in names]).distinct().collect()
        if any(r[0] is None for r in rows):
            raise ValueError(f"{self.path}: a row without {names[0]} (are its keys null?)")
        wanted = {tuple(_NULL_PARTITION if v is None else v for v in r) for r in rows}
        return [p for p in state.partitions if _values(p) in wanted]

    def vacuum(self, spark: SparkSession, versions: int = 1) -> list[str]:
        """Delete the folders that none of the newest ``versions`` versions reads, those of
        failed writes among them; returns their paths.  Not while somebody may still read an
        older state, or while a write is under way."""
        log = self.log(spark)
        last = log.latest().version
        if last == 0:
            return []
        held: set[str] = set()
        for version in range(max(1, last - versions + 1), last + 1):
            held |= set(log.state(version).partitions.values())
        root = spark._jvm.org.apache.hadoop.fs.Path(self._data)
        fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.listStatus(root)]
        commits = [n.partition("=")[2] for n in names if n.startswith(f"{_FOLDER}=")]
        return [self._drop_folder(spark, c) for c in commits if c not in held]

    def _merge_delta(self, source: DataFrame) -> None:
        from delta.tables import DeltaTable

        spark = source.sparkSession
        source = self._partitioned(source)
        if not DeltaTable.isDeltaTable(spark, self.path):
            source.write.format("delta").partitionBy(*self.partitions).save(self.path)
            return
        on = [*self.keys, *[p for p in self.partitions if p not in self.keys]]
        condition = " AND ".join(f"kept.`{c}` = incoming.`{c}`" for c in on)
        (
            DeltaTable.forPath(spark, self.path)
            .alias("kept")
            .merge(source.alias("incoming"), condition)
            .withSchemaEvolution()
            .whenMatchedUpdateAll()
            .whenNotMatchedInsertAll()
            .execute()
        )

    def compact(
        self,
        spark: SparkSession,
        files: int | None = None,
        where: Column | None = None,
        zorder: Sequence[str] = (),
    ) -> None:
        """Rewrite the table, or the partitions in which ``where`` holds for a row, as few
        files sorted by the cluster columns, so that their min/max statistics let scans skip
        files.  With ``zorder`` the files follow a space-filling curve over these columns
        instead, so that a filter on any of them skips files, not only one on the first.

        Range partitioning splits a big partition over several tasks."""
        base = self.state(spark)
        if base.schema is None:
            return
        chosen = list(base.partitions)
        if where is not None and self.partitions:
            chosen = self._met(self._rows(spark, base).filter(where), base)
        rows = self._rows(spark, base, chosen)
        order = list(dict.fromkeys([*self.partitions, *(self.cluster_by or self.keys)]))
        if zorder:
            rows = rows.withColumn("_curve", curve(rows, zorder))
            order = [*self.partitions, "_curve"]
        sorted_rows = rows.repartitionByRange(files or slice_count(spark), *order).sortWithinPartitions(
            *order
        )
        folder = uuid.uuid4().hex
        touched = self._write(sorted_rows.drop("_curve"), folder, evenly=False)
        written = spark.read.schema(base.schema).parquet(self._folder(folder)).count()
        how = {"zorder": ",".join(zorder)} if zorder else {"cluster_by": ",".join(order)}
        commit = Commit(
            "COMPACT", folder, touched, base.schema, False, None, written, parameters=how
        )
        self._append(spark, base, commit)


def differing(
    rows: DataFrame, old: DataFrame, keys: Sequence[str], ignored: Sequence[str] = ()
) -> DataFrame:
    """Rows whose keys are not in ``old``, or that differ from it in another column."""
    same = [F.col(f"new.`{k}`") == F.col(f"old.`{k}`") for k in keys]
    for c in rows.columns:
        if c not in (*keys, *ignored):
            other = F.col(f"old.`{c}`") if c in old.columns else F.lit(None)
            same.append(F.col(f"new.`{c}`").eqNullSafe(other))
    return rows.alias("new").join(old.alias("old"), same, "left_anti")


def _schema_text(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)


def _values(path: str) -> tuple[str, ...]:
    """Partition values as text, from a path like day=2024-01-01/hour=3."""
    return tuple(unquote(part.partition("=")[2]) for part in path.split("/") if part)
