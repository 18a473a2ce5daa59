import datetime as dt

import pytest
from pyspark.sql import functions as F

from marketlake.operators import zorder
from marketlake.plans import tables
from marketlake.sources.commits import Commit, CommitLog, ConcurrentWrite
from marketlake.sources.lake import LakeTable, day_of_millis, hash_bucket

UTC = dt.timezone.utc
T1, T2 = dt.datetime(2024, 2, 1, tzinfo=UTC), dt.datetime(2024, 2, 2, tzinfo=UTC)
DAY = 86_400_000
SCHEMA = "symbol string, timestamp long, close double, updated_at timestamp"


def table(root):
    return LakeTable(f"{root}/price", ("symbol", "timestamp"), {"day": day_of_millis()})


def rows_of(lake, spark):
    return sorted((r.symbol, r.timestamp, r.close) for r in lake.read(spark).collect())


def test_first_merge_creates_and_second_updates_and_inserts(spark, root):
    lake = table(root)
    assert lake.read(spark) is None
    lake.merge(spark.createDataFrame([("a", 0, 1.0, T1), ("a", DAY, 2.0, T1), ("b", 0, 3.0, T1)], SCHEMA))
    lake.merge(spark.createDataFrame([("a", 0, 9.0, T2), ("c", 2 * DAY, 4.0, T2)], SCHEMA))
    assert rows_of(lake, spark) == [("a", 0, 9.0), ("a", DAY, 2.0), ("b", 0, 3.0), ("c", 2 * DAY, 4.0)]
    last = lake.last_operation(spark)
    assert (last.operation, last.updated, last.inserted) == ("MERGE", 1, 1)


def test_merging_twice_equals_once_and_disjoint_order_does_not_matter(spark, root):
    one = spark.createDataFrame([("a", 0, 1.0, T1), ("a", DAY, 2.0, T1)], SCHEMA)
    two = spark.createDataFrame([("b", 0, 5.0, T1), ("b", DAY, 6.0, T1)], SCHEMA)
    left, right = table(f"{root}/l"), table(f"{root}/r")
    for df in (one, one, two):
        left.merge(df)
    for df in (two, one):
        right.merge(df)
    assert rows_of(left, spark) == rows_of(right, spark)
    assert len(rows_of(left, spark)) == 4


def test_newest_version_wins_inside_a_source(spark, root):
    lake = table(root)
    lake.merge(spark.createDataFrame([("a", 0, 1.0, T2), ("a", 0, 7.0, T1)], SCHEMA))
    lake.merge(spark.createDataFrame([("a", 0, 2.0, T1), ("a", 0, 3.0, T2)], SCHEMA))
    assert rows_of(lake, spark) == [("a", 0, 3.0)]


def test_new_and_missing_columns(spark, root):
    lake = table(root)
    lake.merge(spark.createDataFrame([("a", 0, 1.0, T1), ("z", 5 * DAY, 1.5, T1)], SCHEMA))
    wide = spark.createDataFrame([("a", DAY, 2.0, 10, T2)], "symbol string, timestamp long, close double, volume long, updated_at timestamp")
    lake.merge(wide)
    lake.merge(spark.createDataFrame([("b", 0, T2)], "symbol string, timestamp long, updated_at timestamp"))
    got = {(r.symbol, r.timestamp): (r.close, r.volume) for r in lake.read(spark).collect()}
    assert got == {
        ("a", 0): (1.0, None),
        ("a", DAY): (2.0, 10),
        ("b", 0): (None, None),
        ("z", 5 * DAY): (1.5, None),
    }


def test_merge_leaves_other_partitions_alone(spark, root):
    lake = table(root)
    lake.merge(spark.createDataFrame([("a", d * DAY, 1.0, T1) for d in range(5)], SCHEMA))
    file = F.input_file_name().alias("f")
    before = {r.timestamp: r.f for r in lake.read(spark).select("timestamp", file).collect()}
    lake.merge(spark.createDataFrame([("a", 2 * DAY, 8.0, T2)], SCHEMA))
    after = {r.timestamp: r.f for r in lake.read(spark).select("timestamp", file).collect()}
    assert {t for t in before if before[t] != after[t]} == {2 * DAY}


def test_batch_replay_is_ignored(spark, root):
    lake = table(root)
    lake.merge(spark.createDataFrame([("a", 0, 1.0, T1)], SCHEMA), batch_id=0)
    lake.merge(spark.createDataFrame([("a", 0, 2.0, T2)], SCHEMA), batch_id=0)
    assert rows_of(lake, spark) == [("a", 0, 1.0)]


def test_compaction_keeps_rows_and_sorts_files(spark, root):
    lake = table(root)
    for k in range(3):
        lake.merge(spark.createDataFrame([(s, k, float(k), T1) for s in "abc"], SCHEMA))
    before = rows_of(lake, spark)
    lake.compact(spark, files=1)
    assert rows_of(lake, spark) == before
    assert lake.read(spark).inputFiles().__len__() == 1
    assert lake.last_operation(spark).operation == "COMPACT"


def test_unpartitioned_table(spark, root):
    lake = LakeTable(f"{root}/flat", ("symbol",))
    lake.merge(spark.createDataFrame([("a", 0, 1.0, T1)], SCHEMA))
    lake.merge(spark.createDataFrame([("a", 0, 2.0, T2), ("b", 0, 3.0, T2)], SCHEMA))
    assert rows_of(lake, spark) == [("a", 0, 2.0), ("b", 0, 3.0)]


def test_full_refresh_replaces_everything(spark, root):
    lake = table(root)
    lake.create(spark.createDataFrame([("a", 0, 1.0, T1), ("a", DAY, 1.0, T1)], SCHEMA))
    lake.create(spark.createDataFrame([("b", 0, 2.0, T1)], SCHEMA))
    assert rows_of(lake, spark) == [("b", 0, 2.0)]


def test_history_outlives_refresh_and_rewrites(spark, root):
    lake = table(root)
    lake.create(spark.createDataFrame([("a", 0, 1.0, T1)], SCHEMA), batch_id=1)
    lake.merge(spark.createDataFrame([("a", 0, 2.0, T2)], SCHEMA), batch_id=2)
    lake.create(spark.createDataFrame([("b", 0, 2.0, T1)], SCHEMA), batch_id=3)
    assert lake.history(spark).count() == 3
    assert all(lake.applied(spark, b) for b in (1, 2, 3))
    assert len(lake.vacuum(spark)) == 2  # a folder for each of the writes before
    assert rows_of(lake, spark) == [("b", 0, 2.0)]
    flat = LakeTable(f"{root}/flat", ("symbol",))
    for k in range(3):
        flat.merge(spark.createDataFrame([("a", k, 1.0, T1)], SCHEMA))
    assert flat.history(spark).count() == 3
    flat.compact(spark, where=F.col("symbol") == "none")
    assert flat.read(spark).count() == 1


def test_news_merge_keeps_one_row_per_article_or_all_versions(spark, root):
    schema = "id string, title string, updated_at timestamp"
    first = spark.createDataFrame([("n1", "old", T1), ("n2", "x", T1)], schema)
    second = spark.createDataFrame([("n1", "new", T2)], schema)
    single, versions = tables.news_table(root, "bronze"), tables.news_versions_table(root)
    for lake in (single, versions):
        lake.merge(first)
        lake.merge(second)
    assert sorted((r.id, r.title) for r in single.read(spark).collect()) == [("n1", "new"), ("n2", "x")]
    assert versions.read(spark).count() == 3


def test_news_without_repeated_ids_is_not_dealt_by_id(spark, root, monkeypatch):
    """Long rows are dealt out once, by bucket; ids alone tell that there is nothing to choose."""
    monkeypatch.setattr("marketlake.sources.lake.latest_version", None)
    lake = tables.news_table(root, "bronze")
    schema = "id string, title string, updated_at timestamp"
    lake.merge(spark.createDataFrame([(f"n{k}", "old", T1) for k in range(9)], schema))
    lake.merge(spark.createDataFrame([(f"n{k}", "new", T2) for k in range(6, 12)], schema))
    got = {r.id: r.title for r in lake.read(spark).collect()}
    assert got == {f"n{k}": "new" if k >= 6 else "old" for k in range(12)}


def test_a_wide_merge_keeps_the_newest_of_repeated_keys(spark, root):
    schema = "id string, title string, updated_at timestamp"
    first = [("a", "old", T1), ("a", "new", T2), ("b", "b", T1), (None, "old", T1), (None, "new", T2)]
    second = [("a", "late", T1), ("c", "new", T2), ("c", "old", T1), ("d", "d", T1)]
    found = []
    for wide in (False, True):
        lake = LakeTable(f"{root}/{wide}", ("id",), {"bucket": hash_bucket("id")}, wide=wide)
        for rows in (first, second):
            lake.merge(spark.createDataFrame(rows, schema))
        found.append(sorted(((r.id, r.title) for r in lake.read(spark).collect()), key=str))
    assert found[0] == found[1] and len(found[1]) == 5
    assert {("a", "late"), (None, "new"), ("c", "new")} <= set(found[1])


# --- commits: versions, feeds, concurrent writers ---------------------------------------


def test_a_failed_merge_leaves_the_old_rows(spark, root):
    lake = table(root)
    lake.merge(spark.createDataFrame([("a", d * DAY, 1.0, T1) for d in range(3)], SCHEMA))
    before = rows_of(lake, spark)
    broken = spark.createDataFrame([("a", d * DAY, 9.0, T2) for d in range(3)], SCHEMA).withColumn(
        "close", F.when(F.col("timestamp") == DAY, F.raise_error(F.lit("lost"))).otherwise(F.col("close"))
    )
    with pytest.raises(Exception, match="lost"):
        lake.merge(broken)
    assert rows_of(lake, spark) == before
    assert lake.state(spark).version == 1


def test_older_versions_stay_readable(spark, root):
    lake = table(root)
    for k in range(12):  # past a checkpoint of the log
        lake.merge(spark.createDataFrame([("a", 0, float(k), T1), (f"s{k}", k * DAY, 0.5, T1)], SCHEMA))
    for k in (0, 4, 9, 10, 11):
        old = lake.read(spark, version=k + 1)
        assert old.filter("symbol = 'a'").first().close == float(k)
        assert old.count() == k + 2
    with pytest.raises(LookupError):
        lake.read(spark, version=13)


def test_reads_open_few_files_of_the_log(spark, root, monkeypatch):
    lake = table(root)
    for k in range(11):
        lake.merge(spark.createDataFrame([("a", 0, float(k), T1)], SCHEMA), batch_id=k)
    opened = []
    real = CommitLog._read
    monkeypatch.setattr(CommitLog, "_read", lambda self, name: opened.append(name) or real(self, name))
    assert lake.applied(spark, 10) and not lake.applied(spark, 11)
    assert opened[:2] == ["state/last.json", "state/000000000010.json"] and len(opened) <= 12
    assert lake.state(spark).batches == [[0, 10]]


def test_two_writers_of_one_partition(spark, root):
    """The second to commit is refused if it meets the first, and goes on if not."""
    lake = table(root)
    lake.create(spark.createDataFrame([("a", d * DAY, 1.0, T1) for d in range(2)], SCHEMA))
    log, base = lake.log(spark), lake.state(spark)
    first = lake._write(lake._partitioned(spark.createDataFrame([("a", 0, 2.0, T2)], SCHEMA)), "first")
    log.append(base, Commit("MERGE", "first", first, base.schema))
    same = Commit("MERGE", "second", ["day=1970-01-01"], base.schema)
    with pytest.raises(ConcurrentWrite, match="day=1970-01-01"):
        log.append(base, same)
    other = lake._write(lake._partitioned(spark.createDataFrame([("a", DAY, 3.0, T2)], SCHEMA)), "third")
    state = log.append(base, Commit("MERGE", "third", other, base.schema))
    assert state.version == 3
    assert rows_of(lake, spark) == [("a", 0, 2.0), ("a", DAY, 3.0)]
    for refused in (
        Commit("CREATE", "x", [], base.schema, whole=True),
        Commit("COMPACT", "x", other, base.schema),
    ):
        with pytest.raises(ConcurrentWrite):
            log.append(base, refused)
    # new columns of both: refused; of the first only: taken over
    lake.merge(spark.createDataFrame([("b", 5 * DAY, 1.0, 7, T2)], SCHEMA.replace(", updated", ", n int, updated")))
    with pytest.raises(ConcurrentWrite):
        log.append(state, Commit("MERGE", "x", ["day=1970-01-09"], base.schema + ", `m` int"))
    late = log.append(state, Commit("MERGE", "third", [], base.schema))
    assert "`n` int" in late.schema


def test_a_refused_merge_removes_its_files(spark, root, monkeypatch):
    lake = table(root)
    lake.create(spark.createDataFrame([("a", 0, 1.0, T1)], SCHEMA))
    write = LakeTable._write

    def overtaken(self, df, commit, evenly=True):
        touched = write(self, df, commit, evenly)
        monkeypatch.setattr(LakeTable, "_write", write)
        self.merge(spark.createDataFrame([("a", 0, 5.0, T2)], SCHEMA))
        return touched

    monkeypatch.setattr(LakeTable, "_write", overtaken)
    with pytest.raises(ConcurrentWrite):
        lake.merge(spark.createDataFrame([("a", 0, 9.0, T2)], SCHEMA))
    assert rows_of(lake, spark) == [("a", 0, 5.0)]
    assert len(lake.vacuum(spark)) == 1  # the folder of the first version


def test_feed_of_changed_rows(spark, root):
    lake = table(root)
    assert lake.changed(spark) is None
    lake.merge(spark.createDataFrame([("a", d * DAY, 1.0, T1) for d in range(4)], SCHEMA))
    first = lake.state(spark).version
    assert lake.changed(spark).count() == 4 and lake.changed(spark, first) is None
    lake.merge(spark.createDataFrame([("a", DAY, 1.0, T2), ("a", 2 * DAY, 5.0, T2), ("b", 2 * DAY, 1.0, T2)], SCHEMA))
    lake.compact(spark, files=1)
    found = sorted((r.symbol, r.timestamp, r.close) for r in lake.changed(spark, first).collect())
    assert found == [("a", 2 * DAY, 5.0), ("b", 2 * DAY, 1.0)]  # same row, newer stamp: no change
    assert lake.changed(spark, lake.state(spark).version - 1) is None  # compaction changes nothing
    assert lake.changed(spark, 0, first).count() == 4
    lake.vacuum(spark)
    assert lake.changed(spark, first).count() == 3  # all rows of the days touched
    wide = spark.createDataFrame([("c", 3 * DAY, 1.0, 2, T2)], SCHEMA.replace(", updated", ", n int, updated"))
    last = lake.state(spark).version
    lake.merge(wide)
    assert [r.symbol for r in lake.changed(spark, last).collect()] == ["c"]


def test_partition_names_with_odd_signs(spark, root):
    lake = LakeTable(f"{root}/odd", ("k",), {"part": F.col("name")}, version=("k",))
    names = ["a/b", "c=d", "e f", "100%", "ü", ""]
    lake.merge(spark.createDataFrame([(i, n, 1) for i, n in enumerate(names)], "k int, name string, v int"))
    lake.merge(spark.createDataFrame([(1, "c=d", 2), (3, "100%", 2)], "k int, name string, v int"))
    got = {r.k: (r.name, r.v) for r in lake.read(spark).collect()}
    assert got == {i: (n, 2 if i in (1, 3) else 1) for i, n in enumerate(names)}


def test_partial_compaction_keeps_whole_partitions(spark, root):
    lake = table(root)
    lake.merge(spark.createDataFrame([(s, d * DAY, 1.0, T1) for s in "abc" for d in range(3)], SCHEMA))
    before = rows_of(lake, spark)
    lake.compact(spark, files=1, where=(F.col("symbol") == "a") & (F.col("timestamp") == DAY))
    assert rows_of(lake, spark) == before
    assert lake.last_operation(spark).touched == ["day=1970-01-02"]


# --- Z-order ---------------------------------------------------------------------------


def test_curve_interleaves_ranks(spark):
    rows = spark.range(256).select(
        (F.col("id") % 16).alias("x"), F.expr("id div 16").alias("y"), F.lit(None).cast("int").alias("n")
    )
    found = rows.select("x", "y", zorder.curve(rows, ["x", "y"], 4).alias("z")).collect()

    def morton(x, y):
        return sum(((x >> b) & 1) << (2 * b + 1) | ((y >> b) & 1) << (2 * b) for b in range(4))

    assert all(r.z == morton(r.x, r.y) for r in found)
    assert {r.z for r in rows.select(zorder.curve(rows, ["n"]).alias("z")).collect()} == {0}


def test_numbers_keep_the_order_of_texts_and_times(spark):
    texts = ["", "a", "aa", "ab", "abcdefg", "b", "é", "日本"]
    frame = spark.createDataFrame([(t,) for t in texts], "t string")
    numbers = [r.v for r in frame.select(zorder.as_number(frame, "t").alias("v")).collect()]
    assert numbers == sorted(numbers) and len(set(numbers)) == len(texts)
    times = spark.createDataFrame([(T1, T1.date(), True, 1.5), (T2, T2.date(), False, None)], "a timestamp, b date, c boolean, d double")
    for name in "abcd":
        assert times.select(zorder.as_number(times, name).alias("v")).count() == 2


def test_zorder_skips_files_in_both_columns(spark, root):
    rows = spark.range(40_000).select(
        F.pmod(F.xxhash64("id"), F.lit(200)).alias("x"), F.pmod(F.xxhash64("id", F.lit(1)), F.lit(200)).alias("y"), "id", F.lit(T1).alias("updated_at")
    )
    lake = LakeTable(f"{root}/curve", ("id",), cluster_by=("x", "y"))
    lake.create(rows)

    def hit(column, value):
        file = F.input_file_name().alias("f")
        ranges = lake.read(spark).groupBy(file).agg(F.min(column).alias("a"), F.max(column).alias("b"))
        return ranges.filter(F.lit(value).between(F.col("a"), F.col("b"))).count(), ranges.count()

    lake.compact(spark, files=16)
    assert hit("y", 77) == (16, 16)
    lake.compact(spark, files=16, zorder=["x", "y"])
    (x, n), (y, _) = hit("x", 77), hit("y", 77)
    assert n == 16 and x <= 8 and y <= 8
    assert lake.read(spark).columns == ["x", "y", "id", "updated_at"]
    assert lake.read(spark).count() == 40_000
