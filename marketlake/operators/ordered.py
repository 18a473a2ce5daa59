"""Order-dependent work that stays balanced when one key owns most of the rows.

``Window.partitionBy(key)`` sends every row of a key to one task.  Here the rows
are range-partitioned on (keys, order) instead, so a hot key is cut into as many
even slices as it needs, as far as (keys, order) tell rows apart; work on values that many rows
share counts them first (``counted_values``).  Each row gets one global position and work
runs on fixed-size *chunks* of positions:

* functions that look back a bounded number of rows get the tail of the previous
  chunk as a halo (``halo_chunks``);
* "last value so far" fills inside each chunk and adds a carry taken from the
  per-chunk summaries (``fill_forward``).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.session import cut_lineage, slice_count

POS, CHUNK, WARMUP = "_pos", "_chunk", "_warmup"
_SLICE, _AT = "_slice", "_at"

# monotonically_increasing_id keeps the row index in its low 33 bits
_INDEX_MASK = (1 << 33) - 1

# A chunk fits a task's memory, however many there are; one summary row per chunk goes
# through a single ordered pass, which is one row for 250,000.
DEFAULT_CHUNK = 250_000


@dataclass(frozen=True)
class Numbered:
    rows: DataFrame
    count: int
    keys: tuple[str, ...]

    def chunk_size(self) -> int:
        return DEFAULT_CHUNK


def number_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> Numbered:
    """Add ``_pos``: the row's place in the total order (keys, order).

    Rows of one key get consecutive numbers.  ``order`` has to break all ties if
    the numbering must be repeatable.  The sorted slices are checkpointed because
    the slice sizes and the rows have to come from the same partitioning."""
    spark = df.sparkSession
    placed = cut_lineage(
        df.repartitionByRange(slice_count(spark), *keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn(_SLICE, F.spark_partition_id())
        .withColumn(_AT, F.monotonically_increasing_id().bitwiseAND(F.lit(_INDEX_MASK)))
    )
    # one number per slice: bounded by spark.sql.shuffle.partitions
    sizes = sorted(placed.groupBy(_SLICE).agg(F.count(F.lit(1)).alias("n")).collect())
    starts, total = [], 0
    for piece, n in sizes:
        starts.append((piece, total))
        total += n
    offsets = spark.createDataFrame(starts, f"{_SLICE} int, _start long")
    rows = (
        placed.join(F.broadcast(offsets), _SLICE)
        .withColumn(POS, F.col("_start") + F.col(_AT))
        .drop(_SLICE, _AT, "_start")
    )
    return Numbered(rows, total, tuple(keys))


def halo_chunks(numbered: Numbered, halo: int, size: int | None = None) -> DataFrame:
    """Cut positions into chunks and repeat the last ``halo`` rows of each chunk,
    marked ``_warmup``, at the start of the next one."""
    size = numbered.chunk_size() if size is None else size
    if halo > size:
        raise ValueError(f"halo {halo} is longer than a chunk of {size} rows")
    home = F.expr(f"{POS} div {size}")
    in_tail = F.col(POS) % size >= size - halo
    return (
        numbered.rows.withColumn("_home", home)
        .withColumn(
            CHUNK,
            F.explode(
                F.when(in_tail, F.array("_home", F.col("_home") + 1)).otherwise(F.array("_home"))
            ),
        )
        .withColumn(WARMUP, F.col(CHUNK) != F.col("_home"))
        .drop("_home")
    )


def fill_forward(
    numbered: Numbered, columns: Sequence[str], size: int | None = None
) -> DataFrame:
    """Replace nulls by the last non-null value of the same key, as far back as
    it takes.  Columns may be of any type, structs included."""
    size = numbered.chunk_size() if size is None else size
    keys = list(numbered.keys)
    rows = numbered.rows.withColumn(CHUNK, F.expr(f"{POS} div {size}"))

    # a value travels with its key, so it can never leak into the next key
    def tagged(name):
        return F.when(F.col(name).isNotNull(), F.struct(*keys, F.col(name).alias("_v")))

    tails = rows.groupBy(CHUNK).agg(
        *[F.max_by(tagged(c), F.when(F.col(c).isNotNull(), F.col(POS))).alias(c) for c in columns]
    )
    # one row per chunk: a single ordered pass is fine
    earlier = Window.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carry = tails.select(
        CHUNK, *[F.last(c, ignorenulls=True).over(earlier).alias(f"_carry_{c}") for c in columns]
    )
    local = Window.partitionBy(CHUNK, *keys).orderBy(POS)
    filled = rows.withColumns(
        {f"_local_{c}": F.last(c, ignorenulls=True).over(local) for c in columns}
    ).join(carry, CHUNK)

    def resolved(name):
        held = F.col(f"_carry_{name}")
        same_key = F.lit(True)
        for key in keys:
            same_key = same_key & held[key].eqNullSafe(F.col(key))
        return F.coalesce(F.col(f"_local_{name}"), F.when(same_key, held["_v"])).alias(name)

    kept = [c for c in numbered.rows.columns if c not in columns]
    return filled.select(*kept, *[resolved(c) for c in columns])


def running_totals(
    numbered: Numbered, columns: Sequence[str], size: int | None = None
) -> DataFrame:
    """Add ``cum_<column>``: the sum of a column over all rows up to this one, in
    the total order and across keys."""
    size = numbered.chunk_size() if size is None else size
    rows = numbered.rows.withColumn(CHUNK, F.expr(f"{POS} div {size}"))
    sums = rows.groupBy(CHUNK).agg(*[F.sum(c).alias(c) for c in columns])
    earlier = Window.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    carry = sums.select(
        CHUNK, *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"_carry_{c}") for c in columns]
    )
    local = Window.partitionBy(CHUNK).orderBy(POS).rowsBetween(Window.unboundedPreceding, 0)
    return (
        rows.withColumns({f"_local_{c}": F.sum(c).over(local) for c in columns})
        .join(carry, CHUNK)
        .select(
            *numbered.rows.columns,
            *[(F.col(f"_local_{c}") + F.col(f"_carry_{c}")).alias(f"cum_{c}") for c in columns],
        )
    )


def counted_values(df: DataFrame, column: str) -> tuple[DataFrame, int]:
    """(column, n, upto) for each distinct value: its rows and the rows up to it; and the
    number of rows.  A value that most rows share is one row here, counted before the
    shuffle.  Nulls don't count."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    rows = running_totals(number_rows(counts, [], [column]), ["n"])
    total = rows.agg(F.max("cum_n")).first()[0] or 0
    return rows.select(column, "n", F.col("cum_n").alias("upto")), total


def exact_quantiles(df: DataFrame, column: str, shares: Sequence[float]) -> list[float | None]:
    """Quantiles with linear interpolation, read off the counted values; only the values
    at the two places around each share reach the driver."""
    rows, total = counted_values(df, column)
    if total == 0:
        return [None] * len(shares)
    places = [share * (total - 1) for share in shares]
    wanted = sorted({int(p) for p in places} | {min(int(p) + 1, total - 1) for p in places})
    holds = F.exists(
        F.array(*map(F.lit, wanted)), lambda w: (w < F.col("upto")) & (w >= F.col("upto") - F.col("n"))
    )
    found = rows.filter(holds).collect()

    def at(place: int) -> float:
        return next(float(r[column]) for r in found if r["upto"] - r["n"] <= place < r["upto"])

    return [
        at(int(p)) + (p - int(p)) * (at(min(int(p) + 1, total - 1)) - at(int(p))) for p in places
    ]
