"""Column similarity of wide vectors and approximate neighbour pairs."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.operators import near_pairs
from marketlake.session import cut_lineage


def gram(df: DataFrame, column: str) -> DataFrame:
    """(i, j, dot) of all column pairs.  Every task sends one width x width matrix,
    whatever the number of rows; no pair is formed per row."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            values = batch.column(0)
            if len(values) == 0:
                continue
            matrix = np.asarray(values.flatten(), dtype=np.float64).reshape(len(values), -1)
            dots = matrix.T @ matrix
            total = dots if total is None else total + dots
        if total is not None:
            i, j = np.triu_indices(len(total))
            yield pa.RecordBatch.from_pydict({"i": i, "j": j, "dot": total[i, j]})

    parts = df.select(column).filter(F.col(column).isNotNull()).mapInArrow(
        partial, "i long, j long, dot double"
    )
    return parts.groupBy("i", "j").agg(F.sum("dot").alias("dot"))


def column_cosines(df: DataFrame, column: str, threshold: float | None = None) -> DataFrame:
    """(i, j, cosine) for i < j, optionally only pairs at or above a threshold."""
    dots = cut_lineage(gram(df, column))
    norms = dots.filter("i = j").select("i", F.sqrt("dot").alias("norm"))
    pairs = (
        dots.filter("i < j")
        .join(norms.withColumnRenamed("norm", "ni"), "i")
        .join(norms.select(F.col("i").alias("j"), F.col("norm").alias("nj")), "j")
        .select("i", "j", (F.col("dot") / (F.col("ni") * F.col("nj"))).alias("cosine"))
    )
    return pairs if threshold is None else pairs.filter(F.col("cosine") >= threshold)


def sampled_column_cosines(
    df: DataFrame,
    column: str,
    threshold: float = 0.1,
    key: str | None = None,
    gamma: float | None = None,
) -> DataFrame:
    """The same pairs, estimated from sampled entries.

    Entry i of a row counts with the chance sqrt(gamma) / norm of column i (1 if that is more),
    and as much more as it counts less often, so columns of any norm send about as many entries
    and the estimate has no bias.  Pairs at or above the threshold have an error of some tens of
    percent at most with gamma = 10 log(width) / threshold.  The draw is the hash of the row's
    ``key`` (its content, if none is named) and i: reruns agree."""
    norms = (
        df.select(F.posexplode(column).alias("i", "x"))
        .groupBy("i")
        .agg(F.sqrt(F.sum(F.col("x").cast("double") ** 2)).alias("norm"))
        .orderBy("i")
        .collect()  # one number per column
    )
    if not norms:
        return df.sparkSession.createDataFrame([], "i long, j long, cosine double")
    root = math.sqrt(gamma or 10 * math.log(max(len(norms), 2)) / threshold)
    least = F.array(*[F.lit(min(root, r["norm"]) or 1.0) for r in norms])
    chance = F.array(*[F.lit(min(1.0, root / r["norm"]) if r["norm"] else 0.0) for r in norms])
    named = F.col(key).cast("string") if key else F.xxhash64(column).cast("string")

    def drawn(i: Column) -> Column:
        digits = F.substring(F.md5(F.concat_ws(":", F.col("_key"), i.cast("string"))), 1, 8)
        return F.conv(digits, 16, 10).cast("double") / float(1 << 32)

    def entry(x: Column, i: Column) -> Column:
        kept = drawn(i) < F.get(chance, i)
        return F.when(kept, x.cast("double") / F.get(least, i)).otherwise(F.lit(0.0))

    sampled = df.select(named.alias("_key"), F.col(column).alias("_row")).select(
        F.transform("_row", entry).alias("row")
    )
    return gram(sampled, "row").filter("i < j").select("i", "j", F.col("dot").alias("cosine"))


def mean_error(exact: DataFrame, estimate: DataFrame) -> DataFrame:
    both = exact.join(estimate.withColumnRenamed("cosine", "estimate"), ["i", "j"])
    return both.agg(F.avg(F.abs(F.col("cosine") - F.col("estimate"))).alias("mean_error"))


def copy_groups(df: DataFrame, key: str, content: str) -> tuple[DataFrame, DataFrame]:
    """One representative per distinct content, and the map from every row to it.

    Pairs are searched among representatives only: a content copied a million
    times costs one row, and its pairs follow from the map."""
    hashed = df.withColumn("_content", F.unhex(F.sha2(F.to_json(F.struct(content)), 256)))
    heads = cut_lineage(
        hashed.groupBy("_content").agg(
            F.min(key).alias("representative"), F.count(F.lit(1)).alias("copies")
        )
    )
    members = hashed.join(heads, "_content").select(key, "representative")
    chosen = df.join(
        heads.select(F.col("representative").alias(key), "copies"), key
    )
    return chosen, members


def _ordered_pairs(pairs: DataFrame, members: DataFrame, key: str) -> DataFrame:
    """Pairs of representatives, and each copy with its representative: linear in the
    copies, from which all pairs with copies follow."""
    copies = members.filter(F.col("representative") < F.col(key)).select(
        F.col("representative").alias("left"), F.col(key).alias("right"), F.lit(0.0)
    )
    return pairs.union(copies)


_BLOCK = 1024  # copies of one content that are held in one list


def contents(df: DataFrame, key: str, content: str) -> tuple[DataFrame, DataFrame]:
    """Each distinct content once (id, row, copies), and the rows that have it (id, copies, key)."""
    hashed = df.withColumn("_content", F.unhex(F.sha2(F.to_json(F.struct(content)), 256)))
    heads = hashed.groupBy("_content").agg(F.first(content).alias("row"), F.count(F.lit(1)).alias("copies"))
    chosen = cut_lineage(heads).withColumn("id", F.monotonically_increasing_id())
    members = hashed.select(F.col(key).alias("key"), "_content").join(chosen.select("_content", "id", "copies"), "_content")
    return chosen.select("id", "row", "copies"), cut_lineage(members.select("id", "copies", "key"))


def _pairs_of_rows(pairs: DataFrame, members: DataFrame) -> DataFrame:
    """All pairs of rows with different keys that follow from the pairs of their contents, and
    all pairs of copies.  Copies lie in lists of bounded size, and each pair of lists is a piece
    of work of its own."""
    spread = F.pmod(F.xxhash64("key"), F.ceil(F.col("copies") / _BLOCK)).alias("block")
    lists = members.groupBy("id", spread).agg(F.collect_list("key").alias("keys"))
    same = members.filter("copies > 1").select(F.col("id").alias("left"), F.col("id").alias("right")).distinct()
    dealt = (
        pairs.union(same.withColumn("distance", F.lit(0.0)))
        .join(lists.select(F.col("id").alias("left"), F.col("block").alias("x"), F.col("keys").alias("a")), "left")
        .join(lists.select(F.col("id").alias("right"), F.col("block").alias("y"), F.col("keys").alias("b")), "right")
        .repartition("left", "right", "x", "y")
    )
    each = dealt.withColumn("a", F.explode("a")).withColumn("b", F.explode("b"))
    once = F.when(F.col("left") == F.col("right"), F.col("a") < F.col("b")).otherwise(F.col("a") != F.col("b"))
    return each.filter(once).select(F.least("a", "b").alias("left"), F.greatest("a", "b").alias("right"), "distance")


def typical_distance(vectors: DataFrame) -> tuple[int, float]:
    """(rows, root of the mean squared distance of any two), from ``row`` in one pass."""
    cells = vectors.select(F.posexplode("row").alias("i", "x"))
    spread = cells.groupBy("i").agg(F.count(F.lit(1)).alias("n"), F.var_pop("x").alias("v"))
    row = spread.agg(F.max("n").alias("n"), F.sum("v").alias("v")).first()
    return (row["n"] or 0), math.sqrt(2 * (row["v"] or 0.0))


def near_vectors(
    df: DataFrame,
    key: str,
    column: str,
    within: float,
    width: float | None = None,
    tables: int | None = None,
    hashes: int = 1,
    seed: int = 1,
    recall: float = near_pairs.RECALL,
    all_copies: bool = False,
) -> DataFrame:
    """Pairs of vectors within a Euclidean distance, by random projection; copies pair
    with the first of them, or with ``all_copies`` with each other and with all that is near.
    Width, tables and hashes follow from the data and the recall wanted, unless width and
    tables are given."""
    filled = df.select(key, column).filter(F.col(column).isNotNull())
    if all_copies:
        chosen, members = contents(filled, key, column)
        rows = chosen.select("id", "row")
    else:
        chosen, members = copy_groups(filled, key, column)
        rows = cut_lineage(chosen.select(F.col(key).alias("id"), F.col(column).alias("row")))
    if width and tables:
        plan = near_pairs.Plan(hashes, tables, width)
    else:
        plan = near_pairs.plan_projection(*_planned(rows, within), recall)
    keys = near_pairs.keyed(rows, "projection", plan, seed)
    found = near_pairs.near_pairs(keys, "projection", within, tables=plan.tables)
    return _pairs_of_rows(found, members) if all_copies else _ordered_pairs(found, members, key)


def _planned(rows: DataFrame, within: float) -> tuple[int, float, float]:
    n, typical = typical_distance(rows)
    return n, within, typical


def near_texts(
    tokens: DataFrame, key: str, within: float, seed: int = 1, recall: float = near_pairs.RECALL
) -> DataFrame:
    """Pairs of token sets within a Jaccard distance, by min-hash of 64-bit token hashes;
    copies pair with the first of them."""
    # no filter on their number: it would go below the tokens and make them a second time
    hashed = F.array_distinct(F.transform("tokens", lambda t: F.xxhash64(t)))
    sets = tokens.select(F.col(key).cast("long").alias("id"), hashed.alias("row"))
    plan = near_pairs.plan_min_hash(tokens.count(), within, recall)
    # texts are read once for their signs, and again where a pair is likely; sets are never kept
    signed = cut_lineage(near_pairs.signed_sets(sets, plan, seed))
    heads = cut_lineage(signed.groupBy("digest").agg(F.min("id").alias("representative")))
    members = signed.select("id", "digest").join(heads, "digest").select(F.col("id").alias(key), "representative")
    chosen = cut_lineage(
        signed.join(heads.withColumnRenamed("representative", "id"), ["id", "digest"], "left_semi").drop("digest")
    )
    found = near_pairs.near_sketched(chosen, sets, "min_hash", within)
    return _ordered_pairs(found, members, key)
