"""Scaling, binning, filling and encoding of columns, in plain expressions.

A fit is one aggregate whose few numbers come to the driver; the transform is a
projection over the table, with those numbers as literals."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.operators.ordered import POS, exact_quantiles, number_rows


@dataclass(frozen=True)
class ColumnFit:
    mean: float
    spread: float
    low: float
    high: float


def fit_columns(df: DataFrame, columns: Sequence[str]) -> dict[str, ColumnFit]:
    row = df.agg(
        *[
            F.struct(
                F.avg(c).alias("mean"),
                F.stddev_samp(c).alias("spread"),
                F.min(c).cast("double").alias("low"),
                F.max(c).cast("double").alias("high"),
            ).alias(c)
            for c in columns
        ]
    ).first()
    return {c: ColumnFit(**row[c].asDict()) for c in columns}


def _over(numerator: Column, denominator: float | None) -> Column:
    """A constant column has no spread: it scales to zero."""
    return numerator / F.lit(float(denominator)) if denominator else F.lit(0.0)


def standard(column: str, fit: ColumnFit) -> Column:
    return _over(F.col(column) - fit.mean, fit.spread)


def min_max(column: str, fit: ColumnFit, low: float = 0.0, high: float = 1.0) -> Column:
    if fit.high == fit.low:
        return F.lit((low + high) / 2)
    return (F.col(column) - fit.low) / (fit.high - fit.low) * (high - low) + low


def max_abs(column: str, fit: ColumnFit) -> Column:
    return _over(F.col(column), max(abs(fit.low), abs(fit.high)))


def robust(df: DataFrame, column: str) -> Column:
    """Centred on the median, scaled by the distance between the quartiles."""
    low, middle, high = exact_quantiles(df, column, [0.25, 0.5, 0.75])
    return _over(F.col(column) - middle, high - low)


def normalised(columns: Sequence[str], p: float = 2.0) -> list[Column]:
    """Columns of a row divided by the row's p-norm."""
    total = F.lit(0.0)
    for c in columns:
        total = total + F.abs(F.col(c).cast("double")) ** p
    norm = total ** (1.0 / p)
    return [F.when(norm > 0, F.col(c) / norm).otherwise(0.0).alias(c) for c in columns]


def binarised(column: str, threshold: float) -> Column:
    return F.when(F.col(column) > threshold, 1.0).otherwise(0.0)


def bucketed(column: str, splits: Sequence[float]) -> Column:
    """Index of the half-open bucket [split, next split); the last one is closed."""
    value = F.col(column)
    bucket = F.when((value < splits[0]) | (value > splits[-1]), None)
    for k in range(len(splits) - 2):
        bucket = bucket.when(value < splits[k + 1], k)
    return bucket.otherwise(len(splits) - 2)


def quantile_bins(df: DataFrame, column: str, bins: int) -> Column:
    inner = exact_quantiles(df, column, [k / bins for k in range(1, bins)])
    inner = sorted(set(inner))
    return bucketed(column, [float("-inf"), *inner, float("inf")])


def group_quantiles(
    df: DataFrame, keys: Sequence[str], column: str, shares: Sequence[float], accuracy: int = 1_000
) -> DataFrame:
    """keys, ``n`` and ``borders``: quantiles per group from a sketch.

    The sketches of a group's rows are made where the rows are and merged, so no row is sorted
    or sent, and a hot group costs a sketch per task.  A border's rank is off by n / accuracy at
    most."""
    return df.groupBy(*keys).agg(
        F.count(column).alias("n"),
        F.percentile_approx(column, [float(s) for s in shares], accuracy).alias("borders"),
    )


def group_quantile_bins(
    df: DataFrame, keys: Sequence[str], column: str, bins: int, output: str, accuracy: int = 1_000
) -> DataFrame:
    """Add the row's quantile bin (from 0) within its group; null for a null value."""
    borders = group_quantiles(df, keys, column, [k / bins for k in range(1, bins)], accuracy)
    named = borders.select(*[F.col(k).alias(f"_key_{k}") for k in keys], "borders")
    same = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]
    below = F.size(F.filter("borders", lambda b: b < F.col(column)))
    return (
        df.join(named, same, "left")
        .withColumn(output, F.when(F.col(column).isNotNull(), below))
        .drop("borders", *[f"_key_{k}" for k in keys])
    )


def imputed(df: DataFrame, columns: Sequence[str], strategy: str = "mean") -> DataFrame:
    """Nulls become the column's mean, median or most frequent value."""
    if strategy == "mean":
        fills = df.agg(*[F.avg(c).alias(c) for c in columns]).first().asDict()
    elif strategy == "median":
        fills = {c: exact_quantiles(df, c, [0.5])[0] for c in columns}
    elif strategy == "mode":
        fills = {}
        for c in columns:
            often = df.filter(F.col(c).isNotNull()).groupBy(c).count()
            top = often.orderBy(F.desc("count"), c).first()
            fills[c] = None if top is None else top[0]
    else:
        raise ValueError(f"unknown strategy {strategy}")
    return df.withColumns({c: F.coalesce(c, F.lit(fills[c])) for c in columns})


def category_index(df: DataFrame, column: str) -> DataFrame:
    """(category, index): the most frequent category is 0, ties go by name."""
    counted = df.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("category")).count()
    ordered = number_rows(counted.withColumn("_rare", -F.col("count")), [], ["_rare", "category"])
    return ordered.rows.select("category", F.col(POS).alias("index"))


def indexed(df: DataFrame, column: str, index: DataFrame, output: str) -> DataFrame:
    """Unknown categories get a null index."""
    lookup = index.select(F.col("category").alias(column), F.col("index").alias(output))
    return df.join(lookup, column, "left")


def from_index(df: DataFrame, column: str, index: DataFrame, output: str) -> DataFrame:
    lookup = index.select(F.col("index").alias(column), F.col("category").alias(output))
    return df.join(lookup, column, "left")


def one_hot(column: str, size: int, drop_last: bool = True) -> Column:
    """Array with a one at the index; the last category is all zeros by default."""
    width = size - 1 if drop_last else size
    return F.transform(
        F.sequence(F.lit(0), F.lit(width - 1)), lambda k: F.when(F.col(column) == k, 1.0).otherwise(0.0)
    )
