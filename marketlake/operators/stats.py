"""Skew-safe aggregates, metrics of predictions, summaries, tests and samples."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.operators.distributions import chi_square_tail, kolmogorov_tail, normal_cdf
from marketlake.operators.ordered import counted_values, number_rows, running_totals


def safe_ratio(a: Column, b: Column) -> Column:
    return a / F.nullif(b.cast("double"), F.lit(0.0))


# --- grouping with hot keys ---------------------------------------------------------


def salted_distinct_counts(df: DataFrame, key: str, value: str, salts: int = 32) -> DataFrame:
    """Rows, sum and distinct values per key.  A distinct count cannot be combined
    before the shuffle the way a sum can, so it runs in two stages: first per
    (key, slice of the values), then per key, and a hot key spreads over ``salts``
    tasks."""
    salt = F.pmod(F.xxhash64(value), F.lit(salts))
    unique = df.groupBy(key, salt.alias("_salt"), value).agg(F.count(F.lit(1)).alias("_n"))
    partial = unique.groupBy(key, "_salt").agg(
        F.sum("_n").alias("_n"),
        F.sum(F.col("_n") * F.col(value)).alias("_total"),
        F.count(value).alias("_distinct"),
    )
    return partial.groupBy(key).agg(
        F.sum("_n").alias("rows"),
        F.sum("_total").alias("total"),
        F.sum("_distinct").alias("distinct_values"),
    )


# --- metrics ---------------------------------------------------------------------------


def binary_curve(scored: DataFrame, chunk: int | None = None) -> DataFrame:
    """(score, tp, fp, hits, misses) per distinct score, highest first: running
    true and false positives when everything from that score up is called positive."""
    per_score = scored.groupBy("score").agg(
        F.sum(F.when(F.col("label") == 1, 1).otherwise(0)).alias("hits"),
        F.sum(F.when(F.col("label") == 1, 0).otherwise(1)).alias("misses"),
    )
    numbered = number_rows(per_score.withColumn("_down", -F.col("score")), [], ["_down"])
    return running_totals(numbered, ["hits", "misses"], chunk).select(
        "score", F.col("cum_hits").alias("tp"), F.col("cum_misses").alias("fp"), "hits", "misses"
    )


def binary_metrics(scored: DataFrame) -> DataFrame:
    """One row: positives, negatives, area under ROC and under precision-recall
    (trapezoids; the latter starts at the first point's precision)."""
    curve = binary_curve(scored)
    tp0, fp0 = F.col("tp") - F.col("hits"), F.col("fp") - F.col("misses")
    precision = F.col("tp") / (F.col("tp") + F.col("fp"))
    before = F.when(tp0 + fp0 > 0, tp0 / F.nullif(tp0 + fp0, F.lit(0))).otherwise(precision)
    sums = curve.agg(
        F.sum("hits").alias("positives"),
        F.sum("misses").alias("negatives"),
        F.sum(F.col("misses") * (tp0 + F.col("tp")) / 2.0).alias("roc"),
        F.sum(F.col("hits") * (before + precision) / 2.0).alias("pr"),
    )
    return sums.select(
        "positives",
        "negatives",
        (F.col("roc") / (F.col("positives") * F.col("negatives"))).alias("area_roc"),
        (F.col("pr") / F.col("positives")).alias("area_pr"),
    )


def class_metrics(predicted: DataFrame) -> DataFrame:
    """Precision, recall and F1 per class from (label, prediction)."""
    confusion = predicted.groupBy("label", "prediction").agg(F.count(F.lit(1)).alias("n"))
    sides = confusion.select(
        F.explode(
            F.array(
                F.struct(F.col("label").alias("class"), F.col("n").alias("actual"), F.lit(0).cast("bigint").alias("called")),
                F.struct(F.col("prediction").alias("class"), F.lit(0).cast("bigint").alias("actual"), F.col("n").alias("called")),
            )
        ).alias("s"),
        F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("right"),
    )
    # a right prediction shows up on both sides of the explode
    totals = sides.groupBy(F.col("s.class").alias("class")).agg(
        F.sum("s.actual").alias("actual"),
        F.sum("s.called").alias("called"),
        (F.sum("right") / 2).cast("bigint").alias("right"),
    )
    precision, recall = safe_ratio(F.col("right"), F.col("called")), safe_ratio(F.col("right"), F.col("actual"))
    return totals.select(
        "class",
        "actual",
        precision.alias("precision"),
        recall.alias("recall"),
        (2 * precision * recall / F.nullif(precision + recall, F.lit(0.0))).alias("f1"),
    )


def multiclass_metrics(predicted: DataFrame) -> DataFrame:
    """Accuracy and class metrics weighted by class size."""
    per_class = class_metrics(predicted)
    def weighted(name):
        return (F.sum(F.col("actual") * F.coalesce(name, F.lit(0.0))) / F.sum("actual")).alias(f"weighted_{name}")

    return per_class.agg(
        F.sum("actual").alias("n"),
        (F.sum(F.col("recall") * F.col("actual")) / F.sum("actual")).alias("accuracy"),
        *[weighted(m) for m in ("precision", "recall", "f1")],
    )


def multilabel_metrics(predicted: DataFrame, classes: int) -> DataFrame:
    """From (labels, predictions), both sets of class names."""
    both = F.size(F.array_intersect("labels", "predictions"))
    have, called = F.size("labels"), F.size("predictions")
    return predicted.agg(
        F.avg(F.when((both == have) & (both == called), 1.0).otherwise(0.0)).alias("subset_accuracy"),
        F.avg(both / (have + called - both)).alias("accuracy"),
        (F.sum(have + called - 2 * both) / (F.count(F.lit(1)) * classes)).alias("hamming_loss"),
        F.avg(both / called).alias("precision"),
        F.avg(both / have).alias("recall"),
        F.avg(2 * both / (have + called)).alias("f1"),
        (2 * F.sum(both) / (F.sum(have) + F.sum(called))).alias("micro_f1"),
    )


def regression_metrics(predicted: DataFrame) -> DataFrame:
    error = F.col("label") - F.col("prediction")
    n = F.count(F.lit(1))
    mse = F.sum(error * error) / n
    return predicted.agg(
        mse.alias("mse"),
        F.sqrt(mse).alias("rmse"),
        F.avg(F.abs(error)).alias("mae"),
        (1 - F.sum(error * error) / (F.var_pop("label") * n)).alias("r2"),
        (F.var_pop("label") - F.var_pop(error)).alias("explained"),
    )


def ranking_metrics(ranked: DataFrame, relevant: DataFrame, k: int) -> DataFrame:
    """Mean precision@k, average precision and NDCG@k over users that have
    relevant items.  ``ranked``: user, item, rank from 1; ``relevant``: user, item."""
    wanted = relevant.select("user", "item").distinct()
    size = wanted.groupBy("user").agg(F.count(F.lit(1)).alias("wanted"))
    hits = ranked.join(wanted, ["user", "item"])
    # a user's hits are no more than the length of that user's list
    so_far = F.count(F.lit(1)).over(Window.partitionBy("user").orderBy("rank"))
    top = F.col("rank") <= k
    per_user = (
        hits.withColumn("nth", so_far)
        .groupBy("user")
        .agg(
            F.sum(F.when(top, 1).otherwise(0)).alias("in_top"),
            F.sum(F.col("nth") / F.col("rank")).alias("precision_sum"),
            F.sum(F.when(top, 1 / F.log2(F.col("rank") + 1.0)).otherwise(0.0)).alias("gain"),
        )
    )
    ideal = F.aggregate(
        F.sequence(F.lit(1), F.least("wanted", F.lit(k)).cast("int")),
        F.lit(0.0),
        lambda total, r: total + 1 / F.log2(r + 1.0),
    )
    return (
        size.join(per_user, "user", "left")
        .fillna(0)
        .agg(
            F.count(F.lit(1)).alias("users"),
            F.avg(F.col("in_top") / F.lit(float(k))).alias("precision_at_k"),
            F.avg(F.col("precision_sum") / F.col("wanted")).alias("mean_average_precision"),
            F.avg(F.col("gain") / ideal).alias("ndcg_at_k"),
        )
    )


# --- summaries and tests ---------------------------------------------------------------


def column_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column with the usual summary, from a single pass."""

    def measures(c):
        return F.struct(
            F.lit(c).alias("column"),
            F.count(c).alias("n"),
            F.avg(c).alias("mean"),
            F.var_samp(c).alias("variance"),
            F.min(c).cast("double").alias("low"),
            F.max(c).cast("double").alias("high"),
            F.sum(F.when(F.col(c) != 0, 1).otherwise(0)).alias("nonzeros"),
            F.sum(F.abs(F.col(c).cast("double"))).alias("norm_l1"),
            F.sqrt(F.sum(F.col(c).cast("double") ** 2)).alias("norm_l2"),
        )

    return df.agg(F.array(*[measures(c) for c in columns]).alias("s")).select(F.inline("s"))


def pearson(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.agg(F.corr(x, y).alias("correlation"))


def mean_ranks(df: DataFrame, column: str, chunk: int | None = None) -> DataFrame:
    """(value, rank): ranks from 1, equal values share their mean rank."""
    counted = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    totals = running_totals(number_rows(counted, [], ["value"]), ["n"], chunk)
    return totals.select("value", (F.col("cum_n") - (F.col("n") - 1) / 2.0).alias("rank"))


def spearman(df: DataFrame, x: str, y: str) -> DataFrame:
    """Pearson over ranks.  Pairs of equal values are counted before the join, so
    repeated values weigh as one row each."""
    pairs = df.select(x, y).na.drop().groupBy(x, y).agg(F.count(F.lit(1)).alias("n"))
    flat = df.select(x, y).na.drop()
    rx = mean_ranks(flat, x).select(F.col("value").alias(x), F.col("rank").alias("a"))
    ry = mean_ranks(flat, y).select(F.col("value").alias(y), F.col("rank").alias("b"))
    n, a, b = F.col("n"), F.col("a"), F.col("b")
    sums = pairs.join(rx, x).join(ry, y).agg(
        F.sum(n).alias("n"),
        F.sum(n * a).alias("a"),
        F.sum(n * b).alias("b"),
        F.sum(n * a * a).alias("aa"),
        F.sum(n * b * b).alias("bb"),
        F.sum(n * a * b).alias("ab"),
    )
    top = F.expr("ab / n - (a / n) * (b / n)")
    bottom = F.expr("sqrt(aa / n - pow(a / n, 2)) * sqrt(bb / n - pow(b / n, 2))")
    return sums.select((top / bottom).alias("correlation"))


def chi_square(df: DataFrame, x: str, y: str) -> DataFrame:
    """Independence of two categorical columns: statistic and degrees of freedom.

    sum((o - e)^2 / e) = total * (sum(o^2 / (row * column)) - 1), so empty cells
    need no rows."""
    cells = df.select(x, y).na.drop().groupBy(x, y).agg(F.count(F.lit(1)).alias("o"))
    rows = cells.groupBy(x).agg(F.sum("o").alias("r"))
    columns = cells.groupBy(y).agg(F.sum("o").alias("c"))
    o = F.col("o").cast("double")
    return (
        cells.join(rows, x)
        .join(columns, y)
        .agg(
            (F.sum("o") * (F.sum(o * o / (F.col("r").cast("double") * F.col("c"))) - 1)).alias("statistic"),
            ((F.count_distinct(x) - 1) * (F.count_distinct(y) - 1)).alias("freedom"),
        )
    )


def ks_statistic(df: DataFrame, column: str, cdf: Callable[[Column], Column]) -> DataFrame:
    """Largest distance between the empirical distribution and ``cdf``."""
    rows, total = counted_values(df, column)
    n = float(max(total, 1))
    above = F.col("upto") / n - cdf(F.col(column))
    below = cdf(F.col(column)) - (F.col("upto") - F.col("n")) / n
    return rows.agg(F.max(F.greatest(above, below)).alias("distance"))


def with_chi_square_chance(tested: DataFrame) -> DataFrame:
    """Add ``p_value`` to (statistic, freedom)."""
    return tested.withColumn("p_value", chi_square_tail(F.col("statistic"), F.col("freedom")))


def ks_normal(df: DataFrame, column: str, mean: float, deviation: float) -> DataFrame:
    """Distance from a normal distribution, number of values and ``p_value``."""
    n = df.agg(F.count(column)).first()[0]
    found = ks_statistic(df, column, lambda v: normal_cdf((v - mean) / deviation))
    return found.withColumn("n", F.lit(n).cast("long")).withColumn(
        "p_value", kolmogorov_tail(F.col("distance"), F.col("n"))
    )


def kernel_density(df: DataFrame, column: str, points: Sequence[float], bandwidth: float) -> DataFrame:
    """Gaussian kernel density at a few points: one sum per point, in one pass."""
    scale = 1 / (bandwidth * math.sqrt(2 * math.pi))

    def at(p):
        z = (F.col(column) - p) / bandwidth
        return F.struct(F.lit(float(p)).alias("point"), F.avg(F.exp(-0.5 * z * z) * scale).alias("density"))

    return df.agg(F.array(*[at(p) for p in points]).alias("d")).select(F.inline("d"))


# --- experiments --------------------------------------------------------------------------


def welch(observations: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Welch's t per group from (arm 0/1, value): means, t and degrees of freedom."""

    def arm(k, f):
        return f(F.when(F.col("arm") == k, F.col("value")))

    moments = observations.groupBy(*by).agg(
        *[
            arm(k, f).alias(f"{name}{k}")
            for k in (0, 1)
            for name, f in (("n", F.count), ("mean", F.avg), ("var", F.var_samp))
        ]
    )
    s0, s1 = F.col("var0") / F.col("n0"), F.col("var1") / F.col("n1")
    return moments.filter("n0 > 1 AND n1 > 1").select(
        *by,
        "n0",
        "n1",
        "mean0",
        "mean1",
        safe_ratio(F.col("mean0") - F.col("mean1"), F.sqrt(s0 + s1)).alias("t"),
        safe_ratio(
            (s0 + s1) * (s0 + s1), s0 * s0 / (F.col("n0") - 1) + s1 * s1 / (F.col("n1") - 1)
        ).alias("freedom"),
    )


def daily_means(rows: DataFrame, date: str, columns: Sequence[str]) -> DataFrame:
    return rows.groupBy(F.to_date(date).alias("day")).agg(
        F.count(F.lit(1)).alias("n"), *[F.avg(c).alias(f"mean_{c}") for c in columns]
    )


# --- samples -----------------------------------------------------------------------------


def hash_share(key: str) -> Column:
    """A fixed number in [0, 1) for every key: the same rows every run."""
    return F.conv(F.substring(F.md5(F.col(key).cast("string")), 1, 8), 16, 10).cast("double") / F.lit(2.0**32)


def hash_sample(df: DataFrame, key: str, fraction: float) -> DataFrame:
    return df.filter(hash_share(key) < fraction)


def stratified_hash_sample(df: DataFrame, key: str, stratum: str, fractions: dict[str, float]) -> DataFrame:
    """Own fraction per stratum; strata that are not named are left out."""
    wanted = F.lit(0.0)
    for name, fraction in fractions.items():
        wanted = F.when(F.col(stratum) == name, F.lit(float(fraction))).otherwise(wanted)
    return df.filter(hash_share(key) < wanted)


def random_sample(df: DataFrame, fraction: float, seed: int, replace: bool = False) -> DataFrame:
    return df.sample(replace, fraction, seed)


def stratified_sample(df: DataFrame, stratum: str, fractions: dict[str, float], seed: int) -> DataFrame:
    return df.sampleBy(stratum, fractions, seed)
