"""Tail probabilities as Column expressions, for test statistics that are rows."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

_STEPS = 300
_SHIFT = 8


def log_gamma(x: Column) -> Column:
    """For x > 0: Stirling's series at x + 8, less the logarithms of the factors between."""
    y = x + _SHIFT
    series = (
        (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi)
        + 1 / (12 * y) - 1 / (360 * y**3) + 1 / (1260 * y**5) - 1 / (1680 * y**7) + 1 / (1188 * y**9)
    )
    return series - sum((F.log(x + k) for k in range(_SHIFT)), F.lit(0.0))


def _front(a: Column, x: Column) -> Column:
    return F.exp(a * F.log(x) - x - log_gamma(a))


def _series(a: Column, x: Column) -> Column:
    """Lower share, for x < a + 1: x^k over a (a + 1) ... (a + k), added up."""
    start = F.struct((1 / a).alias("term"), (1 / a).alias("sum"))

    def step(acc, k):
        term = acc["term"] * x / (a + k)
        return F.struct(term.alias("term"), (acc["sum"] + term).alias("sum"))

    steps = F.sequence(F.lit(1), F.lit(_STEPS))
    return _front(a, x) * F.aggregate(steps, start, step, lambda acc: acc["sum"])


def _fraction(a: Column, x: Column) -> Column:
    """Upper share, for x >= a + 1: the continued fraction, from its last term back to its
    first."""

    def step(acc, k):
        i = _STEPS - k
        return x + (2 * i + 1) - a - (i + 1) * (i + 1 - a) / acc

    steps = F.sequence(F.lit(1), F.lit(_STEPS))
    last = x + (2 * _STEPS + 1) - a
    return _front(a, x) / F.aggregate(steps, last, step)


def gamma_upper(a: Column, x: Column) -> Column:
    """The upper regularised incomplete gamma function Q(a, x), a > 0."""
    a, x = a.cast("double"), x.cast("double")
    return (
        F.when(a.isNull() | x.isNull(), F.lit(None).cast("double"))
        .when(x <= 0, F.lit(1.0))
        .when(x < a + 1, 1 - _series(a, x))
        .otherwise(_fraction(a, x))
    )


def chi_square_tail(statistic: Column, freedom: Column) -> Column:
    """Chance of a chi-square of ``freedom`` degrees of at least ``statistic``."""
    return gamma_upper(freedom / 2, statistic / 2)


def normal_cdf(z: Column) -> Column:
    tail = gamma_upper(F.lit(0.5), z * z / 2) / 2
    return F.when(z < 0, tail).otherwise(1 - tail)


def kolmogorov_tail(distance: Column, n: Column) -> Column:
    """Chance of a distance of at least ``distance`` between a continuous distribution and n
    draws from it: the limiting series, with Stephens' correction for small n."""
    root = F.sqrt(n.cast("double"))
    scaled = (root + 0.12 + 0.11 / root) * distance
    total = F.aggregate(
        F.sequence(F.lit(1), F.lit(100)),
        F.lit(0.0),
        lambda acc, j: acc + F.when(j % 2 == 1, 2.0).otherwise(-2.0) * F.exp(-2.0 * j * j * scaled * scaled),
    )
    # below this the series has not settled, and the chance is 1 to fifteen digits
    return F.when(scaled < 0.18, F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), total)))
