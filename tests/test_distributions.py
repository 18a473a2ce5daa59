import math

import pytest
from pyspark.sql import functions as F

from marketlake.functions import udfs
from marketlake.operators import distributions as dist
from marketlake.operators import similarity


def values(spark, rows, schema, **columns):
    return spark.createDataFrame(rows, schema).select(*[c.alias(n) for n, c in columns.items()]).collect()


def test_log_gamma(spark):
    xs = [0.01, 0.5, 1.0, 2.0, 3.7, 10.0, 150.5, 1e6]
    got = [r.v for r in values(spark, [(x,) for x in xs], "x double", v=dist.log_gamma(F.col("x")))]
    assert all(abs(g - math.lgamma(x)) <= 1e-10 * max(1, abs(math.lgamma(x))) for g, x in zip(got, xs))


def test_chi_square_tails(spark):
    """Even degrees of freedom have a closed form; one degree is a normal tail."""
    rows = [(x, k) for x in (0.0, 0.1, 1.0, 4.5, 20.0, 90.0) for k in (1, 2, 4, 10, 60)]
    found = values(spark, rows, "x double, k int", v=dist.chi_square_tail(F.col("x"), F.col("k")))
    for (x, k), r in zip(rows, found):
        if k == 1:
            want = math.erfc(math.sqrt(x / 2))
        else:
            want = math.exp(-x / 2) * sum((x / 2) ** j / math.factorial(j) for j in range(k // 2))
        assert abs(r.v - want) < 1e-10
    (r,) = values(spark, [(None, 1)], "x double, k int", v=dist.chi_square_tail(F.col("x"), F.col("k")))
    assert r.v is None


def test_normal_and_kolmogorov(spark):
    zs = [-8.0, -1.0, -0.2, 0.0, 0.3, 2.0, 6.0]
    found = values(spark, [(z,) for z in zs], "z double", v=dist.normal_cdf(F.col("z")))
    assert all(abs(r.v - 0.5 * math.erfc(-z / math.sqrt(2))) < 1e-12 for r, z in zip(found, zs))
    # critical values of the limit distribution: 10 %, 5 %, 1 %
    rows = [(1.22385 / 1e4, 10**8), (1.35810 / 1e4, 10**8), (1.62762 / 1e4, 10**8), (0.0, 5), (1.0, 10**6)]
    found = values(spark, rows, "d double, n long", v=dist.kolmogorov_tail(F.col("d"), F.col("n")))
    for r, want in zip(found, (0.10, 0.05, 0.01, 1.0, 0.0)):
        assert abs(r.v - want) < 2e-5


def test_table_function_over_any_table(spark):
    rows = spark.createDataFrame(
        [("a", 0, 1), ("a", 5, 2), ("a", 40, 3), ("b", 3, 4), ("b", 3, 5)], "who string, s long, n int"
    ).withColumn("at", F.timestamp_seconds("s"))
    rows.createOrReplaceTempView("marked_rows")
    found = udfs.mark_sessions(spark, "marked_rows", "who", "at", 30)
    assert found.columns == ["who", "s", "n", "at", "session", "gap"]
    assert {(r.n, r.session, r.gap) for r in found.filter("who = 'a'").collect()} == {(1, 0, None), (2, 0, 5.0), (3, 1, 35.0)}
    with pytest.raises(Exception, match="no column"):
        udfs.mark_sessions(spark, "marked_rows", "whom", "at", 30).collect()


def test_sampled_cosines_repeat_and_agree_on_average(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    base = rng.normal(size=(4_000, 1))
    matrix = np.concatenate([base + rng.normal(size=(4_000, 1)) * s for s in (0.1, 1.0, 3.0)], axis=1)
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(matrix)], "id long, v array<double>")
    exact = {(r.i, r.j): r.cosine for r in similarity.column_cosines(df, "v").collect()}
    one, two = (
        {(r.i, r.j): r.cosine for r in similarity.sampled_column_cosines(df, "v", key="id", gamma=400.0).collect()}
        for _ in range(2)
    )
    assert one.keys() == exact.keys() and all(abs(one[p] - two[p]) < 1e-12 for p in one)
    assert all(abs(one[p] - exact[p]) < 0.15 for p in exact)
    assert any(abs(one[p] - exact[p]) > 1e-6 for p in exact)
