import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from marketlake.operators import scaling, wide


def frame(spark, matrix, parts=6):
    return spark.createDataFrame(pd.DataFrame({"v": matrix.tolist()})).repartition(parts)


def test_values_and_vectors_equal_numpy(spark):
    rng = np.random.default_rng(1)
    matrix = rng.normal(size=(400, 60)) * np.logspace(0, -3, 60) + 0.3
    for centred in (False, True):
        found = wide.decompose(frame(spark, matrix), "v", 6, centred=centred)
        own = matrix - matrix.mean(axis=0) if centred else matrix
        _, values, vectors = np.linalg.svd(own, full_matrices=False)
        assert found.rows == 400 and np.abs(found.values - values[:6]).max() < 1e-8 * values[0]
        assert np.abs(np.abs((found.vectors * vectors[:6].T).sum(axis=0)) - 1).max() < 1e-6
        if centred:
            assert np.allclose(found.variances(), np.var(own @ found.vectors, axis=0, ddof=1))


def test_very_wide_rows(spark):
    """Width 6,000: a matrix of all column pairs would have 36 million entries."""
    rng = np.random.default_rng(2)
    low = rng.normal(size=(150, 4)) @ (rng.normal(size=(4, 6_000)) * np.array([[8.0], [4.0], [2.0], [1.0]]))
    matrix = low + rng.normal(size=low.shape) * 1e-4
    found = wide.decompose(frame(spark, matrix, 4), "v", 4, oversample=6)
    assert np.abs(found.values - np.linalg.svd(matrix, compute_uv=False)[:4]).max() < 1e-6
    assert found.vectors.shape == (6_000, 4)


def test_small_values_are_not_squared(spark):
    """Values 1e-9 of the largest survive, which a matrix of products would lose."""
    rng = np.random.default_rng(3)
    u, _ = np.linalg.qr(rng.normal(size=(80, 5)))
    v, _ = np.linalg.qr(rng.normal(size=(5, 5)))
    want = np.array([1.0, 1e-2, 1e-4, 1e-7, 1e-9])
    found = wide.decompose(frame(spark, u * want @ v.T), "v", 5)
    assert np.abs(found.values / want - 1).max() < 1e-4


def test_cases(spark):
    assert wide.decompose(spark.createDataFrame([], "v array<double>"), "v", 3) is None
    one = spark.createDataFrame([([3.0, 4.0],), (None,)], "v array<double>")
    found = wide.decompose(one, "v", 2)
    assert found.rows == 1 and np.allclose(found.values[0], 5.0)


def test_group_quantile_bins(spark):
    rng = np.random.default_rng(4)
    rows = [("a", float(x)) for x in rng.normal(size=3_000)] + [("b", 1.0)] * 5 + [(None, 2.0), ("a", None)]
    frame_ = spark.createDataFrame(rows, "k string, x double")
    out = scaling.group_quantile_bins(frame_, ["k"], "x", 4, "bin")
    counts = {(r.k, r.bin): r.n for r in out.groupBy("k", "bin").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert all(abs(counts["a", b] - 750) <= 10 for b in range(4))
    assert counts["b", 0] == 5 and counts[None, 0] == 1 and counts["a", None] == 1
