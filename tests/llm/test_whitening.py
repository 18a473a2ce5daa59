"""Whitening against eigenvectors of the exact covariance, and the secular equation."""

import math

import numpy as np
import pytest

pytest.importorskip("marketlake.llm")

from conftest import SMALL  # noqa: E402

from marketlake.llm import secular, whitening  # noqa: E402
from marketlake.llm.common import table  # noqa: E402

NAN, INF = float("nan"), float("inf")


def whole(vector):
    return [math.floor(64 * c) + 1_000_000 for c in vector]


def expected(rows, most=16):
    """(deviations per row, eigenvalues, |whitened| per row) by plain Python and numpy."""
    fit = sorted({tuple(x) for x in rows})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    off = np.array([[n * c - s for c, s in zip(x, sums)] for x in fit], float) / n
    values, vectors = np.linalg.eigh(off.T @ off / n)
    values, vectors = values[::-1][:most], vectors[:, ::-1][:, :most]
    deviation = [sum((n * c - s) ** 2 for c, s in zip(x, sums)) for x in rows]
    each = np.array([[n * c - s for c, s in zip(x, sums)] for x in rows], float) / n
    trace = (off * off).sum() / n
    return n, deviation, values, each @ vectors / np.sqrt(values), values / trace


def held(found, rows, ids):
    n, deviation, values, projected, explained = expected(rows)
    got = {}
    for r in found:
        assert r.n == n and r.identity_error <= 1e-8
        got.setdefault(r.vec_id, {})[r.component] = r
    assert sorted(got) == sorted(ids)
    table_ = np.array([[got[i][k + 1].whitened for k in range(len(values))] for i in ids])
    signs = np.sign((table_ * projected).sum(axis=0))
    assert np.abs(table_ - projected * signs).max() < 1e-7
    for i, d in zip(ids, deviation):
        assert all(r.deviation == d for r in got[i].values())
        assert np.allclose([got[i][k + 1].explained for k in range(len(values))], explained, 1e-9)


def test_table_equals_numpy(spark):
    rows = table(spark, SMALL, "embeddings")
    kept = rows.collect()
    found = whitening.whiten(rows).collect()
    assert len(found) == 16 * len(kept)
    held(found, [whole(map(float, r.embedding)) for r in kept], [r.vec_id for r in kept])


def test_copies_and_unusable_vectors(spark):
    """A third of the rows are one vector; it counts once."""
    rng = np.random.default_rng(4)
    good = [[float(c) for c in v] for v in rng.normal(size=(60, 5))] + [[0.5] * 5] * 30
    bad = [None, [], [1.0, None, 0.0, 0.0, 0.0], [NAN] * 5, [0.0, INF, 0.0, 0.0, 0.0], [1.0, 2.0]]
    rows = [(i, v, "x") for i, v in enumerate(good + bad)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, x string")
    found = whitening.whiten(frame.repartition(4)).collect()
    assert {r.component for r in found} == {1, 2, 3, 4, 5}
    held(found, [whole(v) for v in good], list(range(len(good))))


def test_without_variance(spark):
    schema = "vec_id long, embedding array<float>"
    for rows in ([], [(1, None)], [(1, [0.1, 0.2])], [(1, [0.1, 0.2]), (None, [0.1, 0.2])]):
        assert whitening.whiten(spark.createDataFrame(rows, schema)).collect() == []
    # two distinct vectors: one component
    two = spark.createDataFrame([(1, [0.0, 0.5]), (None, [0.5, 0.0])], schema)
    found = whitening.whiten(two).collect()
    assert [r.component for r in found] == [1, 1]
    assert sorted(round(r.whitened, 9) for r in found) == [-1.0, 1.0]
    assert [r.deviation for r in found] == [2 * 32 * 32] * 2


def test_overflow_is_an_error(spark):
    frame = spark.createDataFrame([(1, [1e8, 0.0]), (2, [0.0, 1e8])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="64 bits"):
        whitening.whiten(frame).collect()


@pytest.mark.parametrize(
    "rows",
    [
        np.random.default_rng(1).integers(-40, 40, (300, 12)),
        np.random.default_rng(2).integers(0, 2, (40, 6)),
        np.random.default_rng(3).integers(-40, 40, (5, 12)),
        np.ones((6, 4), int),
        np.array([[1, 0, 0], [0, 1, 0], [0, 0, 1], [0, 0, 0], [9, 9, 9]]),
        np.random.default_rng(5).integers(-9, 9, (200, 6)) * np.array([1, 1, 10, 10, 1000, 10**5]),
    ],
)
def test_rank_one_updates(rows):
    """Grown row by row, and combined from parts; equal and zero eigenvalues included."""

    def grown(part):
        spectrum = secular.Spectrum(rows.shape[1])
        for row in part:
            spectrum.add(row)
        return spectrum

    off = rows - rows.mean(axis=0)
    scatter, scale = off.T @ off, max(1.0, float((off * off).sum()))
    whole_, parts = grown(rows), [grown(rows[a::3]) for a in range(3)]
    parts[0].merge(parts[1])
    parts[0].merge(secular.Spectrum.from_bytes(parts[2].to_bytes()))
    parts[0].merge(secular.Spectrum(rows.shape[1]))
    for spectrum in (whole_, parts[0]):
        assert spectrum.n == len(rows) and (spectrum.sums == rows.sum(axis=0)).all()
        again = spectrum.vectors * spectrum.values @ spectrum.vectors.T
        assert np.abs(again - scatter).max() < 1e-12 * scale
        assert np.abs(spectrum.vectors.T @ spectrum.vectors - np.eye(rows.shape[1])).max() < 1e-12
        assert (np.diff(spectrum.values) >= 0).all()


def test_secular_roots_interlace():
    rng = np.random.default_rng(6)
    for _ in range(50):
        k = int(rng.integers(1, 30))
        d = np.unique(np.round(rng.normal(size=k) * 10.0 ** rng.integers(-8, 8), 12))
        z2 = rng.random(len(d)) ** 8 + 1e-12
        roots, apart = secular.solve(d, z2)
        full = np.linalg.eigvalsh(np.diag(d) + np.outer(np.sqrt(z2), np.sqrt(z2)))
        scale = np.abs(full).max()
        assert np.abs(roots - full).max() <= 1e-13 * scale * len(d)
        assert (np.diagonal(apart) <= 0).all()
