"""Whitening of embedding vectors by incremental eigendecomposition.

Entries become whole numbers, floor(64 c) + 1000000, so that counts, sums and deviations are
exact.  The fit list holds each distinct vector once.

1. Every partition of the fit list grows a spectrum (count, exact sums, mean, eigenvalues,
   eigenvectors) by one centred rank-one update per vector (``secular``).
2. Spectra are combined eight at a time, in rounds: one rank-one update per eigenvector of the
   other, and one for the distance of the means.
3. Rayleigh-Ritz: the tasks project the exactly centred rows on the combined eigenvectors and
   add up the products; the small eigenproblem of their sum turns the basis into the
   eigenvectors of the covariance to double precision, whatever the updates have gathered in
   rounding.
4. A further pass over the fit list measures the covariance of the whitened vectors.

A spectrum is as large as the square of the vectors' width, and so is all that reaches the
driver; an update takes time with the cube of the width, whatever the number of rows.

Defined cases: vectors that are null or hold null or non-finite entries are dropped, and so
are empty ones and those shorter than the longest, which lack entries; rows that repeat a
vector count once in the fit list and are all returned; vec_id may be null or repeated; other
columns are ignored.  Components without variance (eigenvalue at most 1e-12 of the trace)
can't be whitened and are left out, so fewer than two distinct vectors, or no rows, give no
rows.  Entries or deviations beyond 64 bits raise an error."""

from __future__ import annotations

import io
from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import keep
from marketlake.llm.secular import Spectrum
from marketlake.session import slice_count

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
NO_VARIANCE = 1e-12
FAN_IN = 8
_BLOCK = 4096
_STATE = "place long, state binary"


@dataclass(frozen=True)
class Whitening:
    """n vectors with sums per dimension; components as columns, by falling eigenvalue."""

    n: int
    sums: np.ndarray
    components: np.ndarray
    eigenvalues: np.ndarray
    trace: float
    identity_error: float

    def deviations(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums, exact."""
        largest = max(int(np.abs(x).max(initial=0)) * self.n, int(np.abs(self.sums).max()))
        if 2 * largest >= 1 << 63:
            raise OverflowError("n * x doesn't fit in 64 bits")
        return self.n * x - self.sums

    def whitened(self, deviations: np.ndarray) -> np.ndarray:
        return (deviations / self.n) @ (self.components / np.sqrt(self.eigenvalues))


def whole_vectors(embeddings: DataFrame) -> DataFrame:
    """vec_id, x: the vectors that remain, in whole numbers."""
    usable = F.forall(
        "embedding",
        lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))),
    )
    x = F.transform("embedding", lambda c: F.floor(c.cast("double") * SCALE) + SHIFT)
    rows = keep(
        embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
        .filter(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & usable)
        .select("vec_id", x.alias("x")),
        "whole-vectors",
    )
    width = rows.agg(F.max(F.size("x"))).first()[0] or 0
    return rows.filter(F.size("x") == width)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _blocks(batches, place: int, width: int):
    for batch in batches:
        x = _matrix(batch.column(place), width)
        for a in range(0, len(x), _BLOCK):
            yield x[a : a + _BLOCK]


def _state(state: bytes) -> pa.RecordBatch:
    place = TaskContext.get().partitionId()
    return pa.RecordBatch.from_arrays(
        [pa.array([place], pa.int64()), pa.array([state], pa.binary())], names=["place", "state"]
    )


def _spectrum(width: int, batches):
    grown = Spectrum(width)
    for x in _blocks(batches, 0, width):
        for row in x - SHIFT:
            grown.add(row)
    if grown.n:
        yield _state(grown.to_bytes())


def _merge_spectra(states: list[bytes]) -> bytes:
    first, *others = map(Spectrum.from_bytes, states)
    for other in others:
        first.merge(other)
    return first.to_bytes()


def _array_bytes(values: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.save(out, values)
    return out.getvalue()


def _add_arrays(states: list[bytes]) -> bytes:
    return _array_bytes(sum(np.load(io.BytesIO(s)) for s in states))


def combine(states: DataFrame, merge: Callable[[list[bytes]], bytes]) -> bytes | None:
    """One state from the states of all tasks, FAN_IN at a time, in the order of the tasks."""

    def merged(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        ordered = group.sort_values("place")["state"].tolist()
        return pd.DataFrame({"place": [key[0]], "state": [merge(ordered)]})

    states = keep(states, "states")
    while (left := states.count()) > 1:
        ranked = states.withColumn("place", F.expr(f"place div {FAN_IN}"))
        states = keep(ranked.groupBy("place").applyInPandas(merged, _STATE), "states")
    return states.first()["state"] if left else None


def _products(width: int, center: np.ndarray, n: int, basis: np.ndarray, batches):
    """Sum of y y' over the centred and projected rows."""
    total = np.zeros((basis.shape[1], basis.shape[1]))
    for x in _blocks(batches, 0, width):
        y = ((n * x - center) / n) @ basis
        total += y.T @ y
    yield _state(_array_bytes(total))


def _whitened_sums(fitted: Whitening, batches):
    """Sum of the whitened vectors (first row) and of their products."""
    k = len(fitted.eigenvalues)
    total = np.zeros((k + 1, k))
    for x in _blocks(batches, 0, len(fitted.sums)):
        w = fitted.whitened(fitted.deviations(x))
        total[0] += w.sum(axis=0)
        total[1:] += w.T @ w
    yield _state(_array_bytes(total))


def _refined(fit: DataFrame, start: Spectrum) -> tuple[np.ndarray, np.ndarray]:
    """Rayleigh-Ritz: eigenvalues (falling) and eigenvectors of the covariance."""
    width = len(start.sums)
    basis = np.linalg.qr(start.vectors[:, ::-1])[0]
    sums = start.sums + start.n * SHIFT
    products = fit.mapInArrow(partial(_products, width, sums, start.n, basis), _STATE)
    small = np.load(io.BytesIO(combine(products, _add_arrays))) / start.n
    values, turn = np.linalg.eigh((small + small.T) / 2)
    vectors = basis @ turn[:, ::-1]
    # either sign is right; this one doesn't depend on the order of the rows
    heads = vectors[np.abs(vectors).argmax(axis=0), np.arange(width)]
    return values[::-1], vectors * np.where(heads < 0, -1.0, 1.0)


def fit_whitening(rows: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """Whitening of the distinct vectors among rows (x); None without variance."""
    width = rows.agg(F.max(F.size("x"))).first()[0]
    if not width:
        return None
    fit = keep(rows.select("x").distinct(), "fit-list")
    # updates cost far more than reading, so they are dealt over all tasks
    dealt = fit.repartition(slice_count(rows.sparkSession), "x")
    spectrum = Spectrum.from_bytes(
        combine(dealt.mapInArrow(partial(_spectrum, width), _STATE), _merge_spectra)
    )
    values, vectors = _refined(fit, spectrum)
    trace = float(values.sum())
    k = int((values[:components] > NO_VARIANCE * trace).sum()) if trace > 0 else 0
    if k == 0:
        return None
    sums = spectrum.sums + spectrum.n * SHIFT
    fitted = Whitening(spectrum.n, sums, vectors[:, :k], values[:k], trace, 0.0)
    measured = fit.mapInArrow(partial(_whitened_sums, fitted), _STATE)
    total = np.load(io.BytesIO(combine(measured, _add_arrays))) / fitted.n
    covariance = total[1:] - np.outer(total[0], total[0])
    error = float(np.abs(covariance - np.eye(k)).max())
    return replace(fitted, identity_error=error)


_OUT = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, "
    "identity_error double"
)


def _apply(fitted: Whitening, batches):
    k, width = len(fitted.eigenvalues), len(fitted.sums)
    explained = fitted.eigenvalues / fitted.trace
    for batch in batches:
        x = _matrix(batch.column(1), width)
        off = fitted.deviations(x)
        if float(np.abs(off).max(initial=0)) ** 2 * width >= 2.0**63:
            raise OverflowError("a squared deviation doesn't fit in 64 bits")
        rows = len(x) * k
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(pa.array(np.repeat(np.arange(len(x)), k))),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                pa.array(np.full(rows, fitted.n)),
                pa.array(np.repeat((off * off).sum(axis=1), k)),
                pa.array(fitted.whitened(off).ravel()),
                pa.array(np.tile(explained, len(x))),
                pa.array(np.full(rows, fitted.identity_error)),
            ],
            names=[part.split()[0] for part in _OUT.split(", ")],
        )


def whiten(embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """vec_id, component, n, deviation, whitened, explained, identity_error: a row for each
    remaining vector and component."""
    rows = whole_vectors(embeddings)
    fitted = fit_whitening(rows, components)
    if fitted is None:
        return embeddings.sparkSession.createDataFrame([], _OUT)
    return rows.select("vec_id", "x").mapInArrow(partial(_apply, fitted), _OUT)
