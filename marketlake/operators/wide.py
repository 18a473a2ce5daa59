"""Singular values and principal components of tables with very many columns.

A block of directions (width x a few) is carried through the rows again and again: every task
adds up A'(A X) over its rows, the sums meet in a tree, and the block is made orthonormal anew.
The start is random, from a seed.  At the end A X is reduced by a tree of QR steps, each as small
as the block, and the singular values are those of the last triangle, so nothing is squared.
Memory, in tasks and on the driver, is width x block; no width x width matrix is ever made."""

from __future__ import annotations

import io
from collections.abc import Callable
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.session import cut_lineage

FAN_IN = 8
_STATE = "place long, state binary"
_ROWS_AT_ONCE = 1024


@dataclass(frozen=True)
class Decomposition:
    """Singular values, falling, and right singular vectors as columns; the means if centred."""

    rows: int
    values: np.ndarray
    vectors: np.ndarray
    means: np.ndarray | None

    def variances(self) -> np.ndarray:
        return self.values**2 / max(1, self.rows - 1)


def _bytes(matrix: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.save(out, matrix)
    return out.getvalue()


def _matrix(state: bytes) -> np.ndarray:
    return np.load(io.BytesIO(state))


def _state(matrix: np.ndarray) -> pa.RecordBatch:
    place = TaskContext.get().partitionId()
    return pa.RecordBatch.from_arrays(
        [pa.array([place], pa.int64()), pa.array([_bytes(matrix)], pa.binary())], names=["place", "state"]
    )


def combined(states: DataFrame, merge: Callable[[list[np.ndarray]], np.ndarray]) -> np.ndarray | None:
    """One matrix from those of all tasks, FAN_IN at a time, in the order of the tasks."""

    def merged(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        parts = [_matrix(s) for s in group.sort_values("place")["state"]]
        return pd.DataFrame({"place": [key[0]], "state": [_bytes(merge(parts))]})

    states = cut_lineage(states)
    while (left := states.count()) > 1:
        ranked = states.withColumn("place", F.expr(f"place div {FAN_IN}"))
        states = cut_lineage(ranked.groupBy("place").applyInPandas(merged, _STATE))
    return _matrix(states.first()["state"]) if left else None


def _add(parts: list[np.ndarray]) -> np.ndarray:
    return sum(parts)


def _triangle(parts: list[np.ndarray]) -> np.ndarray:
    return np.linalg.qr(np.concatenate(parts), mode="r")


def _pieces(batches, width: int, means: np.ndarray | None):
    for batch in batches:
        rows = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
        for a in range(0, len(rows), _ROWS_AT_ONCE):
            piece = rows[a : a + _ROWS_AT_ONCE]
            yield piece if means is None else piece - means


def _totals(width: int, batches):
    total = np.zeros(width + 1)
    for piece in _pieces(batches, width, None):
        total[:width] += piece.sum(axis=0)
        total[width] += len(piece)
    yield _state(total)


def _through(block: np.ndarray, means: np.ndarray | None, batches):
    total = np.zeros_like(block)
    for piece in _pieces(batches, len(block), means):
        total += piece.T @ (piece @ block)
    yield _state(total)


def _reduced(block: np.ndarray, means: np.ndarray | None, batches):
    triangle = np.zeros((0, block.shape[1]))
    for piece in _pieces(batches, len(block), means):
        triangle = _triangle([triangle, piece @ block])
    yield _state(triangle)


def decompose(
    df: DataFrame,
    column: str,
    k: int,
    oversample: int | None = None,
    centred: bool = False,
    tolerance: float = 1e-10,
    rounds: int = 30,
    seed: int = 1,
) -> Decomposition | None:
    """The ``k`` largest singular values and vectors of the rows of an array column; of the
    centred rows for principal components.  Rows with a null array don't count; no rows give
    None.  Stops when the values have settled to ``tolerance`` or after ``rounds`` passes."""
    rows = cut_lineage(
        df.select(F.col(column).cast("array<double>").alias("row")).filter("row IS NOT NULL")
    )
    width = rows.agg(F.max(F.size("row"))).first()[0]
    if not width:
        return None
    totals = combined(rows.mapInArrow(partial(_totals, width), _STATE), _add)
    n = int(totals[width])
    means = totals[:width] / n if centred else None
    size = min(width, k + (max(10, k) if oversample is None else oversample))
    block = np.linalg.qr(np.random.default_rng(seed).standard_normal((width, size)))[0]
    before = np.zeros(size)
    for _ in range(rounds):
        image = combined(rows.mapInArrow(partial(_through, block, means), _STATE), _add)
        block, triangle = np.linalg.qr(image)
        values = np.sqrt(np.abs(np.linalg.svd(triangle, compute_uv=False)))
        if size == width or np.abs(values - before)[:k].max() <= tolerance * max(values[0], 1e-300):
            break
        before = values
    triangle = combined(rows.mapInArrow(partial(_reduced, block, means), _STATE), _triangle)
    _, values, turn = np.linalg.svd(triangle, full_matrices=False)
    vectors = block @ turn.T
    heads = vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])]
    k = min(k, len(values))
    return Decomposition(n, values[:k], (vectors * np.where(heads < 0, -1.0, 1.0))[:, :k], means)
