"""Models that learn batch by batch, and a running significance test.

The state of each (centres, weights, moments) is a handful of numbers; every batch
sends the driver one small partial sum per task.  With a ``path`` the state is
written after each batch and read back on restart."""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.sources.lake import path_exists


class _Kept:
    """State as one JSON row per batch; a replayed batch starts from the state
    before it and overwrites its own row.  Only the last two are kept and one is read."""

    def __init__(self, path: str | None):
        self.path = path
        self.last = -1

    def _folder(self, batch_id: int) -> str:
        return f"{self.path}/batch={batch_id}"

    def save(self, spark: SparkSession, batch_id: int, state: dict) -> None:
        if self.path:
            rows = spark.createDataFrame([(json.dumps(state),)], "state string")
            rows.write.mode("overwrite").json(self._folder(batch_id))
            old = spark._jvm.org.apache.hadoop.fs.Path(self._folder(batch_id - 2))
            old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)
        self.last = batch_id

    def before(self, spark: SparkSession, batch_id: int) -> dict | None:
        """The state after the batch before this one (batches are numbered without gaps)."""
        return self.after(spark, batch_id - 1)

    def after(self, spark: SparkSession, batch_id: int) -> dict | None:
        if not self.path or not path_exists(spark, self._folder(batch_id)):
            return None
        return json.loads(spark.read.schema("state string").json(self._folder(batch_id)).first()["state"])


def _partial_sums(batch: DataFrame, column: str, label: str | None, compute: Callable) -> list:
    """Run ``compute(matrix, labels)`` -> {slot: (weight, vector)} per Arrow batch
    and add the results up per slot."""

    def work(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[int, tuple[float, np.ndarray]] = {}
        for part in parts:
            if len(part) == 0:
                continue
            matrix = np.stack(part[column].to_numpy()).astype(float)
            labels = None if label is None else part[label].to_numpy(float)
            for slot, (weight, vector) in compute(matrix, labels).items():
                old = sums.get(slot, (0.0, 0.0))
                sums[slot] = (old[0] + weight, old[1] + vector)
        if sums:
            yield pd.DataFrame(
                [(s, w, v.tolist()) for s, (w, v) in sums.items()], columns=["slot", "weight", "vector"]
            )

    columns = [column] if label is None else [column, label]
    parts = batch.select(*columns).mapInPandas(work, "slot int, weight double, vector array<double>")
    cells = parts.select("slot", "weight", F.posexplode("vector").alias("place", "x"))
    summed = cells.groupBy("slot", "place").agg(F.sum("weight").alias("weight"), F.sum("x").alias("x"))
    return (
        summed.groupBy("slot")
        .agg(F.max("weight").alias("weight"), F.array_sort(F.collect_list(F.struct("place", "x"))).alias("v"))
        .select("slot", "weight", F.col("v.x").alias("vector"))
        .collect()
    )


class OnlineKMeans:
    """Centres move to the weighted mean of their past, times ``decay``, and the
    batch's points.  A point midway between centres goes to the last of them."""

    def __init__(self, centres: np.ndarray, decay: float = 1.0, column: str = "features", path: str | None = None):
        self.centres = np.array(centres, dtype=float)
        self.weights = np.zeros(len(self.centres))
        self.decay, self.column, self.kept = decay, column, _Kept(path)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        state = self.kept.before(spark, batch_id)
        if state:
            self.centres, self.weights = np.array(state["centres"]), np.array(state["weights"])
        centres = self.centres

        def assign(matrix, _):
            distance = ((matrix[:, None, :] - centres[None]) ** 2).sum(axis=2)
            nearest = len(centres) - 1 - distance[:, ::-1].argmin(axis=1)
            return {int(k): (float((nearest == k).sum()), matrix[nearest == k].sum(axis=0)) for k in np.unique(nearest)}

        self.weights = self.weights * self.decay
        for slot, weight, vector in _partial_sums(batch, self.column, None, assign):
            total = self.weights[slot] + weight
            self.centres[slot] = (self.centres[slot] * self.weights[slot] + np.array(vector)) / total
            self.weights[slot] = total
        self.kept.save(spark, batch_id, {"centres": self.centres.tolist(), "weights": self.weights.tolist()})


class OnlineLinear:
    """Linear or logistic weights by gradient steps, ``rounds`` per batch; the step
    shrinks with the square root of the round."""

    def __init__(self, width: int, kind: str = "linear", step: float = 0.1, rounds: int = 20, column: str = "features", label: str = "label", path: str | None = None):
        if kind not in ("linear", "logistic"):
            raise ValueError(kind)
        self.weights = np.zeros(width)
        self.kind, self.step, self.rounds = kind, step, rounds
        self.column, self.label, self.kept = column, label, _Kept(path)

    def predict(self, matrix: np.ndarray) -> np.ndarray:
        score = matrix @ self.weights
        return score if self.kind == "linear" else 1 / (1 + np.exp(-score))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        state = self.kept.before(spark, batch_id)
        if state:
            self.weights = np.array(state["weights"])
        batch = batch.select(self.column, self.label)
        if self.kind == "linear":
            self._linear(batch)
        else:
            self._logistic(batch.persist())
            batch.unpersist()
        self.kept.save(spark, batch_id, {"weights": self.weights.tolist()})

    def _step(self, turn: int, gradient: np.ndarray) -> None:
        self.weights = self.weights - self.step / math.sqrt(turn) * gradient

    def _linear(self, batch: DataFrame) -> None:
        """One pass: X'X and X'y hold all that the gradients need (width x width numbers)."""
        width = len(self.weights)

        def products(matrix, labels):
            both = np.column_stack([matrix, labels])
            return {0: (float(len(labels)), (matrix.T @ both).ravel())}

        found = _partial_sums(batch, self.column, self.label, products)
        if not found:
            return
        _, n, total = found[0]
        total = np.array(total).reshape(width, width + 1) / n
        for turn in range(1, self.rounds + 1):
            self._step(turn, total[:, :-1] @ self.weights - total[:, -1])

    def _logistic(self, batch: DataFrame) -> None:
        for turn in range(1, self.rounds + 1):
            weights = self.weights

            def gradient(matrix, labels):
                guess = 1 / (1 + np.exp(-(matrix @ weights)))
                return {0: (float(len(labels)), matrix.T @ (guess - labels))}

            found = _partial_sums(batch, self.column, self.label, gradient)
            if not found:
                break
            _, n, total = found[0]
            self._step(turn, np.array(total) / n)


# --- significance ---------------------------------------------------------------------------


def t_test_p_value(t: float, freedom: float, points: int = 4001) -> float:
    """Two-sided p-value of Student's t: Simpson's rule over the angle
    atan(t / sqrt(freedom)), where the density is a power of the cosine."""
    end = math.atan(abs(t) / math.sqrt(freedom))
    angle = np.linspace(0.0, end, points)
    height = np.exp((freedom - 1) * np.log(np.cos(angle)))
    weights = np.where(np.arange(points) % 2 == 1, 4.0, 2.0)
    weights[[0, -1]] = 1.0
    inside = (weights @ height) * end / (points - 1) / 3
    scale = math.exp(math.lgamma((freedom + 1) / 2) - math.lgamma(freedom / 2)) / math.sqrt(math.pi)
    return max(0.0, 1.0 - 2.0 * scale * inside)


class RunningTest:
    """Welch's test over everything seen since the last ``window`` batches; ``done``
    turns true once p falls below ``level``."""

    def __init__(self, level: float = 0.05, peace_batches: int = 0, window: int | None = None, path: str | None = None):
        self.level, self.peace, self.window = level, peace_batches, window
        self.batches: list[dict] = []
        self.p_value: float | None = None
        self.done = False
        self.kept = _Kept(path)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        state = self.kept.before(spark, batch_id)
        if state:
            self.batches = state["batches"]
        sums = {
            str(r["arm"]): (r["n"], r["total"], r["squares"])
            for r in batch.groupBy("arm")
            .agg(
                F.count("value").alias("n"),
                F.sum("value").alias("total"),
                F.sum(F.col("value") * F.col("value")).alias("squares"),
            )
            .collect()
        }
        self.batches.append(sums)
        if self.window:
            self.batches = self.batches[-self.window :]
        elif len(self.batches) > 1 and batch_id > self.peace:
            # without a window only the totals matter
            self.batches = [self._added()]
        if batch_id >= self.peace:
            self._test()
        self.kept.save(spark, batch_id, {"batches": self.batches})

    def _added(self) -> dict:
        arms = {a for b in self.batches for a in b}
        return {a: tuple(sum(b[a][k] for b in self.batches if a in b) for k in range(3)) for a in arms}

    def _test(self) -> None:
        arms = self._added()
        if not {"0", "1"} <= set(arms) or any(arms[a][0] < 2 for a in ("0", "1")):
            return
        means, errors, sizes = [], [], []
        for arm in ("0", "1"):
            n, total, squares = arms[arm]
            means.append(total / n)
            errors.append(max(squares - total * total / n, 0.0) / (n - 1) / n)
            sizes.append(n)
        spread = sum(errors)
        if spread == 0:
            return
        t = (means[0] - means[1]) / math.sqrt(spread)
        freedom = spread**2 / sum(e * e / (n - 1) for e, n in zip(errors, sizes))
        self.p_value = t_test_p_value(t, freedom)
        self.done = self.p_value < self.level
