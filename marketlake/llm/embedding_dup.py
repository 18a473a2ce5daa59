"""Near-duplicate vectors by a forest of random-projection trees.

A tree splits the vectors near the median of their projections on a random direction,
again and again; vectors near the cut go to both sides (spill).  The cuts come from a
bounded sample of SAMPLE vectors.  A cut is taken only if it parts few of the near pairs
that the node's sample shows: several directions and places are tried, and where each
would go through a group of near vectors, the node stays whole, whatever its size
(``dense``).  Every vector is then sent down every tree, and vectors are compared only
with those of a common leaf and label.  Cosines are worked out in double precision, so no
pair below the threshold is linked, and a pair is missed only if all trees part it.

A leaf is compared in pairs of blocks, as matrix products, so a leaf of any size is dealt
over many tasks.  A pair that meets in several leaves is counted in the first of them:
each vector carries the list of its leaves.  Vectors whose first dense leaf is the same
have met there, so where many of them share a later leaf, their blocks are compared with
the others' only, and a large group is compared once, not once a tree.  Tasks return, per
vector, its number of links and one vector it is connected with; pairs are never listed.
Equal vectors are one row with a count from the start.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components,
and vectors without label or id, link with nothing; vectors of different length are never
compared; other columns are ignored; rows that repeat an id are each counted."""

from __future__ import annotations

from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.common import keep
from marketlake.llm.components import components

THRESHOLD = 0.93
TREES = 12
SAMPLE = 50_000
LEAF = 1_000  # vectors aimed at per leaf and label
LEAST = 24  # sampled vectors a node needs to be split
SPILL = 0.07  # share of a node on each side of the cut that goes both ways
CUTS = (0.5, 0.35, 0.65)  # places of a cut, as shares of the node
DIRECTIONS = 8  # directions tried for a node
LOSS = 0.05  # share of the near pairs seen in a node that a cut may part
PAIRED = 1_000  # sampled vectors of a node whose pairs are looked at
BLOCK = 1_024
NOWHERE = 1 << 62  # instead of a leaf


class Forest:
    """Cuts of all trees.  Directions follow from tree, node and attempt, and are not
    stored; ``dense`` has the leaves that hold a group no cut may part."""

    def __init__(self, dim: int, seed: int):
        self.dim, self.seed = dim, seed
        # node: attempt, low, high, left node, right node
        self.splits: list[dict[int, tuple[int, float, float, int, int]]] = []
        self.dense: set[int] = set()
        self._directions: dict[tuple[int, int, int], np.ndarray] = {}

    def direction(self, tree: int, node: int, attempt: int) -> np.ndarray:
        key = (tree, node, attempt)
        if key not in self._directions:
            line = np.random.default_rng([self.seed, *key]).standard_normal(self.dim)
            self._directions[key] = line / np.linalg.norm(line)
        return self._directions[key]

    def grow(self, sample: np.ndarray, share: float, trees: int, threshold: float = THRESHOLD):
        """``share``: vectors that a sampled vector stands for."""
        for tree in range(trees):
            splits: dict[int, tuple[int, float, float, int, int]] = {}
            open_, named = [(1, np.arange(len(sample)))], 1
            while open_:
                node, rows = open_.pop()
                if len(rows) * share <= LEAF or len(rows) < LEAST:
                    continue
                cut = self._cut(tree, node, sample[rows], threshold)
                if cut is None:
                    self.dense.add((tree << 40) + node)
                    continue
                attempt, low, high, at = cut
                splits[node] = (attempt, low, high, named + 1, named + 2)
                open_ += [(named + 1, rows[at <= high]), (named + 2, rows[at >= low])]
                named += 2
            self.splits.append(splits)
            # only the directions of cuts are needed from here on
            self._directions = {
                k: v
                for k, v in self._directions.items()
                if k[0] < tree or k[1] in splits and splits[k[1]][0] == k[2]
            }

    def _cut(self, tree: int, node: int, vectors: np.ndarray, threshold: float):
        """(attempt, low, high, projections) of the first cut that parts few near pairs."""
        some = vectors[:: -(-len(vectors) // PAIRED)]
        a, b = np.nonzero(np.triu(some @ some.T >= threshold, 1))
        for attempt in range(DIRECTIONS):
            at = vectors @ self.direction(tree, node, attempt)
            seen = at[:: -(-len(vectors) // PAIRED)]
            least, most = np.minimum(seen[a], seen[b]), np.maximum(seen[a], seen[b])
            for place in CUTS:
                low, high = np.quantile(at, [place - SPILL, place + SPILL])
                if at.max() <= high or at.min() >= low:
                    continue  # equal projections: nothing to split
                if ((least < low) & (most > high)).sum() <= LOSS * len(a):
                    return attempt, float(low), float(high), at
        return None

    def leaves(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) pairs; a leaf is tree * 2^40 + node."""
        rows_out, leaves_out = [], []
        for tree, splits in enumerate(self.splits):
            open_ = [(1, np.arange(len(vectors)))]
            while open_:
                node, rows = open_.pop()
                if node not in splits:
                    rows_out.append(rows)
                    leaves_out.append(np.full(len(rows), (tree << 40) + node))
                    continue
                attempt, low, high, left, right = splits[node]
                at = vectors[rows] @ self.direction(tree, node, attempt)
                for side, part in ((left, rows[at <= high]), (right, rows[at >= low])):
                    if len(part):
                        open_.append((side, part))
        return np.concatenate(rows_out), np.concatenate(leaves_out)


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    flat = column.flatten() if isinstance(column, pa.Array) else column.combine_chunks().flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(-1, dim)


def _unit(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors.astype(np.float64)
    # scaled first, so that squares neither vanish nor overflow
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def usable() -> F.Column:
    """Rows that can have links."""
    bad = F.exists(
        "embedding",
        lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))),
    )
    return (
        F.col("vec_id").isNotNull()
        & F.col("label").isNotNull()
        & F.col("embedding").isNotNull()
        & ~F.coalesce(bad, F.lit(True))
        & F.exists("embedding", lambda x: x != 0)
    )


def _assign(forest: Forest, dim: int, batches):
    for batch in batches:
        if not batch.num_rows:
            continue
        vectors = _unit(_matrix(batch.column(3), dim))
        rows, leaves = forest.leaves(vectors)
        order = np.lexsort((leaves, rows))
        rows, leaves = rows[order], leaves[order]
        bounds = np.searchsorted(rows, np.arange(batch.num_rows + 1))
        lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(leaves))
        # first dense leaf of each vector; none before it counts
        home = np.full(batch.num_rows, NOWHERE)
        dense = np.isin(leaves, list(forest.dense))
        np.minimum.at(home, rows[dense], leaves[dense])
        core = np.where(home[rows] < leaves, home[rows], NOWHERE)
        spread = batch.take(pa.array(rows))
        yield pa.RecordBatch.from_arrays(
            [*spread.columns, pa.array(leaves), lists.take(pa.array(rows)), pa.array(core)],
            names=["vec_id", "label", "n", "embedding", "leaf", "leaves", "core"],
        )


def _components_of(pairs: tuple[np.ndarray, np.ndarray], n: int) -> np.ndarray:
    """Smallest row reachable, by label passing over the links with shortcuts."""
    label = np.arange(n)
    a, b = pairs
    while True:
        new = label.copy()
        np.minimum.at(new, a, label[b])
        np.minimum.at(new, b, label[a])
        new = new[new]
        if (new == label).all():
            return label
        label = new


def _compare(dim: int, threshold: float, group: pd.DataFrame) -> pd.DataFrame:
    """Links of a pair of blocks: per vector their number, and a connected vector."""
    group = group.sort_values(["vec_id", "block"])
    leaf = int(group["leaf"].iloc[0])
    one = int(group["x"].iloc[0]) == int(group["y"].iloc[0])
    ids, counts = group["vec_id"].to_numpy(), group["n"].to_numpy()
    unit = _unit(np.stack(group["embedding"].to_numpy()).reshape(-1, dim))
    # leaves before this one, as indicator columns, tell pairs that met already
    earlier = [np.asarray(x)[np.asarray(x) < leaf] for x in group["leaves"]]
    names, at = np.unique(np.concatenate(earlier), return_inverse=True)
    met = np.zeros((len(ids), max(1, len(names))), np.float32)
    met[np.repeat(np.arange(len(ids)), [len(x) for x in earlier]), at] = 1
    if one:
        left = right = np.arange(len(ids))
    else:
        first = group["block"].to_numpy() == group["x"].iloc[0]
        left, right = np.flatnonzero(first), np.flatnonzero(~first)
    links = np.zeros(len(ids), np.int64)
    found_a, found_b = [], []
    for a in range(0, len(left), 512):
        rows = left[a : a + 512]
        near = unit[rows] @ unit[right].T >= threshold
        if not near.any():
            continue
        fresh = near & (met[rows] @ met[right].T == 0)
        if one:
            upper = right[None, :] > rows[:, None]
            near &= upper
            fresh &= upper
        links[rows] += fresh @ counts[right]
        links[right] += fresh.T @ counts[rows]
        i, j = np.nonzero(near)
        found_a.append(rows[i])
        found_b.append(right[j])
    if not found_a:
        return pd.DataFrame({"vec_id": ids[:0], "links": links[:0], "with_id": ids[:0]})
    root = _components_of((np.concatenate(found_a), np.concatenate(found_b)), len(ids))
    some = (links > 0) | (root != np.arange(len(ids)))
    return pd.DataFrame(
        {"vec_id": ids[some], "links": links[some], "with_id": ids[root[some]]}
    )


def _dealing(placed: DataFrame) -> DataFrame:
    """label, leaf, _blocks and _parts of leaves with two rows or more: for each core that
    fills a block its blocks, which needn't be compared with one another; the other rows
    share those under NOWHERE."""
    large = (F.col("core") != NOWHERE) & (F.col("_rows") >= BLOCK)
    parts = (
        placed.groupBy("label", "leaf", "core")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .withColumn("core", F.when(large, F.col("core")).otherwise(F.lit(NOWHERE)))
        .groupBy("label", "leaf", "core")
        .agg(F.sum("_rows").alias("_rows"))
        .withColumn("blocks", F.ceil(F.col("_rows") / BLOCK))
    )
    before = (
        Window.partitionBy("label", "leaf").orderBy("core").rowsBetween(Window.unboundedPreceding, -1)
    )
    part = F.struct(
        F.coalesce(F.sum("blocks").over(before), F.lit(0)).alias("first"),
        "blocks",
        (F.col("core") != NOWHERE).alias("met"),
    )
    return (
        parts.withColumn("part", part)
        .groupBy("label", "leaf")
        .agg(
            F.map_from_entries(F.collect_list(F.struct("core", "part"))).alias("_parts"),
            F.sum("blocks").alias("_blocks"),
            F.sum("_rows").alias("_rows"),
        )
        .filter("_rows > 1")
        .drop("_rows")
    )


def _of_dimension(distinct: DataFrame, dim: int, threshold: float, seed: int) -> DataFrame:
    total = distinct.count()
    sample = (
        distinct.orderBy(F.xxhash64(F.lit(seed), "vec_id")).limit(SAMPLE).select("embedding")
    )
    vectors = np.array([r[0] for r in sample.collect()], np.float64).reshape(-1, dim)
    labels = max(1, distinct.select("label").distinct().count())
    forest = Forest(dim, seed)
    forest.grow(_unit(vectors), total / len(vectors) / labels, TREES, threshold)
    kind = distinct.schema["embedding"].dataType.simpleString()
    placed = distinct.mapInArrow(
        partial(_assign, forest, dim),
        f"vec_id long, label string, n long, embedding {kind}, leaf long, "
        "leaves array<long>, core long",
    )
    placed = keep(placed, "leaves")
    paired = (
        placed.join(_dealing(placed), ["label", "leaf"])
        .withColumn("_part", F.coalesce(F.col("_parts")[F.col("core")], F.col("_parts")[NOWHERE]))
        .withColumn(
            "block",
            (F.col("_part.first") + F.pmod(F.xxhash64("vec_id"), F.col("_part.blocks"))).cast("int"),
        )
        .withColumn(
            "_other",
            F.explode(
                F.filter(
                    F.sequence(F.lit(0), F.col("_blocks") - 1),
                    lambda x: ~F.col("_part.met")
                    | (x < F.col("_part.first"))
                    | (x >= F.col("_part.first") + F.col("_part.blocks")),
                )
            ),
        )
        .withColumn("x", F.least("block", "_other").cast("int"))
        .withColumn("y", F.greatest("block", "_other").cast("int"))
        .drop("_parts", "_part", "_blocks", "_other", "core")
    )
    return paired.groupBy("label", "leaf", "x", "y").applyInPandas(
        partial(_compare, dim, threshold), "vec_id long, links long, with_id long"
    )


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, seed: int = 7) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of (vec_id, embedding, label)."""
    rows = keep(
        vectors.select(
            F.col("vec_id").cast("long"),
            F.when(usable(), F.col("label")).cast("string").alias("label"),
            F.when(usable(), F.col("embedding")).alias("embedding"),
        ).withColumn("digest", F.sha2(F.to_json(F.struct("label", "embedding")), 256)),
        "vectors",
    )
    distinct = keep(
        rows.filter("embedding IS NOT NULL")
        .groupBy("digest", "label")
        .agg(
            F.min("vec_id").alias("vec_id"),
            F.count(F.lit(1)).alias("n"),
            F.first("embedding").alias("embedding"),
        ),
        "distinct-vectors",
    )
    partial_links = None
    # one dimension as a rule; each has its own forest
    for row in distinct.select(F.size("embedding").alias("dim")).distinct().collect():
        of_dim = distinct.filter(F.size("embedding") == row["dim"]).select(
            "vec_id", "label", "n", "embedding"
        )
        found = _of_dimension(of_dim, row["dim"], threshold, seed)
        partial_links = found if partial_links is None else partial_links.union(found)
    if partial_links is None:
        partial_links = rows.sparkSession.createDataFrame(
            [], "vec_id long, links long, with_id long"
        )
    partial_links = keep(partial_links, "vector-links")
    linked = components(partial_links.select(F.col("vec_id").alias("a"), F.col("with_id").alias("b")))
    counted = partial_links.groupBy("vec_id").agg(F.sum("links").alias("links"))
    named = (
        distinct.select("digest", "vec_id", "n")
        .join(counted, "vec_id", "left")
        .join(linked.withColumnRenamed("id", "vec_id"), "vec_id", "left")
        .select(
            "digest",
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links"),
            F.coalesce("component", "vec_id").alias("component"),
        )
    )
    return (
        rows.filter("embedding IS NOT NULL")
        .select("vec_id", "digest")
        .join(named, "digest")
        .select("vec_id", F.col("links").alias("n_links"), F.col("component").alias("component_id"))
        .union(
            rows.filter("embedding IS NULL").select(
                "vec_id", F.lit(0).cast("long"), F.col("vec_id").alias("component_id")
            )
        )
        .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
    )
