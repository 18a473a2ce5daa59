"""Connected components of links that are mostly stars already."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import keep


def components(links: DataFrame) -> DataFrame:
    """(id, component) of every vertex of links (a, b): the smallest id it can reach.

    Alternates two contractions until nothing moves: every vertex points its larger
    neighbours at its smallest neighbour, then its smaller neighbours and itself.  Rounds
    grow with the logarithm of the longest path.  Minima are combined before the shuffle
    and come back by a join, which Spark splits for a vertex with very many links; no
    vertex's links meet in one place."""
    edges = keep(
        links.select(F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo"))
        .filter("hi > lo")
        .distinct(),
        "links",
    )
    state = _fingerprint(edges)
    while True:
        edges = keep(_small_star(_large_star(edges)), "links")
        moved = _fingerprint(edges)
        if moved == state:
            break
        state = moved
    roots = edges.select(F.col("lo").alias("id"), F.col("lo").alias("component")).distinct()
    return keep(edges.select(F.col("hi").alias("id"), F.col("lo").alias("component")).union(roots),
                "components")


def _fingerprint(edges: DataFrame) -> tuple:
    parts = F.xxhash64("hi", "lo")
    return tuple(
        edges.agg(
            F.count(F.lit(1)), F.sum(F.shiftright(parts, 20)), F.bit_xor(parts)
        ).first()
    )


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.col("hi").alias("u"), F.col("lo").alias("v")).union(
        edges.select(F.col("lo").alias("u"), F.col("hi").alias("v"))
    )
    least = both.groupBy("u").agg(F.min("v").alias("m"))
    return (
        both.join(least, "u")
        .filter("v > u")
        .select(F.col("v").alias("hi"), F.least("u", "m").alias("lo"))
        .distinct()
    )


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("hi").agg(F.min("lo").alias("m"))
    others = (
        edges.join(least, "hi")
        .filter("lo > m")
        .select(F.col("lo").alias("hi"), F.col("m").alias("lo"))
    )
    own = least.select("hi", F.col("m").alias("lo"))
    return others.union(own).distinct()


class Forest:
    """Union-find over small dense integers, for the links inside one task."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def union(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        if x == y:
            return False
        self.parent[max(x, y)] = min(x, y)
        return True
