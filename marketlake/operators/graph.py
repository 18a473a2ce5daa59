"""Graph measures on edge tables (``src``, ``dst``).

Every loop keeps its state in a reliable checkpoint, so a round never replays the
rounds before it and survives lost executors.  Edges are dealt by their source once and
stay there: a round shuffles what it sends, not the edges.  Only counters reach the driver."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.session import cut_as_dealt, cut_by_key, cut_lineage, release, slice_count

RESET, DAMPING = 0.15, 0.85
SENT, MOST_ROUNDS = 4, 32  # entries of lists that travel in a round, by the edges; rounds


def both_ways(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select("dst", "src")).distinct()


def vertices(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()


def transitive_closure(edges: DataFrame) -> DataFrame:
    """All (src, dst) joined by a path.  Each round extends only the paths found
    in the round before."""
    steps = edges.select("src", "dst").distinct()
    known = fresh = cut_lineage(steps)
    while True:
        longer = (
            fresh.withColumnRenamed("dst", "via")
            .join(steps.withColumnsRenamed({"src": "via"}), "via")
            .select("src", "dst")
            .distinct()
        )
        fresh = cut_lineage(longer.join(known, ["src", "dst"], "left_anti"))
        if fresh.isEmpty():
            return known
        known = cut_lineage(known.union(fresh))


def pagerank(
    edges: DataFrame, rounds: int = 10, tolerance: float | None = None, keep: int = 5
) -> DataFrame:
    """(id, rank): reset 0.15 + 0.85 * sum(rank / out-degree) over in-neighbours.

    Runs ``rounds`` rounds; with a ``tolerance``, until no rank moves by more, and
    raises if ``rounds`` are not enough.  Lineage is cut and movement checked every
    ``keep`` rounds."""
    links = cut_by_key(edges.select("src", "dst"), "src")
    share = links.groupBy(F.col("src").alias("id")).agg((1.0 / F.count(F.lit(1))).alias("share"))
    # a vertex without in-links still takes part: it receives nothing
    floor = cut_lineage(vertices(links).join(share, "id", "left").withColumn("part", F.lit(0.0)))
    ranks = floor.select("id", F.lit(1.0).alias("rank"), "share")
    for step in range(1, rounds + 1):
        sent = links.join(ranks.withColumnRenamed("id", "src"), "src").select(
            F.col("dst").alias("id"),
            F.lit(None).cast("double").alias("share"),
            (F.col("rank") * F.col("share")).alias("part"),
        )
        updated = (
            sent.unionByName(floor)
            .groupBy("id")
            .agg((RESET + DAMPING * F.sum("part")).alias("rank"), F.max("share").alias("share"))
        )
        phase = step % keep
        if phase == 0 or (tolerance is not None and phase == keep - 1):
            updated = cut_lineage(updated)
        if tolerance is not None and phase == 0:
            moved = updated.join(ranks.select("id", F.col("rank").alias("old")), "id").agg(
                F.max(F.abs(F.col("rank") - F.col("old")))
            )
            if moved.first()[0] <= tolerance:
                return updated.drop("share")
        ranks = updated
    if tolerance is not None:
        raise RuntimeError(f"ranks still move by more than {tolerance} after {rounds} rounds")
    return ranks.drop("share")


def connected_components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest vertex id that can be reached.

    A round takes the smallest label among the neighbours whose label has just fallen,
    and then jumps to the label's own label, which halves long chains; the number of
    rounds grows with the logarithm of the longest path, not with its length."""
    links = cut_by_key(both_ways(edges), "src")
    # before the first message a vertex knows itself and its neighbours
    labels = cut_lineage(
        links.groupBy(F.col("src").alias("id")).agg(F.least(F.min("dst"), F.first("src")).alias("component"))
    )
    moved = labels
    while True:
        # only labels that have just fallen are sent on
        offered = links.join(moved.withColumnRenamed("id", "src"), "src").select(
            F.col("dst").alias("id"), "component", F.lit(None).cast("bigint").alias("old")
        )
        own = labels.select("id", "component", F.col("component").alias("old"))
        lower = (
            own.union(offered)
            .groupBy("id")
            .agg(F.min("component").alias("component"), F.max("old").alias("old"))
        )
        target = labels.select(F.col("id").alias("component"), F.col("component").alias("jump"))
        jumped = cut_lineage(
            lower.join(target, "component").select(
                "id", F.least("component", "jump").alias("component"), "old"
            )
        )
        labels = jumped.select("id", "component")
        moved = jumped.filter("component != old").select("id", "component")
        if moved.isEmpty():
            return labels


def _simple(edges: DataFrame) -> DataFrame:
    """(a, b), a < b, each once, dealt by a."""
    pairs = edges.filter("src != dst").select(F.least("src", "dst").alias("a"), F.greatest("src", "dst").alias("b"))
    dealt = pairs.repartition(slice_count(edges.sparkSession), "a")
    return cut_as_dealt(dealt.distinct().sortWithinPartitions("a"))


def _degrees(simple: DataFrame) -> DataFrame:
    ids = simple.select(F.explode(F.array("a", "b")).alias("id"))
    return cut_lineage(ids.groupBy("id").agg(F.count(F.lit(1)).alias("degree")))


def _ends(simple: DataFrame, degrees: DataFrame) -> DataFrame:
    """(u, degree, out): the ends of the edges that point from u, dealt by u."""
    ranked = simple.join(degrees.select(F.col("id").alias("a"), F.col("degree").alias("da")), "a").join(
        degrees.select(F.col("id").alias("b"), F.col("degree").alias("db")), "b"
    )
    low_first = F.struct("da", "a") < F.struct("db", "b")
    low = F.struct(F.col("a").alias("u"), F.col("b").alias("v"), F.col("da").alias("degree"))
    high = F.struct(F.col("b").alias("u"), F.col("a").alias("v"), F.col("db").alias("degree"))
    pointed = ranked.select(F.when(low_first, low).otherwise(high).alias("e")).select("e.*")
    lists = pointed.groupBy("u").agg(F.max("degree").alias("degree"), F.array_sort(F.collect_list("v")).alias("out"))
    return cut_as_dealt(lists.sortWithinPartitions("u"))


def _rounds(ends: DataFrame) -> int:
    """So many that the lists which travel in one are a few times the edges."""
    size = F.size("out").cast("bigint")
    sent, edges = ends.agg(F.sum((F.col("degree") - size) * size), F.sum(size)).first()
    return min(MOST_ROUNDS, math.ceil(sent / (SENT * edges)) or 1) if edges else 1


def _closed(ends: DataFrame, step: int, rounds: int) -> DataFrame:
    """(id, triangles) of the triangles whose middle vertex has its turn in this round."""
    turn = F.pmod(F.xxhash64("v"), F.lit(rounds)) == step
    # edges follow one total order, so each triangle is one edge u, v and an end w of both
    onward = ends.select(F.col("u").alias("v"), F.col("out").alias("onward")).filter(turn)
    carried = ends.select("u", F.explode("out").alias("v")).filter(turn).join(onward, "v")
    triangles = carried.join(ends.select("u", "out"), "u").select(
        "u", "v", F.explode(F.array_intersect("onward", "out")).alias("w")
    )
    return (
        triangles.select(F.explode(F.array("u", "v", "w")).alias("id"))
        .groupBy("id")
        .agg(F.count(F.lit(1)).alias("triangles"))
    )


def triangle_counts(edges: DataFrame) -> DataFrame:
    """(id, triangles) for every vertex.

    Edges point from the vertex of lower degree to the one of higher degree.  No
    vertex then has more than sqrt(2 * edges) outgoing ones, however large a hub is.
    The outgoing ends of a vertex travel as one list to each vertex that points to it
    and are compared there: no path of two edges becomes a row unless it closes.  They
    travel in rounds, by the vertex whose list it is; the files of one step or round
    are released before the next, so that disk holds one of them."""
    spark = edges.sparkSession
    simple = _simple(edges)
    release(spark)
    degrees = _degrees(simple)
    release(spark)
    ends = _ends(simple, degrees)
    del simple
    release(spark)
    rounds = _rounds(ends)
    counted = []
    for step in range(rounds - 1):
        counted.append(cut_lineage(_closed(ends, step, rounds)))
        release(spark)
    counted.append(_closed(ends, rounds - 1, rounds))
    total = reduce(DataFrame.union, counted).groupBy("id").agg(F.sum("triangles").alias("triangles"))
    return degrees.select("id").join(total, "id", "left").fillna(0, ["triangles"])


def shortest_paths(edges: DataFrame, source: int) -> DataFrame:
    """(id, distance) from one vertex over edges with a non-negative ``weight``.
    Only vertices whose distance just fell are relaxed again."""
    links = cut_by_key(edges.groupBy("src", "dst").agg(F.min("weight").alias("weight")), "src")
    best = front = cut_lineage(
        vertices(links).filter(F.col("id") == source).select("id", F.lit(0).cast("bigint").alias("distance"))
    )
    while not front.isEmpty():
        offered = (
            front.withColumnRenamed("id", "src")
            .join(links, "src")
            .groupBy(F.col("dst").alias("id"))
            .agg(F.min(F.col("distance") + F.col("weight")).alias("offer"))
        )
        merged = cut_lineage(
            best.join(offered, "id", "full").select(
                "id",
                F.least("distance", "offer").alias("distance"),
                (F.col("distance").isNull() | (F.col("offer") < F.col("distance"))).alias("fell"),
            )
        )
        best = merged.select("id", "distance")
        front = merged.filter("fell").select("id", "distance")
    return best


def neighbours_above(edges: DataFrame, attributes: DataFrame) -> DataFrame:
    """Per vertex: number and mean attribute of the in-neighbours whose attribute
    (``id``, ``value``) is higher than its own."""
    own = attributes.select(F.col("id").alias("dst"), F.col("value").alias("own"))
    theirs = attributes.select(F.col("id").alias("src"), F.col("value").alias("theirs"))
    return (
        edges.join(theirs, "src")
        .join(own, "dst")
        .filter("theirs > own")
        .groupBy(F.col("dst").alias("id"))
        .agg(F.count(F.lit(1)).alias("higher"), F.avg("theirs").alias("mean_higher"))
    )


def subgraph(edges: DataFrame, members: DataFrame) -> DataFrame:
    """Edges with both ends among ``members`` (``id``)."""
    return edges.join(members.select(F.col("id").alias("src")), "src", "left_semi").join(
        members.select(F.col("id").alias("dst")), "dst", "left_semi"
    )


def ranked_members(
    edges: DataFrame, attributes: DataFrame, member: Column, rounds: int = 10, top: int = 5
) -> DataFrame:
    """Attributes joined to vertices, the subgraph of members, its top ranks."""
    known = vertices(edges).join(attributes, "id", "left").filter(member)
    ranks = pagerank(subgraph(edges, known), rounds)
    return ranks.join(attributes, "id", "left").orderBy(F.desc("rank"), "id").limit(top)
