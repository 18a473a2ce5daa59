"""Exact search for the largest inner products, block by block in order of the items' length."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.session import cut_lineage

FIRST = 4096  # longest items, against which every user finds a bound
USERS, ITEMS = 512, 4096  # compared at once
SLACK = 1e-5  # of single precision


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy().astype(np.float32)
    return flat.reshape(len(column), -1)


def _bounds(longest: np.ndarray, top: int):
    """(id, features, least, need): the ``top``-th best score of the longest items, and the length
    an item must have to reach it."""

    def bound(batches):
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            if not len(rows):
                continue
            users = _matrix(rows.column("features"))
            least = np.full(len(users), -np.inf)
            if len(longest) >= top:
                for at in range(0, len(users), USERS):
                    scores = users[at : at + USERS] @ longest.T
                    least[at : at + USERS] = np.partition(scores, -top, axis=1)[:, -top]
            least -= SLACK * np.abs(np.where(np.isfinite(least), least, 0))
            least = np.nextafter(least, -np.inf)  # scores that equal it count
            length = np.linalg.norm(users.astype(np.float64), axis=1)
            need = np.where(least > 0, least / np.maximum(length, 1e-300), -np.inf)
            yield from rows.append_column("least", pa.array(least)).append_column("need", pa.array(need)).to_batches()

    return bound


def _best(top: int):
    """(user, item, score) of a block of users and a block of items, both as lists in one row."""

    def best(pair: pa.Table) -> pa.Table:
        row = pair.combine_chunks()
        ids, of = (row.column(c).chunk(0).flatten().to_numpy() for c in ("users", "items"))
        u, v = (row.column(c).chunk(0).flatten().flatten().to_numpy() for c in ("user_rows", "item_rows"))
        users, items = u.reshape(len(ids), -1), v.reshape(len(of), -1)
        least = row.column("least").chunk(0).flatten().to_numpy()
        lengths = [np.linalg.norm(x.astype(np.float64), axis=1) for x in (users, items)]
        scores = np.full((len(ids), top), -np.inf, np.float32)
        found = np.zeros((len(ids), top), of.dtype)
        for at in range(0, len(ids), USERS):
            for to in range(0, len(of), ITEMS):
                some = slice(at, at + USERS)
                limit = np.maximum(least[some], scores[some].min(axis=1))
                reach = lengths[0][some] * lengths[1][to : to + ITEMS].max() * (1 + SLACK)
                near = at + np.flatnonzero(reach >= limit)
                if not len(near):
                    continue
                new = users[near] @ items[to : to + ITEMS].T
                hit = (new > limit[near - at][:, None]).any(axis=1)
                near, new = near[hit], new[hit]
                if not len(near):
                    continue
                joined = np.hstack([scores[near], new])
                names = np.hstack([found[near], np.broadcast_to(of[to : to + ITEMS], new.shape)])
                order = np.argpartition(-joined, top - 1, axis=1)[:, :top]
                scores[near] = np.take_along_axis(joined, order, axis=1)
                found[near] = np.take_along_axis(names, order, axis=1)
        at, place = np.nonzero((scores > -np.inf) & (scores >= least[:, None]))
        return pa.table({"user": ids[at], "item": found[at, place], "score": scores[at, place]})

    return best


def _blocks(rows: DataFrame, order: list, block: int, aggregates: list, name: str) -> DataFrame:
    """Rows that follow each other in ``order``, packed into one row a block."""
    count = max(1, -(-rows.count() // block))
    dealt = rows.repartitionByRange(count, *order).withColumn(name, F.spark_partition_id())
    return cut_lineage(dealt.groupBy(name).agg(*aggregates))


def _listed(order: list[str], fields: dict[str, str]) -> list:
    packed = F.array_sort(F.collect_list(F.struct(*dict.fromkeys([*order, *fields]))))
    return [packed.getField(f).alias(name) for f, name in fields.items()]


def largest(users: DataFrame, items: DataFrame, top: int, block: int = 1 << 15) -> DataFrame:
    """(user, item, score, place): the ``top`` items of each user by inner product, out of all.
    Both sides: ``id``, ``features``.

    An inner product is at most the product of the lengths.  Every user gets a bound from the
    longest items, and so the length an item must have; blocks of users with like needs meet the
    blocks of items that are long enough.  What is left out cannot be among the best."""
    length = F.sqrt(F.aggregate("features", F.lit(0.0), lambda a, x: a + x.cast("double") * x))
    items = items.select(F.col("id").alias("item"), "features", (-length).alias("less"))
    longest = items.orderBy("less", "item").limit(FIRST).select("features").collect()
    longest = np.array([r.features for r in longest], np.float32)
    users = users.select(F.col("id").alias("user"), "features").mapInArrow(
        _bounds(longest, top), "user int, features array<float>, least double, need double"
    )
    packed_items = _blocks(
        items, ["less", "item"], block,
        [F.max(-F.col("less")).alias("longest"), *_listed(["less", "item"], {"item": "items", "features": "item_rows"})],
        "item_block",
    )
    packed_users = _blocks(
        cut_lineage(users), ["need", "user"], block,
        [F.min("need").alias("needed"), *_listed(["need", "user"], {"user": "users", "features": "user_rows", "least": "least"})],
        "user_block",
    )
    # a row per block on both sides, without what the blocks hold
    pairs = packed_users.select("user_block", "needed").join(
        packed_items.select("item_block", "longest"), F.expr("longest * (1 + 1e-5) >= needed")
    )
    met = pairs.select("user_block", "item_block").join(packed_users, "user_block").join(packed_items, "item_block")
    met = met.repartition(F.col("user_block"), F.col("item_block")).groupBy("user_block", "item_block")
    found = met.applyInArrow(_best(top), "user int, item int, score float")
    ranked = Window.partitionBy("user").orderBy(F.desc("score"), "item")
    return found.withColumn("place", F.row_number().over(ranked)).filter(F.col("place") <= top)
