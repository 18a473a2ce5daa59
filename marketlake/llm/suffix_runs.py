"""Suffix array, longest common prefixes and earlier copies over a long sequence of ids
that is cut into documents.

Input: rows (p, first, id1, id2), p the place of an item in the sequence, first that of its
document's first item, the ids naming the item.  Documents are at least one place apart.
Only items that occur more than once need to be given; a place without a row is an item
like no other, so no common prefix reaches past the end of a document.

``suffix_order`` ranks suffixes by prefix doubling: rows are sorted by (rank, rank of the
suffix 2^k places on) and a class of equals has the rank of its first row; suffixes alone in
their class are done.  The order among different items is that of their ids.

``common_prefixes`` takes each suffix's prefix shared with its predecessor in that order.
Where the predecessors of p - 1 and p follow one another, the prefix is one shorter than at
p - 1; the others are found by halving steps through the classes of the rounds.

``earlier_copies`` reads the intervals of the prefixes: the suffixes around a rank between
which all common prefixes have n items or more are those that agree for n items.  The longest
run from p that also starts at e <= p - n, for e the smallest place of such an interval, is
found by bisection over n.  Ranks are worked on in chunks; one row per chunk, the steps of the
intervals open at its borders, goes through a single ordered pass."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.common import keep
from marketlake.operators.ordered import POS, number_rows

# Ranks in a chunk: two tables of 17 x 65,536 numbers.
CHUNK = 1 << 16
_FAR = 1 << 62
_ALONE = -1


def suffix_order(items: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(p, first, c, r): rank r of each suffix, from 0, and class c of its first item; and
    for each round k the classes (p, r) of the first 2^k items that have several members."""
    numbered = number_rows(items, [], ["id1", "id2", "p"]).rows
    named = numbered.groupBy("id1", "id2").agg(
        F.min(POS).alias("r"), F.count(F.lit(1)).alias("n")
    )
    ranks = keep(
        numbered.join(named, ["id1", "id2"]).select("p", "first", F.col("r").alias("c"), "r", "n"),
        "ranks",
    )
    rounds: list[DataFrame] = []
    while True:
        several = ranks.filter("n > 1")
        if several.isEmpty():
            return ranks.drop("n"), rounds
        ahead = 1 << len(rounds)
        rounds.append(several.select("p", "r"))
        pairs = several.drop("n").join(
            ranks.select((F.col("p") - ahead).alias("p"), F.col("r").alias("d")), "p", "left"
        )
        rows = number_rows(
            pairs.withColumn("d", F.coalesce("d", F.lit(_ALONE))), [], ["r", "d", "p"]
        ).rows
        parts = rows.groupBy("r", "d").agg(
            F.min(POS).alias("part"), F.count(F.lit(1)).alias("n")
        )
        whole = parts.groupBy("r").agg(F.min("part").alias("whole"))
        alone = F.col("d") == _ALONE
        parted = rows.join(parts.join(whole, "r"), ["r", "d"]).select(
            "p",
            "first",
            "c",
            (F.col("r") + F.when(alone, F.col(POS)).otherwise(F.col("part")) - F.col("whole"))
            .alias("r"),
            F.when(alone, F.lit(1).cast("long")).otherwise(F.col("n")).alias("n"),
        )
        ranks = keep(ranks.filter("n = 1").unionByName(parted), "ranks")


def common_prefixes(ranks: DataFrame, rounds: list[DataFrame]) -> DataFrame:
    """(p, r, shared): items that the suffix of rank r shares with that of rank r - 1."""
    before = ranks.select(
        (F.col("r") + 1).alias("r"), F.col("p").alias("q"), F.col("c").alias("c_before")
    )
    in_text = Window.partitionBy("first").orderBy("p")
    follows = (F.lag("p").over(in_text) == F.col("p") - 1) & (
        F.lag("q").over(in_text) == F.col("q") - 1
    )
    rows = keep(
        ranks.join(before, "r", "left")
        .withColumn("q", F.when(F.col("c") == F.col("c_before"), F.col("q")))
        .withColumn("head", F.col("q").isNotNull() & ~F.coalesce(follows, F.lit(False)))
        .select("p", "first", "r", "q", "head"),
        "neighbours",
    )
    heads = rows.filter("head").select("p", "q", F.lit(0).cast("long").alias("shared"))
    for k in reversed(range(len(rounds))):
        here = rounds[k].select(F.col("p").alias("at"), F.col("r").alias("x"))
        there = rounds[k].select(F.col("p").alias("at_q"), F.col("r").alias("y"))
        heads = (
            heads.join(here, F.col("p") + F.col("shared") == F.col("at"), "left")
            .join(there, F.col("q") + F.col("shared") == F.col("at_q"), "left")
            .select(
                "p",
                "q",
                (F.col("shared") + F.when(F.col("x") == F.col("y"), 1 << k).otherwise(0))
                .alias("shared"),
            )
        )
        if k % 4 == 0:
            heads = keep(heads, "head-prefixes")
    begun = rows.join(
        heads.select("p", F.struct(F.col("p").alias("at"), "shared").alias("begun")), "p", "left"
    )
    last = F.last("begun", ignorenulls=True).over(in_text)
    return begun.withColumn("last", last).select(
        "p",
        "r",
        F.when(
            F.col("q").isNotNull(), F.col("last.shared") - (F.col("p") - F.col("last.at"))
        )
        .otherwise(0)
        .cast("long")
        .alias("shared"),
    )


# --- intervals ------------------------------------------------------------------


def _steps(depth: np.ndarray, least: np.ndarray) -> tuple[list[int], list[int]]:
    """Depths that fall along a walk, as rising steps: each distinct depth with the smallest
    place when the walk has gone as far as that depth holds."""
    real = depth > 0
    depth, least = depth[real], least[real]
    ends = np.flatnonzero(np.diff(depth, append=-1)) if len(depth) else np.array([], int)
    return depth[ends][::-1].tolist(), least[ends][::-1].tolist()


def _borders(rows: pd.DataFrame) -> pd.DataFrame:
    """One row: the chunk's steps as seen from its right border and from its left."""
    rows = rows.sort_values("r")
    p, shared = rows["p"].to_numpy(), rows["shared"].to_numpy()
    # from the right: the last row is reached at any depth
    back = np.minimum.accumulate(np.concatenate([[_FAR], shared[:0:-1]]))
    tail = _steps(back, np.minimum.accumulate(p[::-1]))
    head = _steps(np.minimum.accumulate(shared), np.minimum.accumulate(p))
    return pd.DataFrame(
        {
            "chunk": [rows["chunk"].iloc[0]],
            "tail_depth": [tail[0]], "tail_least": [tail[1]],
            "head_depth": [head[0]], "head_least": [head[1]],
            "through": [int(shared.min())],
            "least": [int(p.min())],
        }
    )


def _beyond(depths, leasts, through: int, least: int, outer) -> tuple[list[int], list[int]]:
    """Steps from a border through a chunk and, to depth ``through``, on to what lies beyond."""
    far_depths, far_leasts = outer
    found: dict[int, int] = {}
    for n, e in zip(far_depths, far_leasts):
        if n <= through:
            found[n] = min(e, least)
    if through > 0:
        place = int(np.searchsorted(far_depths, through))
        far = far_leasts[place] if place < len(far_leasts) else _FAR
        found[through] = min(far, least)
    for n, e in zip(depths, leasts):
        if n > through:
            found[n] = int(e)
    steps = sorted(found.items())
    return [int(n) for n, _ in steps], [int(e) for _, e in steps]


def _carried(rows: pd.DataFrame) -> pd.DataFrame:
    """For each chunk the steps left of it and right of it."""
    rows = rows.sort_values("chunk").reset_index(drop=True)
    left, right = [], [None] * len(rows)
    open_steps = ([], [])
    for row in rows.itertuples():
        left.append(open_steps)
        open_steps = _beyond(row.tail_depth, row.tail_least, row.through, row.least, open_steps)
    open_steps = ([], [])
    for row in rows.iloc[::-1].itertuples():
        right[row.Index] = open_steps
        open_steps = _beyond(row.head_depth, row.head_least, row.through, row.least, open_steps)
    return pd.DataFrame(
        {
            "chunk": rows["chunk"],
            "left_depth": [s[0] for s in left], "left_least": [s[1] for s in left],
            "right_depth": [s[0] for s in right], "right_least": [s[1] for s in right],
        }
    )


def _minima(values: np.ndarray) -> list[np.ndarray]:
    """Smallest value of each stretch of 1, 2, 4 ... values, by its first index."""
    found, width = [values], 1
    while 2 * width <= len(values):
        found.append(np.minimum(found[-1][:-width], found[-1][width:]))
        width *= 2
    return found


def _step_at(depths, leasts, n: np.ndarray) -> np.ndarray:
    place = np.searchsorted(np.asarray(depths, np.int64), n)
    return np.append(np.asarray(leasts, np.int64), _FAR)[place]


class _Intervals:
    """Smallest place among the suffixes that share n items with the one at an index."""

    def __init__(self, p: np.ndarray, shared: np.ndarray, left, right):
        # links[i] joins the rows i - 1 and i; the last one leads to the next chunk
        link = max(right[0], default=0)
        self.left, self.right, self.size = left, right, len(p)
        self.links = _minima(np.append(shared, link))
        self.places = _minima(p)

    def least(self, at: np.ndarray, n: np.ndarray) -> np.ndarray:
        lo, hi = at.copy(), at.copy()  # rows lo .. hi are reached
        for k in reversed(range(len(self.links))):
            table, width = self.links[k], 1 << k
            start = lo - width + 1
            go = (start >= 0) & (table[np.maximum(start, 0)] >= n)
            lo = np.where(go, lo - width, lo)
            start = hi + 1
            go = (start < len(table)) & (table[np.minimum(start, len(table) - 1)] >= n)
            hi = np.where(go, hi + width, hi)
        found = np.minimum(
            np.where(lo < 0, _step_at(*self.left, n), _FAR),
            np.where(hi >= self.size, _step_at(*self.right, n), _FAR),
        )
        lo, hi = np.maximum(lo, 0), np.minimum(hi, self.size - 1)
        width = np.frexp(hi - lo + 1)[1] - 1
        for k in np.unique(width):
            some = width == k
            table = self.places[k]
            inner = np.minimum(table[lo[some]], table[hi[some] + 1 - (1 << int(k))])
            found[some] = np.minimum(found[some], inner)
        return found


def _longest(rows: pd.DataFrame, carried: pd.DataFrame) -> pd.DataFrame:
    """(p, n): most items from p that also stand at a place no later than p - n."""
    rows = rows.sort_values("r")
    p, shared = rows["p"].to_numpy(), rows["shared"].to_numpy()
    border = carried.iloc[0]
    left = (list(border["left_depth"]), list(border["left_least"]))
    right = (list(border["right_depth"]), list(border["right_least"]))
    intervals = _Intervals(p, shared, left, right)
    most = np.maximum(shared, intervals.links[0][1:])
    sure = np.zeros(len(p), np.int64)
    open_rows = np.flatnonzero(most > 0)
    while len(open_rows):
        n = (sure[open_rows] + most[open_rows] + 1) // 2
        holds = p[open_rows] - intervals.least(open_rows, n) >= n
        sure[open_rows[holds]] = n[holds]
        most[open_rows[~holds]] = n[~holds] - 1
        open_rows = open_rows[sure[open_rows] < most[open_rows]]
    return pd.DataFrame({"p": p, "n": sure})[sure > 0]


def earlier_copies(prefixes: DataFrame, size: int = CHUNK) -> DataFrame:
    """(p, n): the longest run from p that stands at an earlier place without overlap."""
    rows = keep(prefixes.withColumn("chunk", F.expr(f"r div {size}")), "prefixes")
    longs = "array<long>"
    borders = rows.groupBy("chunk").applyInPandas(
        _borders,
        f"chunk long, tail_depth {longs}, tail_least {longs}, head_depth {longs}, "
        f"head_least {longs}, through long, least long",
    )
    # one row per chunk: a single ordered pass is fine
    carried = keep(
        borders.groupBy(F.lit(0).alias("all"))
        .applyInPandas(
            _carried,
            f"chunk long, left_depth {longs}, left_least {longs}, "
            f"right_depth {longs}, right_least {longs}",
        ),
        "borders",
    )
    return (
        rows.groupBy("chunk")
        .cogroup(carried.groupBy("chunk"))
        .applyInPandas(_longest, "p long, n long")
    )
