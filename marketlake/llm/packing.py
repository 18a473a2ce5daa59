"""Best-fit packing of token pieces into sequences, by bin completion.

Piece lengths lie between 1 and the capacity, so a histogram of them is a bounded
table, however many documents there are.  The plan is made on that histogram; Spark then
gives every piece its rank among the pieces of its length, and the rank tells sequence and
offset.

Two best-fit plans are the incumbents: best fit decreasing (each piece, from the largest on,
into the fullest sequence that takes it), and the greedy completion (around the largest piece
left, the filling with the least waste, as often as the counts allow).  Unless one of them
needs no more than ceil(tokens / capacity) sequences, branch and bound over whole plans
follows: around the largest piece left it enumerates fillings and branches on the undominated
ones, least waste first.  A filling is dominated if its pieces fit into the places of another
filling's pieces, or if one of its pieces can give way to a larger one that is left.  A branch
ends as soon as its sequences have wasted more than a plan with one sequence fewer than the
incumbent may waste in all.

The enumeration is branch and bound over lengths in descending order, on a
stack of (length, times used) that is no deeper than there are lengths; a
branch is dropped when the largest sum that lengths of its kind can reach leaves no
less waste than the worst filling kept.  Budgets bound time, not data: ``nodes`` branches for
a filling, PLAN_NODES for the search over plans; then the incumbent stands."""

from __future__ import annotations

import logging
import zlib
from bisect import bisect_left, bisect_right, insort
from collections import Counter
from collections.abc import Sequence
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.common import keep
from marketlake.llm.tokens import encoded

CAPACITY = 4096
NODES = 3000
PLAN_NODES = 200_000  # branches of all enumerations of the search over plans together
FILLINGS = 4  # undominated fillings branched on
_log = logging.getLogger(__name__)


def best_filling(room: int, lengths: Sequence[int], counts: dict[int, int], nodes: int = NODES):
    """Lengths (largest first, repeats listed) with the largest sum within ``room``,
    of ``lengths`` (descending), each used ``counts`` times at most."""
    return searched_filling(room, lengths, counts, nodes)[0]


def searched_filling(room: int, lengths: Sequence[int], counts: dict[int, int], nodes: int):
    """``best_filling`` and the number of branches visited, above ``nodes`` if cut short."""
    fitting = [n for n in lengths if n <= room and counts[n] > 0]
    if not fitting:
        return [], 0
    smallest = fitting[-1]
    sum_from = [0] * (len(fitting) + 1)
    for i in range(len(fitting) - 1, -1, -1):
        sum_from[i] = min(room, sum_from[i + 1] + fitting[i] * counts[fitting[i]])

    def reach(left: int, i: int) -> int:
        """Bound: waste that no filling by lengths from place i on can undercut."""
        if left < smallest:
            return left
        most = sum_from[i]
        return left - most if most < left else 0

    def place(left: int, start: int) -> int:
        lo, hi = start, len(fitting)
        while lo < hi:
            mid = (lo + hi) // 2
            lo, hi = (lo, mid) if fitting[mid] <= left else (mid + 1, hi)
        return lo

    best, best_waste, seen = [], room, 0
    chosen: list[list[int]] = []  # place of a length and how often it is used
    left, i = room, 0
    while True:
        # as many as fit of each length from place i on
        while (i := place(left, i)) < len(fitting) and reach(left, i) < best_waste:
            uses = min(counts[fitting[i]], left // fitting[i])
            chosen.append([i, uses])
            left -= uses * fitting[i]
            seen += 1
            i += 1
        if left < best_waste:
            best, best_waste = [tuple(x) for x in chosen], left
        if best_waste == 0 or seen > nodes or not chosen:
            break
        # back: the last length once less, and from here on smaller lengths only
        chosen[-1][1] -= 1
        i = chosen[-1][0] + 1
        left += fitting[i - 1]
        if chosen[-1][1] == 0:
            chosen.pop()
    return [fitting[i] for i, uses in best for _ in range(uses)], seen


Patterns = list[tuple[int, int, list[int]]]  # (first sequence, times, lengths)


def _used(patterns: Patterns) -> int:
    return patterns[-1][0] + patterns[-1][1] if patterns else 0


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> Patterns:
    """Each piece, from the largest on, goes into the fullest sequence that takes it.  Equal
    sequences are one group: the pieces of a length fill group after group."""
    groups: dict[int, list[tuple[int, tuple[int, ...]]]] = {}  # room left -> (times, lengths)
    rooms: list[int] = []  # ascending

    def put(room: int, times: int, lengths: tuple[int, ...]) -> None:
        if room not in groups:
            insort(rooms, room)
            groups[room] = []
        groups[room].append((times, lengths))

    for n in sorted(counts, reverse=True):
        left = counts[n]
        while left:
            at = bisect_left(rooms, n)
            room = rooms[at] if at < len(rooms) else capacity
            if at < len(rooms):
                times, lengths = groups[room].pop()
                if not groups[room]:
                    del groups[room], rooms[at]
            else:
                times, lengths = -(-left // (capacity // n)), ()
            per = min(room // n, left)
            full = min(times, left // per)
            put(room - per * n, full, (*lengths, *[n] * per))
            left -= full * per
            times -= full
            if times and left and left < per:
                put(room - left * n, 1, (*lengths, *[n] * left))
                times, left = times - 1, 0
            if times and lengths:
                put(room, times, lengths)
    patterns, first = [], 0
    for room in rooms:
        for times, lengths in groups[room]:
            patterns.append((first, times, list(lengths)))
            first += times
    return patterns


def _times(filling: Sequence[int], counts: dict[int, int]) -> int:
    need = Counter(filling)
    return min(counts[n] // k for n, k in need.items())


def greedy_completion(counts: dict[int, int], capacity: int, nodes: int) -> tuple[Patterns, int]:
    """The best filling around the largest piece left, again and again; and how many of the
    searches were cut short."""
    counts = dict(counts)
    lengths = sorted(counts, reverse=True)
    patterns, first, cut = [], 0, 0
    while lengths:
        top = lengths[0]
        counts[top] -= 1
        rest, seen = searched_filling(capacity - top, lengths, counts, nodes)
        counts[top] += 1
        filling = [top, *rest]
        cut += seen > nodes
        times = _times(filling, counts)
        for n in filling:
            counts[n] -= times
        if any(counts[n] == 0 for n in filling):
            lengths = [n for n in lengths if counts[n]]
        patterns.append((first, times, filling))
        first += times
    return patterns, cut


def dominates(places: Sequence[int], pieces: Sequence[int]) -> bool:
    """Whether the pieces fit into places of these sizes, by best fit (which may miss a way)."""
    rooms = sorted(places)
    for n in sorted(pieces, reverse=True):
        at = bisect_left(rooms, n)
        if at == len(rooms):
            return False
        insort(rooms, rooms.pop(at) - n)
    return True


def undominated(room: int, lengths: Sequence[int], counts: dict[int, int], most_waste: int, nodes: int):
    """Up to FILLINGS undominated fillings of ``room``, least waste first, none with more than
    ``most_waste``; and the branches visited.  ``lengths`` descend."""
    fitting = [n for n in lengths if n <= room and counts[n] > 0]
    ascending = fitting[::-1]
    found: list[tuple[int, list[int]]] = []
    limit, seen = most_waste, 0

    def swaps(filling: list[int], waste: int) -> bool:
        """A piece can give way to a larger one that is left."""
        need = Counter(filling)
        for n in need:
            at = bisect_right(ascending, n + waste) - 1
            while at >= 0 and ascending[at] > n:
                if need[ascending[at]] < counts[ascending[at]]:
                    return True
                at -= 1
        return False

    sums = [0] * (len(fitting) + 1)
    for i in range(len(fitting) - 1, -1, -1):
        sums[i] = min(room, sums[i + 1] + fitting[i] * counts[fitting[i]])
    chosen: list[list[int]] = []
    left, i = room, 0
    while True:
        while i < len(fitting):
            if fitting[i] > left:
                i = len(fitting) - bisect_right(ascending, left)
                continue
            if left - sums[i] > limit:
                break
            uses = min(counts[fitting[i]], left // fitting[i])
            chosen.append([i, uses])
            left -= uses * fitting[i]
            seen += 1
            i += 1
        if left <= limit:
            filling = [fitting[k] for k, uses in chosen for _ in range(uses)]
            if not swaps(filling, left) and not any(dominates(kept, filling) for _, kept in found):
                found = [f for f in found if not dominates(filling, f[1])]
                insort(found, (left, filling))
                if len(found) > FILLINGS:
                    found.pop()
                    limit = found[-1][0]
        if seen > nodes or not chosen:
            return [f for _, f in found], seen
        chosen[-1][1] -= 1
        i = chosen[-1][0] + 1
        left += fitting[i - 1]
        if chosen[-1][1] == 0:
            chosen.pop()


def better_plan(counts: dict[int, int], capacity: int, incumbent: int, nodes: int, budget: int) -> Patterns | None:
    """A plan with fewer sequences than ``incumbent``, if the search finds one in its budget:
    depth first over undominated fillings, bounded by the waste of the sequences together."""
    total = sum(n * c for n, c in counts.items())
    counts = dict(counts)
    trail: list[tuple[list[list[int]], int, int, list[int]]] = []  # other fillings, waste, times, own
    allowed, waste, seen = (incumbent - 1) * capacity - total, 0, 0
    while True:
        lengths = sorted((n for n, c in counts.items() if c), reverse=True)
        if not lengths:
            patterns, first = [], 0
            for _, _, times, filling in trail:
                patterns.append((first, times, filling))
                first += times
            return patterns
        top = lengths[0]
        counts[top] -= 1
        fillings, visited = undominated(
            capacity - top, lengths, counts, allowed - waste, min(nodes, max(0, budget - seen))
        )
        counts[top] += 1
        seen += visited + 1
        options = [[top, *f] for f in fillings]
        while True:
            if options:
                filling, *others = options
                used = sum(filling)
                times = _times(filling, counts)
                if used < capacity:  # no more sequences with this waste than are allowed
                    times = min(times, max(1, (allowed - waste) // (capacity - used)))
                for n in filling:
                    counts[n] -= times
                waste += times * (capacity - used)
                trail.append((others, waste - times * (capacity - used), times, filling))
                if waste <= allowed:
                    break
            if not trail or seen > budget:
                return None
            others, waste, times, filling = trail.pop()
            for n in filling:
                counts[n] += times
            options = others


def plan_sequences(histogram: dict[int, int], capacity: int = CAPACITY, nodes: int = NODES):
    """(patterns, number of sequences); a pattern is (first sequence, times, lengths).

    Zero lengths take no room and are no part of the plan."""
    counts = {n: c for n, c in histogram.items() if n > 0 and c > 0}
    if any(n > capacity for n in counts):
        raise ValueError("a piece is longer than a sequence")
    least = -(-sum(n * c for n, c in counts.items()) // capacity)
    best = best_fit_decreasing(counts, capacity)
    cut = 0
    if _used(best) > least:
        greedy, cut = greedy_completion(counts, capacity, nodes)
        best = min(best, greedy, key=_used)
    while _used(best) > least:
        found = better_plan(counts, capacity, _used(best), nodes, PLAN_NODES)
        if found is None:
            break
        best = found
    _log.info(
        "%d sequences, %d above the least; %d greedy searches cut at %d branches",
        _used(best), _used(best) - least, cut, nodes,
    )
    return best, _used(best)


def _slots(patterns) -> dict[str, np.ndarray]:
    """Lookup of (length, rank): rows sorted by length and first rank.  A row's ranks
    go round its ``per`` places in each of its sequences."""
    rows, used = [], {}
    for first, times, filling in patterns:
        offset = 0
        for n in dict.fromkeys(filling):
            per = filling.count(n)
            rows.append((n, used.get(n, 0), per, first, offset))
            used[n] = used.get(n, 0) + per * times
            offset += n * per
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 5)
    return dict(zip(("length", "rank", "per", "first", "offset"), table.T))


def token_pieces(docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY):
    """doc_id, piece, start, length, ids_crc32: each document's ids and the end id, cut
    into pieces of ``capacity`` where longer.  A null text is empty."""

    def cut(batches):
        for batch in batches:
            doc_ids = batch.column(0)
            for first, ids, offsets in encoded(batch.column(1), tokenizer):
                rows, pieces, starts, lengths, sums = [], [], [], [], []
                ids = np.ascontiguousarray(np.insert(ids, offsets[1:], end_id), "<u4")
                bounds = offsets + np.arange(len(offsets))
                for i, (a, b) in enumerate(zip(bounds[:-1].tolist(), bounds[1:].tolist())):
                    for piece, at in enumerate(range(a, b, capacity)):
                        end = min(b, at + capacity)
                        rows.append(first + i)
                        pieces.append(piece)
                        starts.append(at - a)
                        lengths.append(end - at)
                        sums.append(zlib.crc32(ids[at:end]))
                yield pa.RecordBatch.from_arrays(
                    [
                        doc_ids.take(pa.array(rows, pa.int64())),
                        pa.array(pieces, pa.int32()),
                        *(pa.array(x, pa.int64()) for x in (starts, lengths, sums)),
                    ],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"],
                )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        cut, "doc_id long, piece int, start long, length long, ids_crc32 long"
    )


def _rank_in_length(pieces: DataFrame, total: int) -> DataFrame:
    """Add ``rank``, counted from 0 among the rows of equal length.

    Rows of one length are dealt over about sqrt(total) groups first, so that a length
    that most rows share is ranked in parallel: offset of the group, plus the place in
    it.  Rows that tie in all columns may change places, which changes nothing."""
    groups = max(1, int(total**0.5))
    dealt = pieces.withColumn(
        "_group", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups))
    )
    earlier = (
        Window.partitionBy("length").orderBy("_group").rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        dealt.groupBy("length", "_group")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("length", "_group", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    )
    inside = Window.partitionBy("length", "_group").orderBy("doc_id", "piece", "start", "ids_crc32")
    return (
        dealt.withColumn("_place", F.row_number().over(inside) - 1)
        .join(offsets, ["length", "_group"])
        .withColumn("rank", F.col("_before") + F.col("_place"))
        .drop("_group", "_before", "_place")
    )


def pack(pieces: DataFrame, capacity: int = CAPACITY, nodes: int = NODES) -> DataFrame:
    """Add sequence_id and offset to pieces (doc_id, piece, start, length, ids_crc32).

    Defined cases: null document ids are ranked like any id; repeated rows are packed
    each by itself; no rows give no rows.  The driver sees the histogram of lengths
    (``capacity`` rows at most) and the plan made from it."""
    histogram = {r["length"]: r["n"] for r in _histogram(pieces).collect()}
    patterns, _ = plan_sequences(histogram, capacity, nodes)
    slots = _slots(patterns)
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def place(slots, batches):
        keys = slots["length"] * (1 << 44) + slots["rank"]
        for batch in batches:
            length, rank = (batch.column(i).to_numpy() for i in (3, 5))
            row = np.searchsorted(keys, length * (1 << 44) + rank, side="right") - 1
            turn, slot = np.divmod(rank - slots["rank"][row], slots["per"][row])
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:5],
                    pa.array(slots["first"][row] + turn),
                    pa.array(slots["offset"][row] + slot * length),
                ],
                names=[*columns, "sequence_id", "offset"],
            )

    ranked = _rank_in_length(pieces, sum(histogram.values())).select(*columns, "rank")
    return ranked.mapInArrow(
        partial(place, slots),
        "doc_id long, piece int, start long, length long, ids_crc32 long, "
        "sequence_id long, offset long",
    )


def _histogram(pieces: DataFrame) -> DataFrame:
    return pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n"))


def pack_documents(
    docs: DataFrame, tokenizer: str, end_id: int, capacity: int = CAPACITY, nodes: int = NODES
) -> DataFrame:
    """Tokenise, cut and pack documents; one row per piece."""
    return pack(keep(token_pieces(docs, tokenizer, end_id, capacity), "pieces"), capacity, nodes)
