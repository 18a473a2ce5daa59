"""Frequent item sets, association rules and sequential patterns."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.operators.asof import asof_join
from marketlake.operators.ordered import POS, number_rows
from marketlake.session import cut_lineage


def frequent_items(rows: DataFrame, min_support: float) -> tuple[DataFrame, int, int]:
    """(basket, item) pairs of items that are frequent alone, the number of
    baskets, and the count an item set has to reach."""
    pairs = rows.select("basket", "item").distinct()
    baskets = rows.agg(F.count_distinct("basket")).first()[0]
    least = max(1, math.ceil(min_support * baskets))
    often = pairs.groupBy("item").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= least)
    return pairs.join(often.select("item"), "item", "left_semi"), baskets, least


def frequent_sets(
    rows: DataFrame, min_support: float, min_confidence: float = 0.1
) -> tuple[DataFrame, DataFrame]:
    """Item sets (items, freq) and rules (antecedent, consequent, confidence) of
    ``rows`` (basket, item).

    Rare items leave before baskets are formed, so a basket holds at most the
    frequent items: no more than rows / (support * baskets) of them.  Equal baskets
    become one row with a count.  Sets grow by one later item of the basket; baskets that
    hold a set and agree in what may follow are one row again."""
    # support and baskets both read the rows: join and scan them once
    pairs, _, least = frequent_items(cut_lineage(rows.select("basket", "item")), min_support)
    baskets = pairs.groupBy("basket").agg(F.array_sort(F.collect_set("item")).alias("rest"))
    none = F.array().cast(baskets.schema["rest"].dataType)
    state = baskets.groupBy("rest").agg(F.count(F.lit(1)).alias("n")).withColumn("items", none)
    found = []
    while True:
        grown = state.select("items", "rest", "n", F.posexplode("rest").alias("at", "item")).select(
            F.concat("items", F.array("item")).alias("items"),
            F.slice("rest", F.col("at") + 2, F.size("rest")).alias("rest"),
            "n",
        )
        grown = cut_lineage(grown.groupBy("items", "rest").agg(F.sum("n").alias("n")))
        often = grown.groupBy("items").agg(F.sum("n").alias("freq")).filter(F.col("freq") >= least)
        often = cut_lineage(often)
        found.append(often)
        if often.isEmpty():
            break
        state = grown.filter(F.size("rest") > 0).join(often.select("items"), "items", "left_semi")
    sets = found[0]
    for more in found[1:]:
        sets = sets.union(more)
    wholes = sets.filter(F.size("items") > 1).select("items", "freq", F.explode("items").alias("item"))
    rules = wholes.select(
        F.array_remove("items", F.col("item")).alias("antecedent"),
        F.array("item").alias("consequent"),
        F.col("freq").alias("both"),
    ).join(sets.withColumnRenamed("items", "antecedent"), "antecedent")
    rules = rules.select("antecedent", "consequent", (F.col("both") / F.col("freq")).alias("confidence"))
    return sets, rules.filter(F.col("confidence") >= min_confidence)


# Sequences of at most so many items are handled as lists, longer ones item by item.
LISTED = 100


def sequential_patterns(
    events: DataFrame, min_support: float, max_length: int | None = None, listed: int = LISTED
) -> DataFrame:
    """(pattern, length, freq): item sequences that appear, in order and with gaps,
    in at least ``min_support`` of the sequences.  ``events``: ``who``, ``item`` and
    the order columns ``ts``, ``event_id``.  Null is no item.

    Patterns of any length are found, unless ``max_length`` asks for short ones only.

    A sequence holds a pattern when, matched from the left, every item has a next
    place; only that earliest place is kept.  Sequences of at most ``listed`` items are
    lists: equal lists become one row with a count, and so do those that hold a pattern
    and agree in what follows it.  In longer ones patterns grow by one item through a
    forward as-of join on (who, item), so no long sequence is ever collected."""
    rows = events.filter("who IS NOT NULL").select("who", "item", "ts", "event_id")
    lengths = rows.groupBy("who").agg(F.count(F.lit(1)).alias("n"))
    people, longest = lengths.agg(F.count(F.lit(1)), F.max("n")).first()
    least = max(1, math.ceil(min_support * people))
    rows = rows.filter("item IS NOT NULL")
    lists, places = rows, None
    if (longest or 0) > listed:
        busy = cut_lineage(lengths.filter(F.col("n") > listed).select("who"))
        lists = rows.join(busy, "who", "left_anti")
        numbered = number_rows(rows.join(busy, "who", "left_semi"), ["who"], ["ts", "event_id"])
        places = cut_lineage(numbered.rows.select("who", "item", F.col(POS).alias("place")))
    lists = _counted_lists(lists)

    def often(short: DataFrame, long: DataFrame | None) -> DataFrame:
        held = short.select("pattern", "n")
        if long is not None:
            held = held.union(long.select("pattern", F.lit(1).cast("long")))
        freq = held.groupBy("pattern").agg(F.sum("n").alias("freq"))
        return cut_lineage(freq.filter(F.col("freq") >= least))

    def supported(state: DataFrame) -> DataFrame:
        return state.join(found[-1].select("pattern"), "pattern", "left_semi")

    short = lists.select(F.explode(F.array_distinct("rest")).alias("item"), "n")
    long = None if places is None else places.groupBy("who", "item").agg(F.min("place").alias("place"))
    one = F.array("item").alias("pattern")
    found = [often(short.select(one, "n"), None if long is None else long.select(one))]
    items = found[0].select(F.col("pattern")[0].alias("item"))
    none = F.array().cast(found[0].schema["pattern"].dataType).alias("pattern")
    short = _grown_lists(_only_items(lists, items).select(none, "rest", "n"))
    if long is not None:
        places = places.join(items, "item", "left_semi")
        long = cut_lineage(long.join(items, "item", "left_semi"))
        pairs = long.select("who", "item")
        long = long.select("who", one, "place")
    while max_length is None or len(found) < max_length:
        short = cut_lineage(_grown_lists(supported(short)))
        if long is not None:
            long = cut_lineage(_grown_places(supported(long), pairs, places))
        more = often(short, long)
        if more.isEmpty():
            break
        found.append(more)
    result = found[0]
    for more in found[1:]:
        result = result.union(more)
    return result.select("pattern", F.size("pattern").alias("length"), "freq")


def _counted_lists(rows: DataFrame) -> DataFrame:
    """(rest, n): the items of each ``who`` in order, and how many have the same."""
    entries = F.array_sort(F.collect_list(F.struct("ts", "event_id", "item")))
    lists = rows.groupBy("who").agg(entries.getField("item").alias("rest"))
    return cut_lineage(lists.groupBy("rest").agg(F.count(F.lit(1)).alias("n")))


def _only_items(lists: DataFrame, items: DataFrame) -> DataFrame:
    """The counted lists without other items."""
    single = lists.withColumn("_list", F.monotonically_increasing_id()).select(
        "_list", "n", F.posexplode("rest").alias("at", "item")
    )
    entries = F.array_sort(F.collect_list(F.struct("at", "item")))
    kept = single.join(items, "item", "left_semi").groupBy("_list", "n").agg(entries.alias("kept"))
    return kept.groupBy(F.col("kept.item").alias("rest")).agg(F.sum("n").alias("n"))


def _grown_lists(state: DataFrame) -> DataFrame:
    """(pattern, rest, n) with every pattern longer by each item that follows it, and what
    follows that item's first place."""
    tries = state.select("pattern", "rest", "n", F.explode(F.array_distinct("rest")).alias("item"))
    after = F.array_position("rest", F.col("item")).cast("int") + 1
    grown = tries.select(
        F.concat("pattern", F.array("item")).alias("pattern"),
        F.slice("rest", after, F.size("rest")).alias("rest"),
        "n",
    )
    return grown.groupBy("pattern", "rest").agg(F.sum("n").alias("n"))


def _grown_places(state: DataFrame, items: DataFrame, places: DataFrame) -> DataFrame:
    """(who, pattern, place) with every pattern longer by each item of ``who`` that has a later
    place: the earliest."""
    matched = asof_join(
        state.select("who", "pattern", "place").join(items, "who"),
        places,
        on="place",
        keys=["who", "item"],
        left_tie=F.xxhash64("pattern"),
        right_tie=F.lit(0),
        direction="forward",
        exact=False,
    ).filter("right_place IS NOT NULL")
    return matched.select(
        "who", F.concat("pattern", F.array("item")).alias("pattern"), F.col("right_place").alias("place")
    )
