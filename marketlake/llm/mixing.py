"""Mixing sources to target weights, native.

Targets come from capped water-filling: a source's share of the budget follows its
weight; sources whose share is above ``most_epochs`` times their size are clamped there
and the excess goes to the others by weight, until no share is above its cap.

Every document is then taken ``floor(target / size of source)`` times whole, and a
seeded part of the documents once more; the document at the end of that part is taken
by the fraction that is missing (its first words), so each source meets its target to
a word or two.  The part is a prefix of the source in the order of a seeded hash.  Its
end is found digit by digit: a histogram of the first four hex digits per source says
in which digit group the end lies, and only that group is looked at more closely, so no
source is sorted or gathered, however large.

Defined cases: a null text has size 0 and is never taken; null is a source of its own,
last in order; a source of size 0 has target 0; documents that share source, id and
size share their hash and are taken alike; no documents give no rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.common import keep, words_of
from marketlake.operators.ordered import POS, number_rows

DIGITS, LEVELS = 4, 3  # hex digits per level, levels
MOST_EPOCHS = 3
WEIGHTS = (1, 2, 3)
_READ = ("doc_id", "source", "text")


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def water_fill(sources: DataFrame, budget: int, most_epochs: int = MOST_EPOCHS) -> DataFrame:
    """Add ``target`` to sources (source, source_size, weight).

    Each round is one aggregate over the sources not clamped yet; the driver holds
    the water level only."""
    cap = F.col("source_size") * most_epochs
    level = 0.0
    while True:
        full = cap <= F.col("weight") * F.lit(level)
        row = sources.agg(
            F.sum(F.when(full, cap).otherwise(F.lit(0))).alias("clamped"),
            F.sum(F.when(~full, F.col("weight")).otherwise(F.lit(0))).alias("open"),
        ).first()
        if not row["open"]:
            break
        higher = (budget - row["clamped"]) / row["open"]
        if higher <= level:
            break
        level = higher
    return sources.withColumn(
        "target", F.least(cap.cast("double"), F.col("weight") * F.lit(level))
    )


def _sized(docs: DataFrame, seed: int) -> DataFrame:
    """Add _size (words) and _hash, the seeded hash as hex digits."""
    named = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    return docs.withColumn("_size", F.size(words_of(F.col("text"))).cast("long")).withColumn(
        "_hash", F.md5(F.concat_ws(":", F.lit(str(seed)), named, F.col("_size").cast("string")))
    )


def document_sizes(docs: DataFrame, seed: int) -> DataFrame:
    return _sized(docs.select("doc_id", "source", "text"), seed).select(
        "doc_id", "source", F.col("_size").alias("size"), "_hash"
    )


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_epochs: int = MOST_EPOCHS
) -> DataFrame:
    """source, source_size, weight, target; sources in code-point order, null last, get
    the weights in turn."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ordered = number_rows(
        totals.withColumn("_none", F.col("source").isNull()), ["_none"], ["source"]
    ).rows
    sources = keep(
        ordered.select(
            "source",
            "source_size",
            F.element_at(
                F.array(*map(F.lit, weights)), (F.col(POS) % len(weights) + 1).cast("int")
            ).alias("weight"),
        ),
        "sources",
    )
    budget = sources.agg(F.sum("source_size")).first()[0] or 0
    return keep(water_fill(sources, budget, most_epochs), "targets")


def _ends(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """source, _end, _share: documents whose hash digits come before ``_end`` are taken
    once more, those that have these digits by ``_share``."""
    ends = targets.select(
        "source",
        (F.col("target") - F.floor(F.col("target") / F.col("source_size")) * F.col("source_size"))
        .alias("_need"),
        F.lit("").alias("_end"),
    ).filter("source_size > 0 AND _need > 0")
    for level in range(1, LEVELS + 1):
        at = level * DIGITS
        end = ends.alias("e")
        inside = sizes.alias("s").join(
            end,
            _same(F.col("s.source"), F.col("e.source"))
            & (F.substring("s._hash", 1, at - DIGITS) == F.col("e._end")),
        )
        grouped = inside.groupBy(
            F.col("s.source").alias("source"),
            F.substring("s._hash", 1, at).alias("_prefix"),
            F.col("e._need").alias("_need"),
        ).agg(F.sum("size").alias("_n"))
        # at most 16^DIGITS rows per source
        upto = Window.partitionBy("source").orderBy("_prefix")
        running = grouped.withColumn("_upto", F.sum("_n").over(upto))
        # the first group that reaches the need holds the end
        ends = keep(
            running.filter("_upto >= _need AND _upto - _n < _need").select(
                "source",
                (F.col("_need") - F.col("_upto") + F.col("_n")).alias("_need"),
                F.col("_prefix").alias("_end"),
            ),
            "mix-ends",
        )
    # mostly one document, or some that share all digits
    last = (
        sizes.alias("s")
        .join(
            ends.alias("e"),
            _same(F.col("s.source"), F.col("e.source"))
            & (F.substring("s._hash", 1, LEVELS * DIGITS) == F.col("e._end")),
        )
        .groupBy(F.col("e.source").alias("source"), "_end", "_need")
        .agg(F.sum("size").alias("_n"))
    )
    return last.select("source", "_end", (F.col("_need") / F.col("_n")).alias("_share"))


def plan_mix(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most_epochs: int = MOST_EPOCHS
) -> DataFrame:
    """One row per source: source, source_size, target, _end, _share."""
    targets = source_targets(sizes, weights, most_epochs)
    ends = _ends(sizes, targets)
    end = F.coalesce("_end", F.lit("")).alias("_end")
    return keep(
        targets.alias("t")
        .join(ends.alias("e"), _same(F.col("t.source"), F.col("e.source")), "left")
        .select("t.source", "source_size", "target", end, "_share"),
        "mix-plan",
    )


def _decided(rows: DataFrame, plan: DataFrame, size: str) -> DataFrame:
    """Join rows (source, _hash, a size) with the plan and add ``_times``, how often the
    mix takes a document whole, and ``_part``, the words it takes besides."""
    epochs = F.when(
        F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))
    ).otherwise(F.lit(0))
    digits = F.substring("_hash", 1, LEVELS * DIGITS)
    part = F.when(digits == F.col("_end"), F.floor(F.col(size) * F.col("_share")))
    named = plan.withColumnRenamed("source", "_source")
    return (
        rows.join(named, _same(F.col("source"), F.col("_source")))
        .withColumn("_times", (epochs + (digits < F.col("_end")).cast("long")).cast("long"))
        .withColumn("_part", F.coalesce(part, F.lit(0)).cast("long"))
    )


def mix(docs: DataFrame, seed: int = 1, **settings) -> DataFrame:
    """doc_id, size, source_size, target, taken for every document, with ``times``, how
    often it is taken whole, and ``part``, the words taken besides."""
    sizes = keep(document_sizes(docs, seed), "mix-sizes")
    return _decided(sizes, plan_mix(sizes, **settings), "size").select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("_times") + F.col("_part")).alias("taken"),
        F.col("_times").alias("times"),
        F.col("_part").alias("part"),
    )


def mixed_documents(docs: DataFrame, seed: int = 1, **settings) -> DataFrame:
    """The documents as the mix takes them: a row for each whole repetition, and one
    with the first words of the text for a fraction.  Columns stay as they are."""
    plan = plan_mix(keep(document_sizes(docs, seed), "mix-sizes"), **settings)
    inner = {c: f"_own_{i}" for i, c in enumerate(docs.columns) if c not in _READ}
    rows = _decided(_sized(docs.withColumnsRenamed(inner), seed), plan, "_size")
    cut = F.array_join(F.slice(words_of(F.col("text")), 1, F.col("_part").cast("int")), " ")
    copies = F.concat(
        F.array_repeat("text", F.col("_times").cast("int")),
        F.when(F.col("_part") > 0, F.array(cut)).otherwise(F.array().cast("array<string>")),
    )
    others = [inner.get(c, c) for c in docs.columns if c != "text"]
    return (
        rows.select(*others, F.explode(copies).alias("text"))
        .withColumnsRenamed({v: k for k, v in inner.items()})
        .select(*docs.columns)
    )
