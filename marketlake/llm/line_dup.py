"""Line deduplication: a suffix array over the sequence of line ids, by distributed prefix
doubling; intervals of common prefixes show the maximal repeated runs of lines, and later
copies are deleted.

All documents' lines stand one after the other in one sequence, in the order of doc_id,
with a free place after each document.  Lines that occur once end every run and take no
part.  ``suffix_runs`` ranks the suffixes, measures the prefixes they share with their
neighbours and gives the longest run from each line that stands at an earlier place without
overlap.  Such a run of at least MIN_WORDS words is a later copy and its lines go, so
exactly the lines inside repeated runs of MIN_WORDS words or more are deleted, but for the
first occurrence.

Defined cases: a null text has no lines and stays null; a blank text is one line without
words and stays; lines are compared byte by byte; rows that repeat both doc_id and text are
one document and share their fate; documents without id come last; other columns stay as
they are; no documents give no rows."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.llm import suffix_runs
from marketlake.llm.common import keep
from marketlake.operators.ordered import number_rows, running_totals

MIN_WORDS = 8
_SIGN = 1 << 63


def _long(x: int) -> int:
    """An unsigned 64-bit number as the signed one with the same bits."""
    return x - 2 * _SIGN if x >= _SIGN else x


def _ahead(words: np.ndarray, least: int) -> np.ndarray:
    """For each line, the lines of the shortest run from it that has ``least`` words; 0
    where there is none."""
    upto = np.concatenate([[0], np.cumsum(words)])
    end = np.searchsorted(upto, upto[:-1] + least)
    return np.where(end <= len(words), end - np.arange(len(words)), 0)


def _lines_of(least: int):
    names = ["doc_id", "text_hash", "line", "n_lines", "id1", "id2", "ahead"]

    def lines(batches):
        for batch in batches:
            rows: list[list] = [[] for _ in range(5)]
            doc = []
            for i, text in enumerate(batch.column(2).to_pylist()):
                if text is None:
                    continue
                parts = text.encode().split(b"\n")
                words = np.fromiter((len(p.split()) for p in parts), np.int64, len(parts))
                digests = [xxhash.xxh3_128_intdigest(p) for p in parts]
                doc += [i] * len(parts)
                rows[0] += range(len(parts))
                rows[1] += [len(parts)] * len(parts)
                rows[2] += [_long(d >> 64) for d in digests]
                rows[3] += [_long(d & (2 * _SIGN - 1)) for d in digests]
                rows[4] += _ahead(words, least).tolist()
            at = pa.array(doc, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(at),
                    batch.column(1).take(at),
                    *(pa.array(r, pa.int64()) for r in rows),
                ],
                names=names,
            )

    return lines, ", ".join(f"{n} long" for n in names)


def _identified(docs: DataFrame) -> DataFrame:
    return docs.withColumn("_doc", F.col("doc_id").cast("long")).withColumn(
        "_text_hash", F.xxhash64("text")
    )


def _positions(lines: DataFrame) -> DataFrame:
    """doc_id, text_hash, first: the place of each document's first line, with one place
    left free after each document."""
    documents = (
        lines.filter("line = 0")
        .select("doc_id", "text_hash", "n_lines", F.col("doc_id").isNull().alias("_last"))
        .distinct()
        .withColumn("places", F.col("n_lines") + 1)
    )
    numbered = number_rows(documents, [], ["_last", "doc_id", "text_hash"])
    return running_totals(numbered, ["places"]).select(
        "doc_id", "text_hash", (F.col("cum_places") - F.col("places")).alias("first")
    )


def repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """(doc_id, text_hash, line, ahead, first, p, id1, id2): lines that occur more than once,
    with their places in the sequence of all lines."""
    split, schema = _lines_of(min_words)
    lines = keep(
        _identified(docs).select("_doc", "_text_hash", "text").mapInArrow(split, schema), "lines"
    )
    shared = lines.groupBy("id1", "id2").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    again = lines.join(shared.drop("n"), ["id1", "id2"]).alias("l")
    firsts = _positions(lines).alias("f")
    return keep(
        again.join(
            firsts,
            F.col("l.doc_id").eqNullSafe(F.col("f.doc_id"))
            & (F.col("l.text_hash") == F.col("f.text_hash")),
        )
        .select("l.*", "first", (F.col("first") + F.col("line")).alias("p"))
        .drop("n_lines")
        .distinct(),
        "repeated-lines",
    )


def maximal_copies(lines: DataFrame, size: int = suffix_runs.CHUNK) -> DataFrame:
    """(doc_id, text_hash, line, n): runs of lines with enough words that stand at an earlier
    place without overlap, and that no such run a line longer holds."""
    order, rounds = suffix_runs.suffix_order(lines.select("p", "first", "id1", "id2"))
    if not rounds:
        return lines.select("doc_id", "text_hash", "line", F.lit(0).cast("long").alias("n")).limit(0)
    copies = suffix_runs.earlier_copies(suffix_runs.common_prefixes(order, rounds), size)
    in_text = Window.partitionBy("first").orderBy("p")
    held = (F.lag("p").over(in_text) == F.col("p") - 1) & (
        F.lag("n").over(in_text) == F.col("n") + 1
    )
    return (
        copies.join(lines.drop("id1", "id2"), "p")
        .filter("ahead > 0 AND n >= ahead")
        .withColumn("held", F.coalesce(held, F.lit(False)))
        .filter("NOT held")
        .select("doc_id", "text_hash", "line", "n")
    )


def repeated_runs(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """doc_id, text_hash, runs: (line, n) of each document's later copies."""
    return (
        maximal_copies(repeated_lines(docs, min_words))
        .groupBy("doc_id", "text_hash")
        .agg(F.collect_list(F.struct("line", "n")).alias("runs"))
    )


def _without(at: int, runs_at: int, names: list[str]):
    def strip(batches):
        for batch in batches:
            texts, removed, lines = [], [], []
            for text, runs in zip(batch.column(at).to_pylist(), batch.column(runs_at).to_pylist()):
                parts = text.split("\n") if text is not None else []
                gone = np.zeros(len(parts) + 1, np.int64)
                for run in runs or ():
                    gone[run["line"]] += 1
                    gone[run["line"] + run["n"]] -= 1
                gone = np.cumsum(gone[:-1]) > 0
                if gone.any():
                    text = "\n".join(p for p, g in zip(parts, gone) if not g)
                texts.append(text)
                removed.append(int(gone.sum()))
                lines.append(len(parts))
            columns = list(batch.columns[:runs_at])
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(lines, pa.int64()), pa.array(removed, pa.int64())],
                names=names,
            )

    return strip


def _stripped(docs: DataFrame, min_words: int) -> tuple[DataFrame, dict[str, str]]:
    """Documents without later copies, with _n_lines and _n_removed, under inner names for
    their other columns; and the way back to their own."""
    own = {c: f"_own_{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
    docs = docs.withColumnsRenamed(own)
    runs = repeated_runs(docs, min_words).alias("r")
    joined = (
        _identified(docs)
        .alias("d")
        .join(
            runs,
            F.col("d._doc").eqNullSafe(F.col("r.doc_id"))
            & (F.col("d._text_hash") == F.col("r.text_hash")),
            "left",
        )
        .select(*[F.col(f"d.`{c}`") for c in docs.columns], "r.runs")
    )
    names = [*docs.columns, "_n_lines", "_n_removed"]
    schema = T.StructType(
        [
            *docs.schema.fields,
            T.StructField("_n_lines", T.LongType()),
            T.StructField("_n_removed", T.LongType()),
        ]
    )
    rows = joined.mapInArrow(
        _without(docs.columns.index("text"), len(docs.columns), names), schema
    )
    return rows, {v: k for k, v in own.items()}


def without_repeated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Documents with later copies of repeated line runs deleted; adds _n_lines and
    _n_removed, in place of columns of these names."""
    rows, back = _stripped(docs.drop("_n_lines", "_n_removed"), min_words)
    return rows.withColumnsRenamed(back)


def deduplicated_lines(docs: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Documents without later copies; those of which nothing is left are dropped."""
    rows, back = _stripped(docs, min_words)
    left = rows.filter("_n_removed = 0 OR _n_removed < _n_lines").drop("_n_lines", "_n_removed")
    return left.withColumnsRenamed(back)
