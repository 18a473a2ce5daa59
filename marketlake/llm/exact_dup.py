"""Exact deduplication by composable polynomial fingerprints.

A text's UTF-8 bytes are the coefficients of a polynomial, read at four random points modulo
the prime 2^31 - 1.  Blocks of 1,024 bytes are hashed together, as rows of one matrix product
(exact in doubles: 2^8 * 2^31 * 2^10 < 2^53); a hash moves by ``s`` bytes when it is multiplied
by the point to the power s, and moved hashes add up.  So the hash of a text is the sum of the
hashes of its parts wherever these were computed: texts of more than PIECE bytes are written as
rows of pieces, hashed by many tasks, and added up by a plain aggregate.

1. Rows with equal fingerprints and lengths form a class.
2. Every class is compared chunk by chunk.  For each chunk place of a class the smallest and
   the largest content are aggregated, map side first: all members have the same bytes there
   if the two are equal.  No member meets all others, a hot class arrives as one row per map
   task, and a task holds two chunks of a class at a time.
3. A class with differing chunks (a collision) is split at its first such chunk, and compared
   again until nothing differs.
4. Of a class the row with the largest doc_id stays.

Defined cases: a null text counts as empty, empty texts equal each other; of rows that repeat
the largest doc_id and the text, one stays; a row without doc_id stays only where no equal
text has one; other columns are ignored (or, in ``without_exact_duplicates``, kept); no
documents give no rows."""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.llm.common import keep

PRIME = (1 << 31) - 1
POINTS = 4
BLOCK = 1024
PIECE = 64 << 10  # bytes; longer texts are hashed and compared in pieces
_BYTES_AT_ONCE = 1 << 20
KEY = ["fp1", "fp2", "n_bytes", "split"]


def _multiply(a, b):
    return a * b % PRIME


@lru_cache
def _points() -> np.ndarray:
    return np.random.default_rng(20_240_613).integers(1 << 20, PRIME, POINTS)


def powers(exponents: np.ndarray) -> np.ndarray:
    """(exponents, points): each point to each power, by squaring."""
    out = np.ones((len(exponents), POINTS), np.int64)
    square, rest = _points().copy(), np.asarray(exponents, np.int64)
    while rest.any():
        odd = (rest & 1).astype(bool)
        out[odd] = _multiply(out[odd], square)
        square, rest = _multiply(square, square), rest >> 1
    return out


@lru_cache
def _weights() -> np.ndarray:
    return powers(np.arange(BLOCK)).astype(np.float64)


def hash_blocks(data: np.ndarray) -> np.ndarray:
    """(blocks, points) hashes of zero-padded rows of BLOCK bytes."""
    return (data.astype(np.float64) @ _weights()).astype(np.int64) % PRIME


def hash_pieces(data: np.ndarray, offsets: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(pieces, points): the hashes of pieces of bytes, each moved by its place in its text.
    Any number of bytes; block rows are built about a megabyte at a time."""
    sizes = np.diff(offsets)
    blocks = -(-sizes // BLOCK)
    first = np.concatenate([[0], np.cumsum(blocks)])
    hashes = np.zeros((int(first[-1]), POINTS), np.int64)
    step = _BYTES_AT_ONCE // BLOCK
    owner = np.repeat(np.arange(len(sizes)), blocks)
    inside = (np.arange(len(owner)) - first[owner]) * BLOCK
    for a in range(0, len(owner), step):
        some = slice(a, a + step)
        rows = np.zeros((len(owner[some]), BLOCK), np.uint8)
        at = offsets[owner[some]] + inside[some]
        ends = np.minimum(at + BLOCK, offsets[owner[some] + 1])
        for row, x, y in zip(rows, at.tolist(), ends.tolist()):
            row[: y - x] = data[x:y]
        moved = powers_from(starts[owner[some]] + inside[some])
        hashes[some] = _multiply(hash_blocks(rows), moved)
    out = np.zeros((len(sizes), POINTS), np.int64)
    full = np.flatnonzero(blocks)
    if len(full):
        out[full] = np.add.reduceat(hashes, first[:-1][full], axis=0) % PRIME
    return out


def powers_from(exponents: np.ndarray) -> np.ndarray:
    """``powers``, once per distinct exponent."""
    distinct, place = np.unique(exponents, return_inverse=True)
    return powers(distinct)[place]


def _fingerprints(contents: pa.Array, starts: pa.Array) -> pa.Array:
    contents = contents.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(contents.buffers()[1], np.int64)[
        contents.offset : contents.offset + len(contents) + 1
    ]
    held = contents.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held else np.zeros(0, np.uint8)
    hashes = hash_pieces(data, offsets, starts.to_numpy(zero_copy_only=False))
    return pa.StructArray.from_arrays(
        [pa.array(hashes[:, i]) for i in range(POINTS)], names=[f"h{i}" for i in range(POINTS)]
    )


def _fingerprint(content: Column, start: Column) -> Column:
    kind = "struct<" + ",".join(f"h{i}:long" for i in range(POINTS)) + ">"
    return F.arrow_udf(_fingerprints, kind)(content, start)


def combined(pieces: DataFrame, keys: list[str]) -> DataFrame:
    """Add up hashes (column ``hash``) of the pieces of a text, however they were dealt:
    keys, fp1, fp2.  Sums of numbers below 2^31 stay exact for 2^32 pieces."""
    sums = [F.sum(f"hash.h{i}").alias(f"h{i}") for i in range(POINTS)]
    return pieces.groupBy(*keys).agg(*sums).select(*keys, *_packed([F.col(f"h{i}") for i in range(POINTS)]))


def _packed(hashes: list[Column]) -> list[Column]:
    a, b, c, d = (h % PRIME for h in hashes)
    return [(F.shiftleft(a, 31) + b).alias("fp1"), (F.shiftleft(c, 31) + d).alias("fp2")]


def _contents(docs: DataFrame) -> DataFrame:
    """doc_id, text_sha256, n_bytes, content."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.sha2(text, 256).alias("text_sha256"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        text.alias("content"),
    )


def text_pieces(docs: DataFrame, piece: int = PIECE) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, text_sha256, n_bytes, fp1, fp2, start, content) of the short texts and of
    the pieces of the long ones.  The pieces are a written table, so that each row's number
    holds and tasks share the work on one text."""
    contents = _contents(docs)
    short = contents.filter(F.col("n_bytes") <= piece).withColumn(
        "hash", _fingerprint(F.col("content"), F.lit(0).cast("long"))
    )
    short = short.select(
        "doc_id", "text_sha256", "n_bytes", *_packed([F.col(f"hash.h{i}") for i in range(POINTS)]),
        F.lit(0).cast("long").alias("start"), "content",
    )
    starts = F.sequence(F.lit(0).cast("long"), F.col("n_bytes") - 1, F.lit(piece).cast("long"))
    cut = keep(
        contents.filter(F.col("n_bytes") > piece)
        .withColumn("row", F.monotonically_increasing_id())
        .withColumn("start", F.explode(starts))
        .withColumn(
            "content",
            F.expr(f"substring(content, CAST(start + 1 AS INT), {piece})"),
        ),
        "text-pieces",
    )
    hashed = cut.select("row", _fingerprint(F.col("content"), F.col("start")).alias("hash"))
    long = cut.join(keep(combined(hashed, ["row"]), "long-fingerprints"), "row")
    return short, long.select(*short.columns)


def differing(pieces: DataFrame) -> DataFrame:
    """KEY, start, least of the first chunk place at which a class isn't all the same."""
    places = pieces.groupBy(*KEY, "start").agg(
        F.min("content").alias("least"), F.max("content").alias("greatest")
    )
    # collisions only, so these rows are few
    return (
        places.filter("least <> greatest")
        .groupBy(*KEY)
        .agg(F.min(F.struct("start", "least")).alias("first"))
        .select(*KEY, "first.start", "first.least")
    )


def _split(rows: DataFrame, labels: DataFrame) -> DataFrame:
    return rows.join(labels, [*KEY, "text_sha256"], "left").withColumn(
        "split", F.coalesce("label", "split")
    ).drop("label")


def exact_classes(docs: DataFrame, piece: int = PIECE) -> DataFrame:
    """doc_id, text_sha256, row and the KEY of the class of every document; members of a class
    have been compared."""
    short, long = text_pieces(docs, piece)
    pieces = short.union(long).withColumn("split", F.lit(""))
    signed = keep(
        short.drop("content")
        .union(long.drop("content").filter("start = 0"))
        .withColumn("split", F.lit(""))
        .drop("start")
        .withColumn("row", F.monotonically_increasing_id()),
        "fingerprints",
    )
    while True:
        apart = keep(differing(pieces), "collisions")
        if apart.isEmpty():
            return signed
        content = F.hex(F.xxhash64("content", "split"))
        labels = keep(
            pieces.join(apart, [*KEY, "start"])
            .select(
                *KEY,
                "text_sha256",
                F.concat("split", F.lit("/"), F.when(F.col("content") == F.col("least"), "=").otherwise(content)).alias("label"),
            )
            .distinct(),
            "split-classes",
        )
        signed, pieces = keep(_split(signed, labels), "fingerprints"), _split(pieces, labels)


def exact_duplicates(docs: DataFrame, piece: int = PIECE) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of documents."""
    signed = exact_classes(docs, piece)
    # the largest id, and of rows that repeat it the one numbered last
    classes = signed.groupBy(*KEY).agg(
        F.count(F.lit(1)).alias("group_size"), F.max(F.struct("doc_id", "row")).alias("stays")
    )
    return signed.join(classes, KEY).select(
        "doc_id",
        F.col("stays.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row") == F.col("stays.row")).alias("kept"),
        "text_sha256",
    )


def without_exact_duplicates(docs: DataFrame, piece: int = PIECE) -> DataFrame:
    """The documents that stay, all columns as they are.  Of rows that repeat id and text any
    one stays."""
    stays = exact_duplicates(docs, piece).filter("kept").select("doc_id", "text_sha256")
    inner = {c: f"_own_{i}" for i, c in enumerate(docs.columns)}
    named = docs.withColumnsRenamed(inner)
    digest = F.sha2(F.coalesce(F.col(inner["text"]), F.lit("")).cast("binary"), 256)
    return (
        named.withColumn("_digest", digest)
        .join(
            stays,
            F.col(inner["doc_id"]).cast("long").eqNullSafe(F.col("doc_id"))
            & (F.col("_digest") == F.col("text_sha256")),
            "left_semi",
        )
        .dropDuplicates([inner["doc_id"], "_digest"])
        .drop("_digest")
        .withColumnsRenamed({v: k for k, v in inner.items()})
        .select(*docs.columns)
    )
