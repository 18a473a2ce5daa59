"""Near-duplicate documents by min-max hashing of word shingles.

A document is its set of distinct five-word shingles (64-bit hashes).  Under each of some
random orders both the smallest and the largest element are kept: two samples for one hash
evaluation, each equal with the chance of the Jaccard similarity.  Bands of samples, minima
and maxima apart, are the keys of the candidate search.  Threshold and bands are a Rule:
with CONTRACT (0.85; 32 bands of 7) a pair at the threshold shares no band with a chance of
(1 - 0.85^7)^32, 4 in a million, with STAGE (0.80; 40 bands of 6) of (1 - 0.8^6)^40, 5 in a
million.

1. Documents with equal sets form a class; its smallest id stands for it.
2. Classes that share a band are joined into clusters, through the smallest class of
   each band (a star, not all pairs).
3. Only the clusters' texts are read again, and each cluster is compared in blocks: pairs
   of blocks go to tasks, a task checks the pairs that share a band on the full sets and
   skips pairs it has already connected, and returns a spanning forest.  A cluster of any
   size is so dealt over many tasks, and no list of pairs is ever made.
4. Connected components of those links.

Defined cases: a null or blank text has an empty set and is linked with nothing; a null
doc_id is linked with nothing; rows that repeat a doc_id with another text count as one
document with the sets of both rows compared (``without_near_duplicates`` judges them apart);
other columns are ignored."""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.llm.common import byte_slices, keep, large_text, split_words
from marketlake.llm.components import Forest, components
from marketlake.operators.ordered import POS, number_rows

SHINGLE = 5
BLOCK = 192  # documents per block of a cluster


@dataclass(frozen=True)
class Rule:
    """Linked when of * intersection >= like * union; an even number of bands."""

    like: int
    of: int
    bands: int
    rows: int


CONTRACT = Rule(85, 100, 32, 7)
STAGE = Rule(80, 100, 40, 6)

_BASE = np.uint64(0x9E3779B97F4A7C15)
_EMPTY = np.zeros(0, np.uint64)


@lru_cache
def _orders(bands: int, rows: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Factors and summands of the random orders, factors of the bands."""
    rng = np.random.default_rng(20_240_501)

    def draw(*shape):
        return rng.integers(0, 1 << 63, shape, dtype=np.uint64)

    two, one = np.uint64(2), np.uint64(1)
    times = draw(bands * rows // 2) * two + one
    return times, draw(bands * rows // 2), draw(bands, rows) * two + one


def _stir(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def shingle_sets(column) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; with fewer words than a shingle has,
    the whole sequence is the one shingle."""
    sets: list[np.ndarray] = []
    for _, texts in byte_slices(large_text(column)):
        entries, places, offsets = split_words(pc.ascii_lower(texts))
        known = np.fromiter(
            (xxhash.xxh3_64_intdigest(w) for w in entries.to_numpy(zero_copy_only=False)),
            np.uint64,
            len(entries),
        )
        words = known[places] if len(places) else _EMPTY
        n = max(0, len(words) - SHINGLE + 1)
        runs = np.zeros(n, np.uint64)
        for k in range(SHINGLE):
            runs = runs * _BASE + words[k : k + n]
        runs = _stir(runs)
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            if b - a >= SHINGLE:
                sets.append(np.unique(runs[a : b - SHINGLE + 1]))
            elif b > a:
                short = xxhash.xxh3_64_intdigest(words[a:b].tobytes(), b - a)
                sets.append(np.array([short], np.uint64))
            else:
                sets.append(_EMPTY)
    return sets


def band_keys(shingles: np.ndarray, rule: Rule = CONTRACT) -> np.ndarray:
    """Keys of the bands of a set that isn't empty."""
    times, plus, mix = _orders(rule.bands, rule.rows)
    low = np.full(len(times), np.iinfo(np.uint64).max, np.uint64)
    high = np.zeros(len(times), np.uint64)
    for a in range(0, len(shingles), 2048):
        values = np.multiply.outer(times, shingles[a : a + 2048]) + plus[:, None]
        np.minimum(low, values.min(axis=1), out=low)
        np.maximum(high, values.max(axis=1), out=high)
    samples = np.concatenate([low, high]).reshape(rule.bands, rule.rows)
    return _stir((_stir(samples) * mix).sum(axis=1, dtype=np.uint64))


def _signatures(rule: Rule, batches):
    for batch in batches:
        sets = shingle_sets(batch.column(1))
        digests = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
        keys = [band_keys(s, rule).view(np.int64) if len(s) else None for s in sets]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array(digests, pa.binary()),
                pa.array(keys, pa.list_(pa.int64())),
            ],
            names=["doc_id", "n_shingles", "digest", "bands"],
        )


def signatures(docs: DataFrame, rule: Rule = CONTRACT) -> DataFrame:
    """doc_id, n_shingles, digest of the set, bands."""
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        partial(_signatures, rule), "doc_id long, n_shingles long, digest binary, bands array<long>"
    )


def _members(rule: Rule, batches):
    for batch in batches:
        sets = shingle_sets(batch.column(2))
        keys = [band_keys(s, rule).view(np.int64) if len(s) else [] for s in sets]
        yield pa.RecordBatch.from_arrays(
            [
                *batch.columns[:2],
                pa.array([s.tobytes() for s in sets], pa.binary()),
                pa.array(keys, pa.list_(pa.int64())),
            ],
            names=["doc_id", "cluster", "shingles", "bands"],
        )


def _alike(x: np.ndarray, y: np.ndarray, rule: Rule) -> bool:
    small, large = sorted((len(x), len(y)))
    if rule.of * small < rule.like * large:
        return False
    both = len(np.intersect1d(x, y, assume_unique=True))
    return rule.of * both >= rule.like * (len(x) + len(y) - both)


def _compare(ids, blocks, sets, bands, one: bool, rule: Rule) -> list[tuple[int, int]]:
    """Spanning links of a pair of blocks (or one block)."""
    order = sorted(range(len(ids)), key=lambda i: (ids[i], len(sets[i])))
    forest, links, failed = Forest(len(ids)), [], set()
    shared: dict[int, list[int]] = {}
    for i in order:
        for key in bands[i]:
            shared.setdefault(key, []).append(i)
    for group in shared.values():
        for k, i in enumerate(group):
            for j in group[:k]:
                if not one and blocks[i] == blocks[j]:
                    continue  # another task compares the pairs inside a block
                if (i, j) in failed or forest.find(i) == forest.find(j):
                    continue
                if _alike(sets[i], sets[j], rule):
                    forest.union(i, j)
                    links.append((ids[i], ids[j]))
                else:
                    failed.add((i, j))
    return links


def _compare_groups(rule: Rule, batches):
    """Groups (cluster, x, y) lie together, in order; a group is held at a time."""
    held, key = [], None

    def links():
        ids, blocks, sets, bands = zip(*held)
        return _compare(
            ids,
            blocks,
            [np.frombuffer(s, np.uint64) for s in sets],
            bands,
            key[1] == key[2],
            rule,
        )

    def batch_of(pairs):
        a, b = zip(*pairs) if pairs else ((), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"]
        )

    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(6)]
        found = []
        for cluster, x, y, doc, block, shingles, bands in zip(
            *columns, batch.column(6).to_pylist()
        ):
            if (cluster, x, y) != key:
                if held:
                    found += links()
                held, key = [], (cluster, x, y)
            held.append((doc, block, shingles, bands))
        yield batch_of(found)
    if held:
        yield batch_of(links())


def block_pairs(members: DataFrame, group: str, size: int) -> DataFrame:
    """Deal the rows of each group into blocks of about ``size`` (column ``block``) and
    repeat them for every pair of blocks (x, y) they belong to.  The copies of a row grow
    with its group's blocks, and each pair of blocks is a bounded piece of work."""
    counts = members.groupBy(group).agg(F.count(F.lit(1)).alias("_rows"))
    blocks = F.ceil(F.col("_rows") / size).cast("int")
    return (
        members.join(counts, group)
        .withColumn("_blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("_blocks")).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
        .withColumn("x", F.least("block", "_other"))
        .withColumn("y", F.greatest("block", "_other"))
        .drop("_rows", "_blocks", "_other")
    )


def links(docs: DataFrame, classes: DataFrame, rule: Rule = CONTRACT) -> DataFrame:
    """Links (a, b) between classes (doc_id, bands), enough to connect what is linked."""
    banded = classes.select("doc_id", F.explode("bands").alias("key"))
    least = (
        banded.groupBy("key")
        .agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .filter("n > 1")
        .drop("n")
    )
    stars = banded.join(least, "key").filter("first < doc_id")
    clusters = components(stars.select(F.col("first").alias("a"), F.col("doc_id").alias("b")))
    members = (
        docs.select(F.col("doc_id").cast("long"), "text")
        .join(clusters.withColumnRenamed("id", "doc_id"), "doc_id")
        .select("doc_id", F.col("component").alias("cluster"), "text")
        .mapInArrow(partial(_members, rule), "doc_id long, cluster long, shingles binary, bands array<long>")
    )
    paired = block_pairs(keep(members, "cluster-sets"), "cluster", BLOCK)
    return (
        paired.repartition("cluster", "x", "y")
        .sortWithinPartitions("cluster", "x", "y", "doc_id")
        .select("cluster", "x", "y", "doc_id", "block", "shingles", "bands")
        .mapInArrow(partial(_compare_groups, rule), "a long, b long")
    )


def near_duplicates(docs: DataFrame, rule: Rule = CONTRACT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of documents."""
    signed = keep(signatures(docs, rule), "signatures")
    full = signed.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = keep(
        full.groupBy("digest").agg(F.min("doc_id").alias("doc_id"), F.first("bands").alias("bands")),
        "classes",
    )
    linked = components(links(docs, classes, rule))
    named = classes.select("digest", "doc_id").join(
        linked.withColumnRenamed("id", "doc_id"), "doc_id", "left"
    )
    named = named.select(
        "digest", F.coalesce("component", "doc_id").alias("component"), F.lit(1).alias("_known")
    )
    return (
        signed.select("doc_id", "n_shingles", "digest")
        .join(named, "digest", "left")
        .withColumn("component_id", F.coalesce("component", "doc_id"))
        .select(
            "doc_id",
            "n_shingles",
            "component_id",
            F.col("component_id").eqNullSafe(F.col("doc_id")).alias("kept"),
        )
    )


def without_near_duplicates(docs: DataFrame, rule: Rule = CONTRACT) -> DataFrame:
    """The documents with one of each group left, the one with the smallest id, all columns as
    they are.

    Rows without an id all stay.  Where ids are repeated, a document is an (id, text) pair: its
    place in the order of ids and texts stands for it, so that unlike texts under one id are
    judged apart.  Of rows that repeat id and text the first in the order of the other columns
    stays."""
    unnamed, docs = docs.filter("doc_id IS NULL"), docs.filter("doc_id IS NOT NULL")
    ids = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    if ids.filter("n > 1").isEmpty():
        kept = near_duplicates(docs, rule).filter("kept").select("doc_id")
        left = docs.join(kept, "doc_id", "left_semi").select(*docs.columns)
        return left.unionByName(unnamed)
    inner = {c: f"_own_{i}" for i, c in enumerate(docs.columns)}
    text = F.col(inner["text"])
    named = docs.withColumnsRenamed(inner).withColumns(
        {
            "_id": F.col(inner["doc_id"]).cast("long"),
            "_hash1": F.xxhash64(text),
            "_hash2": F.xxhash64(F.lit(1), text),
        }
    )
    order = ["_id", "_hash1", "_hash2"]
    places = number_rows(named.select(*order).distinct(), [], order).rows
    same = [F.col(f"d.{c}").eqNullSafe(F.col(f"p.{c}")) for c in order]
    numbered = keep(
        named.alias("d").join(places.alias("p"), same).select("d.*", F.col(f"p.{POS}").alias("_place")),
        "numbered-documents",
    )
    judged = near_duplicates(
        numbered.select(F.col("_place").alias("doc_id"), text.alias("text")), rule
    )
    kept = judged.filter("kept").select(F.col("doc_id").alias("_place"))
    others = [
        F.col(f.name)
        for f in numbered.select(*inner.values()).schema.fields
        if not isinstance(f.dataType, (T.MapType, T.VariantType))
    ]
    # cut to the first row before the shuffle
    first = F.row_number().over(Window.partitionBy("_place").orderBy(*others))
    return (
        numbered.withColumn("_copy", first)
        .filter("_copy = 1")
        .join(kept, "_place", "left_semi")
        .select(*inner.values())
        .withColumnsRenamed({v: k for k, v in inner.items()})
        .unionByName(unnamed)
    )
