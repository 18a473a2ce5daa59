"""Quality scores: random-indexing word vectors pooled per document, then a two-layer
network with temperature-calibrated probabilities.

Words are parted into a core and its marks, and each piece falls into one of SLOTS slots by
hash.  A slot's index vector is a few random signs; its word vector is the sum of the index
vectors of the pieces within REACH places of it, over all documents.  Each task sums its
documents into one table of fixed size; the tables are added up pairwise on the executors
(a tree), and one table of SLOTS x DIM numbers is what the driver gets.

A document is the mean and the spread of its pieces' vectors.  The network is fitted on the
driver on at most SAMPLE labelled documents, the ones with the smallest hashes; part of them
only sets the temperature.  Every document is then scored whole.

Defined cases: a null or blank text is the zero vector and gets the network's score for
that; labels that are null, or whose document has none, or that contradict each other, are
averaged over the document's labels; without two classes of labels every score is the share
of good ones (or 0.5); rows that repeat an id are scored each; columns of documents stay as
they are, but for clashing names of the two added ones, which are replaced."""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.llm.common import byte_slices, large_text, split_words, spread

SLOTS, DIM, SIGNS, REACH = 16_384, 32, 4, 2
SAMPLE = 20_000  # labelled documents that the network is fitted on
HIDDEN = 24
CUT = 0.3  # scores from here on count as good
CACHE_WORDS = 200_000  # remembered by a worker, some 150 bytes each

_MARKS = "".join(chr(i) for i in range(33, 127) if not chr(i).isalnum())


def index_vectors(seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of each slot's SIGNS entries."""
    rng = np.random.default_rng(seed)
    return (
        rng.integers(0, DIM, (SLOTS, SIGNS)),
        rng.choice([-1.0, 1.0], (SLOTS, SIGNS)),
    )


class Pieces:
    """Slots of the pieces of texts; a worker remembers the words it has met."""

    def __init__(self):
        self.known: dict[str, int] = {}

    def word(self, word: str) -> int:
        """Slot of the core and, shifted, one plus the slot of the marks; 0 for no piece."""
        found = self.known.get(word)
        if found is None:
            core = word.strip(_MARKS)
            marks = word.replace(core, "", 1) if core else word
            shape = "U" if len(core) > 1 and core.isupper() else ""
            slot = zlib.crc32(core.encode()) % SLOTS + 1 if core else 0
            other = zlib.crc32(b"\0" + (marks[:6] + shape).encode()) % SLOTS + 1
            found = slot | (other << 20 if marks or shape else 0)
            if len(self.known) < CACHE_WORDS:
                self.known[word] = found
        return found

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(slots of all pieces, offsets of the texts' pieces)."""
        entries, places, offsets = split_words(texts)
        words = entries.to_numpy(zero_copy_only=False)
        codes = np.fromiter(map(self.word, words), np.int64, len(words))
        pairs = np.column_stack([codes & 0xFFFFF, codes >> 20])
        counts = (pairs > 0).sum(axis=1)
        flat = pairs[pairs > 0] - 1
        slots = flat[spread(places, np.cumsum(counts) - counts, counts)]
        upto = np.concatenate([[0], np.cumsum(counts[places])]).astype(np.int64)
        return slots, upto[offsets]


_pieces = Pieces()


def _sum_contexts(column, total: np.ndarray) -> None:
    places, signs = index_vectors()
    for _, texts in byte_slices(large_text(column), 2 << 20):
        slots, offsets = _pieces.of(texts)
        owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        for step in range(1, REACH + 1):
            same = owner[step:] == owner[:-step]
            a, b = slots[:-step][same], slots[step:][same]
            for word, context in ((a, b), (b, a)):
                for k in range(SIGNS):
                    total += np.bincount(
                        word * DIM + places[context, k],
                        weights=signs[context, k],
                        minlength=SLOTS * DIM,
                    )


def word_vectors(docs: DataFrame) -> np.ndarray:
    """(SLOTS, DIM) word vectors from the contexts in all documents, of length 1; slots
    never met are zero."""

    def sums(batches):
        total = np.zeros(SLOTS * DIM)
        for batch in batches:
            _sum_contexts(batch.column(0), total)
        yield pa.RecordBatch.from_pydict({"sums": [total.astype(np.float32).tobytes()]})

    parts = docs.select("text").mapInArrow(sums, "sums binary").rdd
    total = parts.map(lambda r: np.frombuffer(r[0], np.float32).astype(np.float64)).treeReduce(
        np.add, depth=3
    )
    table = total.reshape(SLOTS, DIM)
    met = np.abs(table).sum(axis=1) > 0
    # what all words share says nothing: take the mean direction out
    lengths = np.linalg.norm(table, axis=1, keepdims=True)
    table = np.divide(table, lengths, out=np.zeros_like(table), where=lengths > 0)
    if met.any():
        table[met] -= table[met].mean(axis=0)
    return table.astype(np.float32)


def document_vectors(column, table: np.ndarray) -> np.ndarray:
    """Mean and spread of the vectors of each text's pieces."""
    found = []
    for _, texts in byte_slices(large_text(column), 1 << 20):
        slots, offsets = _pieces.of(texts)
        n = np.diff(offsets)
        out = np.zeros((len(n), 2 * DIM))
        some = np.flatnonzero(n)
        if len(some):
            vectors = table[slots]
            starts = offsets[:-1][some]
            mean = np.add.reduceat(vectors, starts, axis=0, dtype=np.float64) / n[some, None]
            square = np.add.reduceat(vectors * vectors, starts, axis=0, dtype=np.float64)
            out[some, :DIM] = mean
            out[some, DIM:] = np.sqrt(np.maximum(square / n[some, None] - mean**2, 0))
        found.append(out)
    return np.concatenate(found) if found else np.zeros((0, 2 * DIM))


@dataclass(frozen=True)
class Network:
    centre: np.ndarray
    scale: np.ndarray
    weights: tuple[np.ndarray, ...]
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.weights
        return np.tanh((x - self.centre) / self.scale @ w1 + b1) @ w2 + b2

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -40, 40)))


def _constant(share: float) -> Network:
    share = min(max(share, 1e-6), 1 - 1e-6)
    zeros = np.zeros((2 * DIM, 1)), np.zeros(1), np.zeros(1), np.log(share / (1 - share))
    return Network(np.zeros(2 * DIM), np.ones(2 * DIM), zeros, 1.0)


def fit_network(x: np.ndarray, y: np.ndarray, seed: int = 3, steps: int = 1500) -> Network:
    """Two layers, fitted by Adam on four fifths of the rows; the temperature by the
    likelihood of the others."""
    if not len(x) or y.min() == y.max():
        return _constant(float(y.mean()) if len(y) else 0.5)
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(x))
    held = order[: max(1, len(x) // 5)]
    used = order[len(held) :] if len(x) > 1 else order
    centre, scale = x[used].mean(axis=0), x[used].std(axis=0) + 1e-6
    z = (x - centre) / scale
    weights = [
        rng.standard_normal((x.shape[1], HIDDEN)) / np.sqrt(x.shape[1]),
        np.zeros(HIDDEN),
        rng.standard_normal(HIDDEN) / np.sqrt(HIDDEN),
        np.array(np.log((y[used].mean() + 1e-3) / (1 - y[used].mean() + 1e-3))),
    ]
    first, second = [0 * w for w in weights], [0 * w for w in weights]
    for step in range(1, steps + 1):
        rows = rng.choice(used, 256)
        hidden = np.tanh(z[rows] @ weights[0] + weights[1])
        wrong = 1 / (1 + np.exp(-(hidden @ weights[2] + weights[3]))) - y[rows]
        back = wrong[:, None] * weights[2] * (1 - hidden**2)
        grads = [
            z[rows].T @ back / len(rows) + 1e-4 * weights[0],
            back.mean(axis=0),
            hidden.T @ wrong / len(rows) + 1e-4 * weights[2],
            wrong.mean(),
        ]
        rate = 0.01 * (1 - 0.9 * step / steps)
        for i, g in enumerate(grads):
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g * g
            weights[i] = weights[i] - rate * (first[i] / (1 - 0.9**step)) / (
                np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8
            )
    raw = Network(centre, scale, tuple(weights), 1.0)
    logits = raw.logits(x[held])

    def loss(t: float) -> float:
        return float(np.mean(np.logaddexp(0, logits / t) - y[held] * logits / t))

    temperature = min(np.geomspace(0.25, 8, 61), key=loss)
    return Network(centre, scale, raw.weights, float(temperature))


def fold(doc_id) -> F.Column:
    """Rest of crc32(doc_id as text) by 5; 0 is held out of learning."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


def training_sample(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """text, quality of at most ``sample`` labelled documents outside the held-out fold."""
    usable = labels.filter(
        F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != 0)
    )
    chosen = (
        usable.groupBy("doc_id")
        .agg(F.avg("quality").alias("quality"))
        .orderBy(F.xxhash64(F.lit(5), "doc_id"), "doc_id")
        .limit(sample)
    )
    return docs.select("doc_id", "text").join(chosen, "doc_id").select("text", "quality")


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> tuple[np.ndarray, Network]:
    """Word vectors from all documents, network from the labelled sample."""
    table = word_vectors(docs)

    def features(batches):
        for batch in batches:
            vectors = document_vectors(batch.column(0), table)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([v.tobytes() for v in vectors], pa.binary()),
                    batch.column(1).cast(pa.float64()),
                ],
                names=["vector", "quality"],
            )

    rows = (
        training_sample(docs, labels, sample)
        .mapInArrow(features, "vector binary, quality double")
        .collect()
    )
    # at most ``sample`` rows; their order must not depend on the partitioning
    rows.sort(key=lambda r: (bytes(r["vector"]), r["quality"]))
    x = np.array([np.frombuffer(r["vector"]) for r in rows]).reshape(-1, 2 * DIM)
    return table, fit_network(x, np.array([r["quality"] for r in rows]))


def scored(docs: DataFrame, model: tuple[np.ndarray, Network], cut: float = CUT) -> DataFrame:
    """Add ``score`` and ``predicted`` to documents."""
    table, network = model
    docs = docs.drop("score", "predicted")
    at = docs.columns.index("text")

    def score(batches):
        for batch in batches:
            scores = network.scores(document_vectors(batch.column(at), table))
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns,
                    pa.array(scores, pa.float64()),
                    pa.array((scores >= cut).astype(np.int32), pa.int32()),
                ],
                names=[*batch.schema.names, "score", "predicted"],
            )

    schema = T.StructType(
        [
            *docs.schema.fields,
            T.StructField("score", T.DoubleType()),
            T.StructField("predicted", T.IntegerType()),
        ]
    )
    return docs.mapInArrow(score, schema)


def score_documents(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    rows = scored(docs, fit(docs, labels), cut)
    held = F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False))
    return rows.select("doc_id", held.alias("held_out"), "score", "predicted")


def without_low_quality(docs: DataFrame, labels: DataFrame, cut: float = CUT) -> DataFrame:
    """The documents that the classifier doesn't reject, all columns as they are."""
    named = {c: f"_doc_{i}" for i, c in enumerate(docs.columns) if c in ("score", "predicted")}
    rows = scored(docs.withColumnsRenamed(named), fit(docs, labels), cut)
    return rows.filter("predicted = 1").drop("score", "predicted").withColumnsRenamed(
        {v: k for k, v in named.items()}
    )
