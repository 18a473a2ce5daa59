"""Token-ID files: patched frame-of-reference blocks in shard files.

A shard holds the ids of consecutive documents; a task starts a new one when it has written
ROLL_TOKENS ids, at a document's end.  Ids are cut into blocks of 1,024;
a block keeps its minimum, packs the differences at the width that fits 98 % of
them, and lists position and value of the others.  The shard's index has block
starts, minima, widths and exception counts, and the documents' ids and lengths, so
a reader can go to any block or document; it reads the index, and then the blocks some at a
time.  Little-endian throughout:

    magic | blocks (packed 64-bit words, exception positions u16, values u32) |
    index arrays | index length u64 | magic

Defined cases: a null text is an empty text and gives the end id alone; null ids of
documents come first; rows that repeat an id are kept, each with its own ids; other
columns are ignored; an empty table gives no shard and no rows."""

from __future__ import annotations

import io
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.llm.common import CommittedFile, file_per_task, keep, store
from marketlake.llm.tokens import encoded
from marketlake.session import scratch_path

BLOCK = 1024
FITS = 0.98
MAGIC = b"PFORIDS1"
_LANE = 64  # values per group of packed words: a group is as many words as the width
_FLUSH = 512 * BLOCK
ROLL_TOKENS = 1 << 26


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """(blocks, BLOCK) numbers below 2^width as (blocks, bytes)."""
    if width == 0:
        return np.zeros((len(values), 0), np.uint8)
    lanes = np.ascontiguousarray(values.reshape(-1, _LANE).T.astype(np.uint64))
    words = np.zeros((width, lanes.shape[1]), np.uint64)
    for j in range(_LANE):
        word, shift = divmod(j * width, 64)
        words[word] |= lanes[j] << np.uint64(shift)
        if shift + width > 64:
            words[word + 1] |= lanes[j] >> np.uint64(64 - shift)
    return np.ascontiguousarray(words.T).reshape(len(values), -1).view(np.uint8)


def _unpack(packed: np.ndarray, width: int) -> np.ndarray:
    if width == 0:
        return np.zeros((len(packed), BLOCK), np.uint64)
    words = np.ascontiguousarray(packed).view("<u8").reshape(-1, width).T
    lanes = np.empty((_LANE, words.shape[1]), np.uint64)
    mask = np.uint64((1 << width) - 1)
    for j in range(_LANE):
        word, shift = divmod(j * width, 64)
        value = words[word] >> np.uint64(shift)
        if shift + width > 64:
            value = value | (words[word + 1] << np.uint64(64 - shift))
        lanes[j] = value & mask
    return np.ascontiguousarray(lanes.T).reshape(len(packed), BLOCK)


def _bits(values: np.ndarray) -> np.ndarray:
    """Bit lengths of numbers below 2^32."""
    return np.frexp(values.astype(np.float64))[1].astype(np.uint8)


def encode_blocks(ids: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """(blocks, minima, widths, exception counts) of ids whose number is a multiple
    of BLOCK."""
    table = ids.reshape(-1, BLOCK).astype(np.uint32)
    low = table.min(axis=1)
    rest = table - low[:, None]
    place = int(FITS * (BLOCK - 1))
    widths = _bits(np.partition(rest, place, axis=1)[:, place])
    blocks: list[bytes] = [b""] * len(table)
    counts = np.zeros(len(table), np.uint16)
    for width in np.unique(widths):
        rows = np.flatnonzero(widths == width)
        part = rest[rows].astype(np.uint64)
        packed = _pack(part & np.uint64((1 << int(width)) - 1), int(width))
        odd = part >> np.uint64(width) != 0
        counts[rows] = odd.sum(axis=1)
        for i, row in enumerate(rows):
            at = np.flatnonzero(odd[i])
            blocks[row] = (
                packed[i].tobytes() + at.astype("<u2").tobytes() + table[row, at].tobytes()
            )
    return blocks, low, widths, counts


class ShardWriter:
    def __init__(self, folder: str, name: str):
        self.file = CommittedFile(folder, name)
        self.file.write(MAGIC)
        self.pending: list[np.ndarray] = []
        self.waiting = self.tokens = 0
        self.index: list[list[np.ndarray]] = [[], [], [], []]
        self.docs: list[np.ndarray] = []
        self.named: list[np.ndarray] = []
        self.lengths: list[np.ndarray] = []

    def add(self, doc_ids: pa.Array, ids: np.ndarray, lengths: np.ndarray) -> None:
        self.docs.append(doc_ids.fill_null(0).to_numpy(zero_copy_only=False))
        self.named.append(doc_ids.is_valid().to_numpy(zero_copy_only=False))
        self.lengths.append(lengths)
        self.pending.append(ids)
        self.waiting += len(ids)
        self.tokens += len(ids)
        if self.waiting >= _FLUSH:
            self._flush()

    def _flush(self, last: bool = False) -> None:
        ids = np.concatenate(self.pending) if self.pending else np.zeros(0, np.uint32)
        whole = len(ids) - len(ids) % BLOCK
        if last and whole < len(ids):
            ids = np.concatenate([ids, np.full(BLOCK - len(ids) % BLOCK, ids[-1], ids.dtype)])
            whole = len(ids)
        for a in range(0, whole, _FLUSH):
            blocks, low, widths, counts = encode_blocks(ids[a : min(whole, a + _FLUSH)])
            sizes = np.fromiter(map(len, blocks), np.int64, len(blocks))
            starts = self.file.tell() + np.cumsum(sizes) - sizes
            for column, values in zip(self.index, (starts, low, widths, counts)):
                column.append(values)
            self.file.write(b"".join(blocks))
        self.pending = [ids[whole:]] if whole < len(ids) else []
        self.waiting = len(ids) - whole

    def close(self) -> tuple[int, int, int]:
        """(documents, ids, bytes)."""
        self._flush(last=True)
        body = io.BytesIO()
        columns = [*self.index, self.docs, self.named, self.lengths]
        kinds = [np.int64, np.uint32, np.uint8, np.uint16, np.int64, np.bool_, np.int64]
        np.save(body, np.array([self.tokens], np.int64))
        for column, kind in zip(columns, kinds):
            np.save(body, np.concatenate(column).astype(kind) if column else np.zeros(0, kind))
        index = body.getvalue()
        self.file.write(index + len(index).to_bytes(8, "little") + MAGIC)
        size = self.file.tell()
        self.file.commit()
        return sum(map(len, self.docs)), self.tokens, size


def read_shard(source) -> Iterator[tuple[int | None, np.ndarray]]:
    """(document, its ids) in file order, from a seekable file or the bytes of one.  The index
    and _FLUSH ids are held at a time, and the document that is read."""
    if isinstance(source, bytes):
        source = io.BytesIO(source)
    tail = len(MAGIC) + 8

    def part(start: int, n: int) -> bytes:
        source.seek(start)
        return source.read(n)

    source.seek(0, 2)
    size = source.tell()
    ends = part(max(0, size - tail), tail)
    if size < tail or part(0, len(MAGIC)) != MAGIC or ends[8:] != MAGIC:
        raise ValueError("not a complete token file")
    length = int.from_bytes(ends[:8], "little")
    blocks_end = size - tail - length
    body = io.BytesIO(part(blocks_end, length))
    total, starts, low, widths, counts, docs, named, lengths = (np.load(body) for _ in range(8))
    bounds = np.append(starts, blocks_end)
    step = _FLUSH // BLOCK

    def decoded() -> Iterator[np.ndarray]:
        for a in range(0, len(starts), step):
            some = slice(a, a + step)
            begin = int(bounds[a])
            data = part(begin, int(bounds[min(a + step, len(starts))]) - begin)
            raw = np.frombuffer(data, np.uint8)
            out = np.empty((len(starts[some]), BLOCK), np.uint32)
            for width in np.unique(widths[some]):
                rows = np.flatnonzero(widths[some] == width)
                packed = BLOCK * int(width) // 8
                at = starts[some][rows] - begin
                values = _unpack(raw[at[:, None] + np.arange(packed)], int(width))
                out[rows] = values.astype(np.uint32) + low[some][rows][:, None]
                for row, start in zip(rows, at + packed):
                    n = int(counts[some][row])
                    places = np.frombuffer(data, "<u2", n, start)
                    out[row, places] = np.frombuffer(data, "<u4", n, start + 2 * n)
            yield out.ravel()

    pieces, buffer, left = decoded(), np.zeros(0, np.uint32), int(total[0])
    for doc, ok, n in zip(docs, named, lengths):
        if len(buffer) < n:
            parts = [buffer]
            have = len(buffer)
            while have < n:
                piece = next(pieces)[:left]
                left -= len(piece)
                parts.append(piece)
                have += len(piece)
            buffer = np.concatenate(parts)
        yield (int(doc) if ok else None), buffer[:n]
        buffer = buffer[n:]


def write_token_files(
    docs: DataFrame,
    tokenizer: str,
    end_id: int,
    folder: str | None = None,
    roll_tokens: int = ROLL_TOKENS,
) -> tuple[str, DataFrame]:
    """Tokenise documents (doc_id, text) and write shards in ascending doc_id order.

    Documents are range-partitioned; each task tokenises its range and writes its shards
    under temporary names first.  Returns the folder and its manifest: shard (task and number
    in it), file, docs, tokens, bytes, first_token (the ids in all shards before it)."""
    folder = folder or scratch_path(docs.sparkSession, "token-files")

    def write(batches):
        task = TaskContext.get().partitionId()
        writer, name, written = None, "", 0

        def closed():
            n, tokens, size = writer.close()
            columns = {"shard": (task << 32) + written, "file": name, "docs": n, "tokens": tokens, "bytes": size}
            return pa.RecordBatch.from_pydict({k: [v] for k, v in columns.items()})

        for batch in batches:
            doc_ids = batch.column(0)
            for first, ids, offsets in encoded(batch.column(1), tokenizer):
                ids = np.insert(ids, offsets[1:], end_id)
                bounds = offsets + np.arange(len(offsets))
                row = 0
                while row < len(bounds) - 1:
                    if writer is None:
                        name = f"shard-{task:07d}-{written:05d}.pfor"
                        writer = ShardWriter(folder, name)
                    room = roll_tokens - writer.tokens
                    # whole documents, one at least
                    upto = int(np.searchsorted(bounds, bounds[row] + room, side="right")) - 1
                    upto = max(upto, row + 1)
                    writer.add(
                        doc_ids.slice(first + row, upto - row),
                        ids[bounds[row] : bounds[upto]],
                        np.diff(bounds[row : upto + 1]),
                    )
                    if upto < len(bounds) - 1 or writer.tokens >= roll_tokens:
                        yield closed()
                        writer, written = None, written + 1
                    row = upto
        if writer:
            yield closed()

    shards = keep(
        docs.select(F.col("doc_id").cast("long"), "text")
        .repartitionByRange(F.col("doc_id"))
        .sortWithinPartitions("doc_id")
        .mapInArrow(write, "shard long, file string, docs long, tokens long, bytes long"),
        "token-manifest",
    )
    # one row per shard, as in the manifest
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return folder, shards.withColumn(
        "first_token", F.coalesce(F.sum("tokens").over(before), F.lit(0).cast("long"))
    )


def read_token_files(folder: str, manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the shards."""

    def read(batches):
        fs, inner = store(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with fs.open_input_file(f"{inner}/{row['file']}") as source:
                    found = [
                        (doc, len(ids), zlib.crc32(np.ascontiguousarray(ids, "<u4")))
                        for doc, ids in read_shard(source)
                    ]
                doc_ids, sizes, sums = zip(*found) if found else ((), (), ())
                n = np.array(sizes, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(doc_ids, pa.int64()),
                        pa.array(np.cumsum(n) - n + row["first_token"]),
                        pa.array(n),
                        pa.array(sums, pa.int64()),
                    ],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"],
                )

    return file_per_task(manifest.select("file", "first_token")).mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long"
    )
