"""Helpers shared by the corpus operators: tables in the shared folder, files that
tasks write, and words."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow.fs import FileSystem, FileType
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.session import pin_runtime, scratch_path

# The six ASCII white-space characters that part words.
WORD_BREAKS = r"[\x20\x09-\x0D]+"


# Rows handed to Python at a time: texts of some kilobytes, and some of a hundred.
BATCH_ROWS = 1_000


def prepared(spark: SparkSession) -> SparkSession:
    """Session settings of these operators: the library's, and batches of texts that fit
    beside the executor's heap."""
    pin_runtime(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def keep(df: DataFrame, label: str) -> DataFrame:
    """Write rows to the shared folder and read them back.

    Cuts the lineage so that a lost executor costs a read and no recomputation, and
    gives the planner the true size for its join choices."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words_of(text: Column) -> Column:
    """Words of a text, native; no words for a null text."""
    parts = F.split(F.coalesce(text, F.lit("")), WORD_BREAKS)
    return F.filter(parts, lambda w: w != "")


def byte_slices(texts: pa.Array, most: int = 2 << 20) -> Iterator[tuple[int, pa.Array]]:
    """(first row, rows) pieces of a text column of about ``most`` bytes, whole texts
    each, so that the memory of vectorised work doesn't depend on the batch size."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    bounds = np.cumsum(sizes) // most
    starts = np.flatnonzero(np.diff(bounds, prepend=-1)) if len(sizes) else []
    for a, b in zip(starts, [*starts[1:], len(sizes)]):
        yield int(a), texts.slice(a, b - a)


def large_text(column: pa.Array | pa.ChunkedArray) -> pa.Array:
    """A text column with 64-bit offsets and without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return pc.fill_null(column.cast(pa.large_string()), "")


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct words, place of each word's entry, offsets of the texts' words)."""
    lists = pc.ascii_split_whitespace(texts)
    if isinstance(lists, pa.ChunkedArray):
        lists = lists.combine_chunks()
    coded = lists.flatten().dictionary_encode()
    entries = coded.dictionary
    places = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    blank = pc.index(entries, "").as_py()
    if blank >= 0:  # white space at the ends leaves empty words
        real = places != blank
        offsets = np.concatenate([[0], np.cumsum(real)])[offsets]
        places = places[real]
    return entries, places, offsets


def spread(places: np.ndarray, starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Indices of all items of the named runs, one run after the other."""
    n = counts[places]
    ends = np.cumsum(n)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts[places] - (ends - n), n) + np.arange(total)


# --- files written and read by tasks ---------------------------------------------


def store(path: str) -> tuple[FileSystem, str]:
    """File system and inner path of a folder named by path or URI."""
    return FileSystem.from_uri(path)


class CommittedFile:
    """A file that shows under its final name only when it is complete.  A second
    attempt of a task writes the same bytes under another temporary name."""

    def __init__(self, folder: str, name: str):
        self.fs, inner = store(folder)
        self.fs.create_dir(inner, recursive=True)
        self.final = f"{inner}/{name}"
        self.temporary = f"{inner}/_{name}.{uuid.uuid4().hex}"
        self.out = self.fs.open_output_stream(self.temporary)

    def write(self, data: bytes) -> None:
        self.out.write(data)

    def tell(self) -> int:
        return self.out.tell()

    def commit(self) -> None:
        self.out.close()
        if self.fs.get_file_info(self.final).type != FileType.NotFound:
            self.fs.delete_file(self.final)
        self.fs.move(self.temporary, self.final)


def file_per_task(manifest: DataFrame) -> DataFrame:
    """Deal a manifest out so that each task gets about one file."""
    files = manifest.count()
    return manifest.repartition(max(1, files))
