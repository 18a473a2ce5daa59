"""A training corpus from documents: quality classifier, line deduplication, near-duplicate
removal, source mixing, packing.  Each stage works on all rows that the one before kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from marketlake.llm import line_dup, mixing, near_dup, packing, quality_model
from marketlake.llm.catalog import END_OF_PIECES, tokenizer_path
from marketlake.llm.common import keep, prepared, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labels, doesn't reject."""
    return quality_model.without_low_quality(docs, table(spark, sf_dir, "labels"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without later copies of repeated line runs."""
    prepared(spark)
    return line_dup.deduplicated_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: similarity 0.8 or more."""
    prepared(spark)
    return near_dup.without_near_duplicates(docs, near_dup.STAGE)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target takes them."""
    prepared(spark)
    return mixing.mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place of every piece of the mixed documents in a training sequence."""
    prepared(spark)
    return packing.pack_documents(docs, tokenizer_path(), END_OF_PIECES)


STAGES = [
    ("quality_classifier", quality),
    ("line_dedup", lines),
    ("minhash_near_dedup", near_duplicates),
    ("mixing", mix),
    ("best_fit_packing", pack),
]

# SQL can't train the classifier or tokenise.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; rows between stages are written to the shared folder."""
    rows = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        rows = keep(stage(spark, rows, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, rows, sf_dir)
