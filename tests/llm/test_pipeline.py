"""The pipeline's stages, one on the rows of the other."""

import collections
import re

import pytest

pytest.importorskip("marketlake.llm")
pipeline = pytest.importorskip("corpus_pipeline")

from conftest import SMALL  # noqa: E402

import __spark_entry__ as driver  # noqa: E402
from marketlake.llm.common import keep, table  # noqa: E402


def test_registered():
    names = driver.queries()
    assert "pipeline" in names
    for n in range(1, 11):
        assert len([k for k in names if k.startswith(f"op{n}_")]) == 1


def test_stages(spark):
    rows = table(spark, SMALL, "documents")
    columns = rows.columns
    counts = [rows.count()]
    for name, stage in pipeline.STAGES[:-1]:
        rows = keep(stage(spark, rows, SMALL), f"test-{name}")
        assert rows.columns == columns
        counts.append(rows.count())
    assert counts[0] > counts[1] >= counts[2] >= counts[3] > 0
    packed = pipeline.STAGES[-1][1](spark, rows, SMALL).collect()
    whole = collections.Counter(r.doc_id for r in packed if r.piece == 0)
    assert whole == collections.Counter(r.doc_id for r in rows.select("doc_id").collect())
    assert pipeline.run(spark, SMALL).count() == len(packed)


def test_odd_rows_pass_every_stage(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double"
    rows = [(None, None, None, None, None, None), (1, "", "", "", 0, 1.0), (2, "a b c", "en", "s", 5, None)]
    rows += [(3, "word " * 50, None, None, 1, None)] * 2
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for _, stage in pipeline.STAGES[:-1]:
            docs = keep(stage(spark, docs, SMALL), "odd")
            assert re.sub(r" ", "", schema).replace("long", "") and docs.columns == [
                c.split()[0] for c in schema.split(", ")
            ]
        pipeline.STAGES[-1][1](spark, docs, SMALL).collect()


def test_near_duplicate_stage_links_from_four_fifths(spark):
    """Of 204 words, 200 shingles, a run of n words changed at the end: similarity
    (200 - n) / (200 + n)."""
    base = [f"w{i}" for i in range(204)]
    rows = [(k, " ".join(base[: 204 - n] + [f"x{i}" for i in range(n)])) for k, n in enumerate((0, 20, 25))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    # 180 / 220 = 0.818 to the first; 175 / 225 = 0.778, and 195 / 205 to the second
    for pair, left in ((rows[:2], {0}), ([rows[0], rows[2]], {0, 2}), (rows, {0})):
        found = dict(pipeline.STAGES)["minhash_near_dedup"](
            spark, docs.filter(docs.doc_id.isin([k for k, _ in pair])), SMALL
        )
        assert {r.doc_id for r in found.collect()} == left
