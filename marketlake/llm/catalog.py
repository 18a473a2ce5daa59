"""Registered queries of the corpus operators, with SQL where SQL can say them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from marketlake.llm import (
    alignment,
    embedding_dup,
    exact_dup,
    html_text,
    line_dup,
    mixing,
    near_dup,
    packing,
    quality_model,
    quality_rules,
    token_files,
    warc,
    whitening,
)
from marketlake.llm.common import keep, table

END_OF_PIECES, END_OF_FILES = 1, 2


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = Query(run, sql)
        return run

    return register


def tokenizer_path() -> str:
    """The vocabulary of the contracts; every operator takes a path."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _documents(spark, sf_dir):
    return table(spark, sf_dir, "documents")


@query("op1_minhash_near_dedup")
def op1(spark, sf_dir):
    return near_dup.near_duplicates(_documents(spark, sf_dir))


@query("op2_best_fit_packing")
def op2(spark, sf_dir):
    return packing.pack_documents(_documents(spark, sf_dir), tokenizer_path(), END_OF_PIECES)


_SIZES = r"""sizes AS (
  SELECT doc_id, source,
         CAST(len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')) AS BIGINT) AS size
  FROM documents)"""

# Water-filling in closed form: caps per weight in ascending order, the level of the first
# prefix that leaves all later sources below their caps.
_TARGETS = """totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
         (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
  FROM sizes GROUP BY source),
levels AS (
  SELECT *, 3.0 * source_size / weight AS ratio,
         (SELECT sum(source_size) FROM totals) AS budget,
         coalesce(sum(3 * source_size) OVER w, 0) AS clamped,
         (SELECT sum(weight) FROM totals) - coalesce(sum(weight) OVER w, 0) AS open
  FROM totals
  WINDOW w AS (ORDER BY 3.0 * source_size / weight, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
  SELECT CAST(max((budget - clamped) / open) AS DOUBLE) AS level FROM levels
  WHERE (budget - clamped) / open <= ratio OR ratio = (SELECT max(ratio) FROM levels)),
targets AS (
  SELECT source, source_size, least(CAST(3 * source_size AS DOUBLE), weight * level) AS target
  FROM totals, level)"""

OP3_SQL = f"""WITH {_SIZES}, {_TARGETS},
hashed AS (
  SELECT s.*, t.source_size, t.target, floor(t.target / nullif(t.source_size, 0)) AS epochs,
         substr(md5('1:' || coalesce(CAST(doc_id AS VARCHAR), 'null') || ':' || CAST(size AS VARCHAR)), 1, 12) AS digits
  FROM sizes s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
placed AS (
  SELECT *, target - epochs * source_size AS need,
         sum(size) OVER (PARTITION BY source, digits) AS here,
         sum(size) OVER (PARTITION BY source ORDER BY digits) AS upto
  FROM hashed),
counted AS (
  SELECT *, CASE WHEN source_size = 0 THEN 0
                 ELSE epochs + CASE WHEN need > 0 AND upto < need THEN 1 ELSE 0 END END AS times,
         CASE WHEN source_size > 0 AND need > 0 AND upto >= need AND upto - here < need
              THEN floor(size * ((need - (upto - here)) / here)) ELSE 0 END AS part
  FROM placed)
SELECT doc_id, size, source_size, target, CAST(size * times + part AS BIGINT) AS taken FROM counted"""


@query("op3_mixing", OP3_SQL)
def op3(spark, sf_dir):
    return mixing.mix(_documents(spark, sf_dir)).drop("times", "part")


OP4_SQL = """WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS n,
         sha256(coalesce(html, '')) AS digest FROM pages),
firsts AS (SELECT digest, min(page_id) AS first FROM payloads WHERE n >= 100 GROUP BY digest)
SELECT p.page_id, CAST(p.n AS BIGINT) AS payload_bytes, p.digest AS payload_digest,
       CASE WHEN f.first <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.first <> p.page_id THEN f.first END AS refers_to
FROM payloads p LEFT JOIN firsts f ON p.digest = f.digest AND p.n >= 100"""


@query("op4_warc", OP4_SQL)
def op4(spark, sf_dir):
    folder, manifest = warc.write_warc(table(spark, sf_dir, "pages"))
    return warc.read_warc(folder, manifest).drop("url")


@query("op5_html_extraction")
def op5(spark, sf_dir):
    return html_text.extract(table(spark, sf_dir, "pages"))


@query("op6_quality_classifier")
def op6(spark, sf_dir):
    return quality_model.score_documents(
        _documents(spark, sf_dir), table(spark, sf_dir, "labels")
    )


@query("op7_embedding_near_dedup")
def op7(spark, sf_dir):
    return embedding_dup.near_vectors(table(spark, sf_dir, "embeddings"))


@query("op8_token_files")
def op8(spark, sf_dir):
    folder, manifest = token_files.write_token_files(
        _documents(spark, sf_dir), tokenizer_path(), END_OF_FILES
    )
    return token_files.read_token_files(folder, manifest)


@query("op9_quality_rules")
def op9(spark, sf_dir):
    stats = keep(
        quality_rules.with_statistics(_documents(spark, sf_dir)).select(
            "doc_id", *quality_rules.STATISTICS, "n_upper"
        ),
        "rule-statistics",
    )
    return quality_rules.judge(stats, quality_rules.fit(stats)).select(
        "doc_id", *quality_rules.STATISTICS, "base_failed", "kept", "quality"
    )


OP10_SQL = """WITH RECURSIVE texts AS (SELECT doc_id, text, string_split(text, chr(10)) AS parts FROM documents WHERE text IS NOT NULL),
lines AS MATERIALIZED (
  SELECT doc_id, i, parts[i + 1] AS line,
         len(list_filter(regexp_split_to_array(parts[i + 1], '[\\x20\\x09-\\x0D]+'), lambda w: w <> '')) AS words
  FROM (SELECT doc_id, parts, unnest(range(len(parts))) AS i FROM texts)),
upto AS MATERIALIZED (
  SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY i) AS upto FROM lines),
windows AS MATERIALIZED (
  SELECT a.doc_id, a.i AS s, min(b.i) AS e FROM upto a JOIN upto b
    ON a.doc_id = b.doc_id AND b.i >= a.i AND b.upto - a.upto + a.words >= 8 GROUP BY ALL
  UNION
  SELECT b.doc_id, max(a.i) AS s, b.i AS e FROM upto a JOIN upto b
    ON a.doc_id = b.doc_id AND b.i >= a.i AND b.upto - a.upto + a.words >= 8 GROUP BY b.doc_id, b.i),
contents AS MATERIALIZED (
  SELECT w.doc_id, w.s, w.e, string_agg(l.line, chr(10) ORDER BY l.i) AS content
  FROM windows w JOIN lines l ON l.doc_id = w.doc_id AND l.i BETWEEN w.s AND w.e GROUP BY ALL),
firsts AS (SELECT content, e - s AS n, min(doc_id) AS doc, arg_min(s, doc_id * 100000 + s) AS s FROM contents GROUP BY ALL),
gone AS (
  SELECT DISTINCT c.doc_id, unnest(range(c.s, c.e + 1)) AS i
  FROM contents c JOIN firsts f ON c.content = f.content AND c.e - c.s = f.n
  WHERE c.doc_id <> f.doc OR c.s > f.s + f.n)
SELECT t.doc_id, len(t.parts) AS n_lines, (SELECT count(*) FROM gone g WHERE g.doc_id = t.doc_id) AS n_removed,
       CASE WHEN EXISTS (SELECT 1 FROM gone g WHERE g.doc_id = t.doc_id)
            THEN coalesce((SELECT string_agg(l.line, chr(10) ORDER BY l.i) FROM lines l ANTI JOIN gone g ON g.doc_id = l.doc_id AND g.i = l.i WHERE l.doc_id = t.doc_id), '')
            ELSE t.text END AS text
FROM texts t
UNION ALL SELECT doc_id, 0, 0, text FROM documents WHERE text IS NULL"""


@query("op10_line_dedup", OP10_SQL)
def op10(spark, sf_dir):
    rows = line_dup.without_repeated_lines(
        _documents(spark, sf_dir).select("doc_id", "text")
    )
    return rows.withColumnsRenamed({"_n_lines": "n_lines", "_n_removed": "n_removed"})


@query("op11_whitening")
def op11(spark, sf_dir):
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query("op12_token_alignment")
def op12(spark, sf_dir):
    import public_tokenizers

    return alignment.alignment_digests(
        _documents(spark, sf_dir),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
    )


OP13_SQL = """SELECT doc_id, max(doc_id) OVER same AS keep_id, CAST(count(*) OVER same AS BIGINT) AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(content) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS content FROM documents)
WINDOW same AS (PARTITION BY content)"""


@query("op13_exact_dedup", OP13_SQL)
def op13(spark, sf_dir):
    return exact_dup.exact_duplicates(_documents(spark, sf_dir))
