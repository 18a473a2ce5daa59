"""Text jobs over documents, conversations and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlake.catalog.entry import Book, rounded, sql6
from marketlake.operators import text
from marketlake.sources.tables import driver_table

book = Book()

_WORDS = r"list_filter(regexp_split_to_array(lower(text), '[^\p{L}]+'), lambda w: w <> '')"
_STOPS = "[" + ", ".join(f"'{w}'" for w in text.STOP_WORDS) + "]"
_TOKENS = f"""tokens AS MATERIALIZED (
  SELECT doc_id, list_filter({_WORDS}, lambda w: NOT list_contains({_STOPS}, w)) AS tokens FROM documents)"""


def _docs(spark, sf):
    return driver_table(spark, sf, "documents").select("doc_id", "text")


def _tokens(spark, sf):
    return text.tokens_without(_docs(spark, sf))


@book.add(
    "word_counts",
    r"SELECT word, count(*) AS n FROM (SELECT unnest(regexp_split_to_array(text, '[ \n]')) AS word FROM documents) GROUP BY word",
)
def word_counts(spark, sf):
    return text.word_counts(_docs(spark, sf))


_LEXICON = f"""lexicon AS (
  SELECT word, CAST(sign(sum(quality * 2 - 1)) AS INTEGER) AS score FROM (
    SELECT quality, unnest(list_distinct({_WORDS})) AS word FROM documents JOIN labels USING (doc_id))
  GROUP BY word HAVING sum(quality * 2 - 1) <> 0)"""


@book.add(
    "lexicon_sentiment",
    f"""WITH {_LEXICON},
counts AS (SELECT word, count(*) AS n FROM (
  SELECT unnest(regexp_split_to_array(text, '[ \\n]')) AS word FROM conversations) GROUP BY word)
SELECT word, n, score * n AS sentiment FROM counts JOIN lexicon USING (word) ORDER BY sentiment DESC, word""",
)
def lexicon_sentiment(spark, sf):
    lexicon = text.quality_lexicon(_docs(spark, sf), driver_table(spark, sf, "labels"))
    counts = text.word_counts(driver_table(spark, sf, "conversations").select("text"))
    return text.lexicon_scores(counts, lexicon).orderBy(F.desc("sentiment"), "word")


@book.add(
    "lines_matching",
    """SELECT count(*) AS n FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM (
  SELECT text FROM documents UNION ALL SELECT text FROM conversations UNION ALL SELECT text FROM benchmark))
WHERE regexp_matches(line, '[tT]h[ae]')""",
)
def lines_matching(spark, sf):
    sources = [driver_table(spark, sf, t) for t in ("documents", "conversations", "benchmark")]
    return text.lines_matching(sources, "[tT]h[ae]")


_URL = text.URL_PATTERN


@book.add(
    "url_rollup",
    f"""SELECT host, section, kind, count(*) AS requests, CAST(sum(bytes) AS BIGINT) AS bytes FROM (
  SELECT CASE WHEN m THEN regexp_extract(url, '{_URL}', 1) END AS host,
    CASE WHEN m THEN regexp_extract(url, '{_URL}', 2) END AS section,
    CASE WHEN m THEN regexp_extract(url, '{_URL}', 4) END AS kind, length(html) AS bytes
  FROM (SELECT *, regexp_matches(url, '{_URL}') AS m FROM pages)) GROUP BY ALL""",
)
def url_rollup(spark, sf):
    return text.url_rollup(driver_table(spark, sf, "pages").select("url", "html"))


@book.add(
    "ngram_counts",
    f"""WITH {_TOKENS},
grams AS (SELECT doc_id, tokens, list_transform(range(1, len(tokens)),
  lambda i: tokens[i] || ' ' || tokens[i + 1]) AS bigrams FROM tokens)
SELECT doc_id, len(tokens) AS n_tokens, len(bigrams) AS n_bigrams, len(list_distinct(bigrams)) AS n_distinct FROM grams""",
)
def ngram_counts(spark, sf):
    grams = _tokens(spark, sf).withColumn("bigrams", text.ngrams("tokens", 2))
    return grams.select(
        "doc_id",
        F.size("tokens").cast("bigint").alias("n_tokens"),
        F.size("bigrams").cast("bigint").alias("n_bigrams"),
        F.size(F.array_distinct("bigrams")).cast("bigint").alias("n_distinct"),
    )


@book.add(
    "term_weights",
    f"""WITH {_TOKENS},
tf AS MATERIALIZED (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(tokens) AS term FROM tokens) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term)
SELECT doc_id, term, tf, {sql6("tf * ln(((SELECT count(*) FROM documents) + 1.0) / (df + 1))")} AS tfidf
FROM tf JOIN df USING (term)""",
)
def term_weights(spark, sf):
    return rounded(text.term_weights(_tokens(spark, sf)), "tfidf")


@book.add("hashed_term_weights")
def hashed_term_weights(spark, sf):
    vectors = text.hashed_tfidf(_tokens(spark, sf))
    # sparse: the weights of the slots in use
    weights = F.unwrap_udt("features")["values"]
    return vectors.select(
        "doc_id",
        F.aggregate(weights, F.lit(0.0), lambda a, x: a + x).alias("total_weight"),
        F.size(F.filter(weights, lambda x: x > 0)).alias("slots_used"),
    )


@book.add("document_vectors")
def document_vectors(spark, sf):
    return text.word_vectors(_tokens(spark, sf))


@book.add("document_topics")
def document_topics(spark, sf):
    return text.topics(_tokens(spark, sf))
