"""Words, lexicon scores, term weights, log parsing, and learned text features."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.clustering import LDA
from pyspark.ml.feature import IDF, HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.operators import skipgrams
from marketlake.session import cut_lineage, slice_count

# fixed values: very common words of the four languages, and the URL pattern
STOP_WORDS = [
    "and", "as", "by", "for", "in", "is", "it", "of", "on", "the", "to", "with",
    "der", "die", "das", "und", "de", "la", "le", "les", "el", "los", "y", "que",
]
URL_PATTERN = r"^https?://([^/:]+)/([a-z]{2})/(\d+)([^?#]*)"


def pieces(text: Column | str) -> Column:
    column = F.col(text) if isinstance(text, str) else text
    return F.split(F.lower(column), r"[^\p{L}]+")


def words(text: Column | str) -> Column:
    """Lower-case runs of letters."""
    return F.filter(pieces(text), lambda w: w != "")


def word_counts(lines: DataFrame, column: str = "text") -> DataFrame:
    """Count of every space-separated token."""
    tokens = lines.select(F.explode(F.split(column, "[ \n]")).alias("word"))
    return tokens.groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def quality_lexicon(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(word, score): +1 when more good than bad documents use the word, else -1."""
    used = (
        docs.join(labels, "doc_id")
        .select("quality", F.explode(F.array_distinct(words("text"))).alias("word"))
        .groupBy("word")
        .agg(F.sum(F.col("quality") * 2 - 1).alias("balance"))
    )
    return used.filter("balance != 0").select("word", F.signum("balance").cast("int").alias("score"))


def lexicon_scores(counts: DataFrame, lexicon: DataFrame) -> DataFrame:
    """Words found in the lexicon with score times count."""
    return counts.join(lexicon, "word").select(
        "word", "n", (F.col("score") * F.col("n")).alias("sentiment")
    )


def lines_matching(texts: Sequence[DataFrame], pattern: str) -> DataFrame:
    """Stack several ``text`` sources and count the lines that match."""
    stacked = texts[0].select("text")
    for more in texts[1:]:
        stacked = stacked.union(more.select("text"))
    lines = stacked.select(F.explode(F.split("text", "\n")).alias("line"))
    return lines.filter(F.col("line").rlike(pattern)).agg(F.count(F.lit(1)).alias("n"))


def url_rollup(pages: DataFrame) -> DataFrame:
    """Requests and bytes per (host, section, kind); URLs the pattern does not fit
    are counted under a null key."""

    def part(group: int) -> Column:
        found = F.regexp_extract("url", URL_PATTERN, group)
        return F.when(F.col("url").rlike(URL_PATTERN), found)

    return (
        pages.select(
            part(1).alias("host"),
            part(2).alias("section"),
            part(4).alias("kind"),
            F.length("html").alias("bytes"),
        )
        .groupBy("host", "section", "kind")
        .agg(F.count(F.lit(1)).alias("requests"), F.sum("bytes").alias("bytes"))
    )


def tokens_without(docs: DataFrame, stop_words: Sequence[str] = STOP_WORDS) -> DataFrame:
    # the empty pieces around words leave in the same pass
    kept = F.filter(pieces("text"), lambda w: ~w.isin("", *stop_words))
    return docs.select("doc_id", kept.alias("tokens"))


def ngrams(tokens: Column | str, n: int) -> Column:
    column = F.col(tokens) if isinstance(tokens, str) else tokens
    shifted = [F.slice(column, k + 1, F.greatest(F.size(column) - n + 1, F.lit(0))) for k in range(n)]
    return F.transform(
        F.arrays_zip(*[s.alias(f"w{k}") for k, s in enumerate(shifted)]),
        lambda z: F.concat_ws(" ", *[z[f"w{k}"] for k in range(n)]),
    )


def term_weights(tokens: DataFrame) -> DataFrame:
    """(doc_id, term, tf, tfidf) with idf = ln((documents + 1) / (df + 1)).

    The number of documents is one value and goes in as a literal; document
    frequencies are joined by term, and AQE splits the terms nearly all share.  They are one
    row a term, so a task hashes its own and the counts need no sort."""
    total = tokens.count()
    # texts are parsed once; a term's documents are then the rows that count it
    tf = cut_lineage(
        tokens.select("doc_id", F.explode("tokens").alias("term"))
        .groupBy("doc_id", "term")
        .agg(F.count(F.lit(1)).alias("tf"))
    )
    df = tf.groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    weight = F.col("tf") * F.log((F.lit(float(total)) + 1) / (F.col("df") + 1))
    return tf.join(df.hint("shuffle_hash"), "term").select("doc_id", "term", "tf", weight.alias("tfidf"))


def hashed_tfidf(tokens: DataFrame, features: int = 1 << 16) -> DataFrame:
    """Sparse TF-IDF vectors of fixed width, without a dictionary."""
    stages = [
        HashingTF(inputCol="tokens", outputCol="tf", numFeatures=features),
        IDF(inputCol="tf", outputCol="features"),
    ]
    return Pipeline(stages=stages).fit(tokens).transform(tokens).select("doc_id", "features")


def word_vectors(
    tokens: DataFrame, size: int = 16, rounds: int = 1, seed: int = 1, block: int = 8192
) -> DataFrame:
    """Mean word vector per document, of all words; a token holds no space.  Blocks of about
    ``block`` documents train on their part, and a word's vectors are averaged over its blocks
    after each round.

    The vectors stay rows, one per word: a block holds those of its own words, the driver none."""
    blocks = max(1, math.ceil(tokens.count() / block))
    texts = tokens.select(
        "doc_id",
        F.coalesce(F.array_join("tokens", " "), F.lit("")).alias("words"),
        F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).alias("block"),
    )
    # dealt by number: adaptive plans would put small blocks into one task, but training takes long
    slices = slice_count(tokens.sparkSession)
    dealt, held = texts.repartition(slices, "block").groupBy("block"), None
    for k in range(rounds):
        last = k == rounds - 1
        first, later = skipgrams.training(size, seed + k, last)
        if held is None:
            trained = dealt.applyInArrow(first, skipgrams.VECTORS)
        else:
            trained = held.groupBy("block").cogroup(dealt).applyInArrow(later, skipgrams.VECTORS)
        means = [F.avg(F.col("vector")[i]).cast("float") for i in range(size if last else 2 * size)]
        # dealt before they are added up: sums take more room than vectors, and few words meet in a task
        held = (
            trained.repartition(slices, "word")
            .groupBy("word")
            .agg(F.collect_list("block").alias("blocks"), F.array(*means).alias("vector"))
            .select(F.explode("blocks").alias("block"), "word", "vector")
        )
    means = skipgrams.document_means(size)
    return held.groupBy("block").cogroup(dealt).applyInArrow(means, "doc_id long, vector array<double>")


def topics(tokens: DataFrame, k: int = 5, slots: int = 1 << 16, rounds: int = 5, seed: int = 1) -> DataFrame:
    """Topic shares per document.  Terms are hashed to slots, so every term counts and
    the model's size doesn't grow with the vocabulary."""
    stages = [
        HashingTF(inputCol="tokens", outputCol="counts", numFeatures=slots),
        LDA(featuresCol="counts", k=k, maxIter=rounds, seed=seed, optimizer="online"),
    ]
    scored = Pipeline(stages=stages).fit(tokens).transform(tokens)
    return scored.select("doc_id", vector_to_array("topicDistribution").alias("shares"))
