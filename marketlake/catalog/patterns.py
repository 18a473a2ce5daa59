"""Item sets, sequences and similarity."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlake.catalog.entry import Book, rounded, sql6
from marketlake.operators import mining, similarity, text
from marketlake.sources.tables import driver_table

book = Book()

_BASKETS = """pairs AS MATERIALIZED (
  SELECT DISTINCT l_orderkey AS basket, p_brand AS item FROM lineitem JOIN part ON l_partkey = p_partkey),
least AS (SELECT ceil(0.02 * count(DISTINCT basket)) AS n FROM pairs),
sets AS (
  SELECT item AS items, 1 AS length, count(*) AS freq FROM pairs GROUP BY item HAVING count(*) >= (SELECT n FROM least)
  UNION ALL
  SELECT a.item || '|' || b.item, 2, count(*) FROM pairs a JOIN pairs b USING (basket)
  WHERE a.item < b.item GROUP BY 1 HAVING count(*) >= (SELECT n FROM least))"""


def _baskets(spark, sf):
    lines = driver_table(spark, sf, "lineitem").select("l_orderkey", "l_partkey")
    parts = driver_table(spark, sf, "part").select("p_partkey", "p_brand")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("l_orderkey").alias("basket"), F.col("p_brand").alias("item")
    )


@book.add("frequent_item_sets", f"WITH {_BASKETS} SELECT items, length, freq FROM sets")
def frequent_item_sets(spark, sf):
    sets, _ = mining.frequent_sets(_baskets(spark, sf), 0.02)
    return sets.select(
        F.array_join(F.array_sort("items"), "|").alias("items"), F.size("items").alias("length"), "freq"
    )


@book.add(
    "association_rules",
    f"""WITH {_BASKETS},
split AS (SELECT string_split(items, '|')[1] AS a, string_split(items, '|')[2] AS b, freq FROM sets WHERE length = 2),
rules AS (SELECT a AS antecedent, b AS consequent, freq FROM split UNION ALL SELECT b, a, freq FROM split)
SELECT antecedent, consequent, {sql6("rules.freq / s.freq")} AS confidence
FROM rules JOIN sets s ON s.items = antecedent WHERE rules.freq / s.freq >= 0.1""",
)
def association_rules(spark, sf):
    _, rules = mining.frequent_sets(_baskets(spark, sf), 0.02)
    named = rules.select(
        F.array_join("antecedent", "|").alias("antecedent"),
        F.array_join("consequent", "|").alias("consequent"),
        "confidence",
    )
    return rounded(named, "confidence")


@book.add(
    "sequential_patterns",
    """WITH RECURSIVE placed AS MATERIALIZED (
  SELECT user_id || '/' || strftime(ts, '%Y-%m-%d') AS who, event_type AS item,
         row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY ts, event_id) AS p FROM events),
least AS (SELECT ceil(0.02 * count(DISTINCT who)) AS n FROM placed),
nexts AS MATERIALIZED (SELECT a.who, a.p, b.item, min(b.p) AS q
  FROM (SELECT who, p FROM placed UNION ALL SELECT DISTINCT who, 0 FROM placed) a
  JOIN placed b ON a.who = b.who AND b.p > a.p GROUP BY ALL),
grown AS (
  SELECT who, '' AS pattern, 0 AS length, CAST(0 AS BIGINT) AS p FROM (SELECT DISTINCT who FROM placed)
  UNION ALL
  SELECT who, pattern, length, p FROM (
    SELECT g.who, CASE g.pattern WHEN '' THEN n.item ELSE g.pattern || '>' || n.item END AS pattern,
           g.length + 1 AS length, n.q AS p, count(*) OVER (PARTITION BY g.pattern, n.item) AS c
    FROM grown g JOIN nexts n ON n.who = g.who AND n.p = g.p) WHERE c >= (SELECT n FROM least))
SELECT pattern, length, count(*) AS freq FROM grown WHERE length > 0 GROUP BY ALL""",
)
def sequential_patterns(spark, sf):
    """Patterns of any length in what a user does in a day."""
    day = F.date_format("ts", "yyyy-MM-dd")
    events = driver_table(spark, sf, "events").select(
        F.concat_ws("/", "user_id", day).alias("who"), F.col("event_type").alias("item"), "ts", "event_id"
    )
    found = mining.sequential_patterns(events, 0.02)
    return found.withColumn("pattern", F.array_join("pattern", ">"))


_UNNESTED = "SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS i, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings"


def _cosine_sql(where):
    return f"""WITH cells AS MATERIALIZED ({_UNNESTED}),
dots AS MATERIALIZED (SELECT a.i AS i, b.i AS j, sum(a.x * b.x) AS dot FROM cells a JOIN cells b USING (vec_id) WHERE a.i <= b.i GROUP BY ALL),
cosines AS (SELECT d.i, d.j, d.dot / sqrt(p.dot * q.dot) AS cosine FROM dots d
  JOIN dots p ON p.i = d.i AND p.j = d.i JOIN dots q ON q.i = d.j AND q.j = d.j WHERE d.i < d.j)
SELECT i, j, {sql6("cosine")} AS cosine FROM cosines WHERE {where}"""


def _vectors(spark, sf):
    return driver_table(spark, sf, "embeddings")


@book.add("column_cosines", _cosine_sql("TRUE"))
def column_cosines(spark, sf):
    return rounded(similarity.column_cosines(_vectors(spark, sf), "embedding"), "cosine")


@book.add("column_cosines_above", _cosine_sql("cosine >= 0.1"))
def column_cosines_above(spark, sf):
    return rounded(similarity.column_cosines(_vectors(spark, sf), "embedding", 0.1), "cosine")


@book.add("column_cosines_sampled_error")
def column_cosines_sampled_error(spark, sf):
    vectors = _vectors(spark, sf)
    exact = similarity.column_cosines(vectors, "embedding")
    return similarity.mean_error(exact, similarity.sampled_column_cosines(vectors, "embedding"))


@book.add(
    "column_cosines_sampled",
    f"""WITH cells AS MATERIALIZED ({_UNNESTED}),
norms AS (SELECT i, sqrt(sum(x * x)) AS norm FROM cells GROUP BY i),
kept AS MATERIALIZED (
  SELECT vec_id, i, x / least(2, norm) AS y FROM cells JOIN norms USING (i)
  WHERE CAST('0x' || substr(md5(vec_id || ':' || i), 1, 8) AS BIGINT) / 4294967296.0 < least(1, 2 / norm)),
pairs AS (SELECT a.i AS i, b.i AS j, sum(a.y * b.y) AS cosine FROM kept a JOIN kept b USING (vec_id) WHERE a.i < b.i GROUP BY ALL)
SELECT i, j, {sql6("cosine")} AS cosine FROM pairs""",
)
def column_cosines_sampled(spark, sf):
    """Estimates from the entries that the hash of row and column keeps, about two thirds."""
    found = similarity.sampled_column_cosines(_vectors(spark, sf), "embedding", key="vec_id", gamma=4.0)
    return rounded(found, "cosine")


_DISTANCES = """SELECT a.id AS "left", b.id AS "right", sqrt(list_sum(list_transform(list_zip(a.v, b.v), lambda p: (p[1] - p[2]) ** 2))) AS distance
FROM points a JOIN points b ON a.id < b.id"""


@book.add("near_vectors")
def near_vectors(spark, sf):
    """Vectors nearer than most.  Any two of these random vectors are some 1.4 apart, which no
    hash tells from 1.15, so buckets are large here; ``near_vectors_moved`` has near pairs."""
    return similarity.near_vectors(_vectors(spark, sf), "vec_id", "embedding", 1.15, recall=0.9)


@book.add(
    "near_vectors_moved",
    f"""WITH points AS MATERIALIZED (
  SELECT vec_id * 2 AS id, [CAST(x AS DOUBLE) FOR x IN embedding] AS v FROM embeddings UNION ALL
  SELECT vec_id * 2 + 1, [CASE WHEN i % 7 = vec_id % 7 THEN embedding[i + 1] + 0.02 * (1 + vec_id % 5) ELSE CAST(embedding[i + 1] AS DOUBLE) END
    FOR i IN range(len(embedding))] FROM embeddings)
SELECT "left", "right", {sql6("distance")} AS distance FROM ({_DISTANCES}) WHERE distance <= 0.35""",
)
def near_vectors_moved(spark, sf):
    """Each vector and one that lies near it: found among all, with their distances."""
    vectors = _vectors(spark, sf).select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    step = 0.02 * (1 + F.col("vec_id") % 5)
    moved = F.transform(
        "v", lambda x, i: F.when(i % 7 == F.col("vec_id") % 7, x + step).otherwise(x)
    )
    points = vectors.select((F.col("vec_id") * 2).alias("id"), "v").union(
        vectors.select((F.col("vec_id") * 2 + 1).alias("id"), moved)
    )
    return rounded(similarity.near_vectors(points, "id", "v", 0.35, recall=0.9999, all_copies=True), "distance")


@book.add(
    "near_texts",
    f"""WITH split AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(text), '[^\\p{{L}}]+'), lambda w: w <> '') AS w
  FROM documents WHERE text IS NOT NULL),
runs AS (
  SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) < 3 THEN w
    ELSE [w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] FOR i IN range(1, len(w) - 1)] END)) AS s FROM split),
sets AS MATERIALIZED (SELECT min(doc_id) AS id, s FROM runs WHERE len(s) > 0 GROUP BY s),
items AS MATERIALIZED (SELECT id, len(s) AS n, unnest(s) AS t FROM sets),
pairs AS (
  SELECT a.id AS "left", b.id AS "right", count(*) / (any_value(a.n) + any_value(b.n) - count(*)) AS likeness
  FROM items a JOIN items b ON a.t = b.t AND a.id < b.id GROUP BY ALL)
SELECT "left", "right", {sql6("1 - likeness")} AS distance FROM pairs WHERE likeness >= 0.5
UNION ALL SELECT id, doc_id, 0 FROM runs JOIN sets USING (s) WHERE id < doc_id""",
)
def near_texts(spark, sf):
    """Texts as sets of three-word runs; a shorter text is the set of its words."""
    docs = driver_table(spark, sf, "documents").select("doc_id", text.words("text").alias("tokens"))
    runs = F.when(F.size("tokens") < 3, F.col("tokens")).otherwise(text.ngrams("tokens", 3))
    found = similarity.near_texts(docs.withColumn("tokens", runs), "doc_id", 0.5, recall=0.9999)
    return rounded(found, "distance")
