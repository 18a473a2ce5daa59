"""Skew-safe grouping, prediction metrics, summaries, tests and samples."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from marketlake.catalog.entry import Book, rounded, sql6
from marketlake.operators import scaling, stats, wide
from marketlake.sources.tables import driver_table

book = Book()


def _events(spark, sf):
    return driver_table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")


def _lines(spark, sf):
    return driver_table(spark, sf, "lineitem")


@book.add(
    "skewed_group_by",
    """SELECT l_returnflag, count(*) AS rows, CAST(sum(l_partkey) AS BIGINT) AS total,
  count(DISTINCT l_partkey) AS distinct_values FROM lineitem GROUP BY 1""",
)
def skewed_group_by(spark, sf):
    return stats.salted_distinct_counts(_lines(spark, sf), "l_returnflag", "l_partkey")


# --- metrics ------------------------------------------------------------------------

_SCORED = "scored AS MATERIALIZED (SELECT n_chars AS score, quality AS label FROM documents JOIN labels USING (doc_id))"


@book.add(
    "metrics_binary",
    f"""WITH {_SCORED},
per AS (SELECT score, sum(label) AS h, sum(1 - label) AS m FROM scored GROUP BY score),
cum AS (SELECT *, sum(h) OVER w AS tp, sum(m) OVER w AS fp FROM per WINDOW w AS (ORDER BY score DESC)),
points AS (SELECT *, tp - h AS tp0, fp - m AS fp0, tp / (tp + fp) AS p FROM cum)
SELECT CAST(sum(h) AS BIGINT) AS positives, CAST(sum(m) AS BIGINT) AS negatives,
  {sql6("sum(m * (tp0 + tp) / 2.0) / (sum(h) * sum(m))")} AS area_roc,
  {sql6("sum(h * (CASE WHEN tp0 + fp0 > 0 THEN tp0 / (tp0 + fp0) ELSE p END + p) / 2.0) / sum(h)")} AS area_pr
FROM points""",
)
def metrics_binary(spark, sf):
    """Document length as a score for quality."""
    docs = driver_table(spark, sf, "documents").select("doc_id", F.col("n_chars").alias("score"))
    labels = driver_table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    return rounded(stats.binary_metrics(docs.join(labels, "doc_id")), "area_roc", "area_pr")


_GUESSED = """guessed AS MATERIALIZED (SELECT l_orderkey, l_returnflag AS label,
  CASE WHEN l_quantity < 17 THEN 'A' WHEN l_quantity < 34 THEN 'N' ELSE 'R' END AS prediction FROM lineitem)"""


def _guessed(spark, sf):
    """A rule on quantity that guesses the return flag."""
    guess = F.when(F.col("l_quantity") < 17, "A").when(F.col("l_quantity") < 34, "N").otherwise("R")
    return _lines(spark, sf).select("l_orderkey", F.col("l_returnflag").alias("label"), guess.alias("prediction"))


_PER_CLASS = f"""per AS (SELECT c AS class,
  (SELECT count(*) FROM guessed WHERE label = c) AS actual, (SELECT count(*) FROM guessed WHERE prediction = c) AS called,
  (SELECT count(*) FROM guessed WHERE label = c AND prediction = c) AS hit
  FROM (SELECT label AS c FROM guessed UNION SELECT prediction FROM guessed)),
scores AS (SELECT class, actual, hit, hit / nullif(called, 0) AS p, hit / nullif(actual, 0) AS r FROM per)"""


@book.add(
    "metrics_per_class",
    f"""WITH {_GUESSED}, {_PER_CLASS} SELECT class, actual, {sql6("p")} AS precision, {sql6("r")} AS recall,
  {sql6("2 * p * r / (p + r)")} AS f1 FROM scores""",
)
def metrics_per_class(spark, sf):
    return rounded(stats.class_metrics(_guessed(spark, sf)), "precision", "recall", "f1")


@book.add(
    "metrics_multiclass",
    f"""WITH {_GUESSED}, {_PER_CLASS} SELECT CAST(sum(actual) AS BIGINT) AS n, {sql6("sum(hit) / sum(actual)")} AS accuracy,
  {sql6("sum(actual * p) / sum(actual)")} AS weighted_precision, {sql6("sum(actual * r) / sum(actual)")} AS weighted_recall,
  {sql6("sum(actual * 2 * p * r / (p + r)) / sum(actual)")} AS weighted_f1 FROM scores""",
)
def metrics_multiclass(spark, sf):
    found = stats.multiclass_metrics(_guessed(spark, sf))
    return rounded(found, *[c for c in found.columns if c != "n"])


@book.add(
    "metrics_multilabel",
    f"""WITH {_GUESSED},
sets AS (SELECT list_distinct(list(label)) AS a, list_distinct(list(prediction)) AS b FROM guessed GROUP BY l_orderkey),
sizes AS (SELECT len(a) AS na, len(b) AS nb, len(list_intersect(a, b)) AS nc FROM sets)
SELECT {sql6("avg(CASE WHEN nc = na AND nc = nb THEN 1 ELSE 0 END)")} AS subset_accuracy,
  {sql6("avg(nc / (na + nb - nc))")} AS accuracy, {sql6("sum(na + nb - 2 * nc) / (count(*) * 3)")} AS hamming_loss,
  {sql6("avg(nc / nb)")} AS precision, {sql6("avg(nc / na)")} AS recall, {sql6("avg(2 * nc / (na + nb))")} AS f1,
  {sql6("2 * sum(nc) / (sum(na) + sum(nb))")} AS micro_f1 FROM sizes""",
)
def metrics_multilabel(spark, sf):
    """Flags per order: a set of at most three classes on each side."""
    sets = _guessed(spark, sf).groupBy("l_orderkey").agg(
        F.collect_set("label").alias("labels"), F.collect_set("prediction").alias("predictions")
    )
    found = stats.multilabel_metrics(sets, 3)
    return rounded(found, *found.columns)


@book.add(
    "metrics_regression",
    f"""WITH p AS (SELECT l_extendedprice AS y, l_quantity * 1500 AS f FROM lineitem)
SELECT {sql6("avg((y - f) * (y - f)) / 1e6")} AS mse, {sql6("sqrt(avg((y - f) * (y - f)))")} AS rmse,
  {sql6("avg(abs(y - f))")} AS mae, {sql6("1 - avg((y - f) * (y - f)) / var_pop(y)")} AS r2,
  {sql6("(var_pop(y) - var_pop(y - f)) / 1e6")} AS explained FROM p""",
)
def metrics_regression(spark, sf):
    """Line price guessed from quantity; squared measures in millions."""
    predicted = _lines(spark, sf).select(
        F.col("l_extendedprice").alias("label"), (F.col("l_quantity") * 1500).alias("prediction")
    )
    found = stats.regression_metrics(predicted)
    scaled = found.withColumns({c: F.col(c) / 1e6 for c in ("mse", "explained")})
    return rounded(scaled, *scaled.columns)


@book.add(
    "metrics_ranking",
    f"""WITH counts AS (SELECT user_id, event_type, count(*) AS n FROM events
  WHERE ts < TIMESTAMP '2024-01-20' GROUP BY ALL),
ranked AS (SELECT user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) AS r FROM counts),
wanted AS (SELECT DISTINCT user_id, event_type FROM events WHERE ts >= TIMESTAMP '2024-01-20' AND value > 100),
sizes AS (SELECT user_id, count(*) AS w FROM wanted GROUP BY 1),
hits AS (SELECT user_id, r, count(*) OVER (PARTITION BY user_id ORDER BY r) AS nth FROM ranked JOIN wanted USING (user_id, event_type)),
per AS (SELECT user_id, sum(CASE WHEN r <= 3 THEN 1 ELSE 0 END) AS top, sum(nth / r) AS ps,
  sum(CASE WHEN r <= 3 THEN 1 / log2(r + 1) ELSE 0 END) AS gain FROM hits GROUP BY 1),
joined AS (SELECT w, coalesce(top, 0) AS top, coalesce(ps, 0) AS ps, coalesce(gain, 0) AS gain,
  list_sum(list_transform(range(1, least(w, 3) + 1), lambda i: 1 / log2(i + 1))) AS ideal
  FROM sizes LEFT JOIN per USING (user_id))
SELECT count(*) AS users, {sql6("avg(top / 3.0)")} AS precision_at_k,
  {sql6("avg(ps / w)")} AS mean_average_precision, {sql6("avg(gain / ideal)")} AS ndcg_at_k FROM joined""",
)
def metrics_ranking(spark, sf):
    """Users' habits before a date as a ranking of what they value after it."""
    events = _events(spark, sf)
    split = F.lit("2024-01-20").cast("timestamp")
    habit = Window.partitionBy("user_id").orderBy(F.desc("n"), "event_type")
    ranked = (
        events.filter(F.col("ts") < split)
        .groupBy("user_id", "event_type")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            F.col("user_id").alias("user"), F.col("event_type").alias("item"), F.row_number().over(habit).alias("rank")
        )
    )
    wanted = events.filter((F.col("ts") >= split) & (F.col("value") > 100)).select(
        F.col("user_id").alias("user"), F.col("event_type").alias("item")
    )
    found = stats.ranking_metrics(ranked, wanted, 3)
    return rounded(found, *[c for c in found.columns if c != "users"])


# --- summaries and tests ------------------------------------------------------------------

_MEASURES = ["l_quantity", "l_extendedprice", "l_discount"]


def _summary_sql(c):
    return f"""SELECT '{c}' AS "column", count({c}) AS n, {sql6(f"avg({c})")} AS mean,
  {sql6(f"var_samp({c}) / 1e6")} AS variance, min({c}) AS low, max({c}) AS high,
  count(*) FILTER (WHERE {c} <> 0) AS nonzeros, {sql6(f"sum(abs({c})) / 1e6")} AS norm_l1,
  {sql6(f"sqrt(sum({c} * {c})) / 1e3")} AS norm_l2 FROM lineitem"""


@book.add("column_summary", " UNION ALL ".join(_summary_sql(c) for c in _MEASURES))
def column_summary(spark, sf):
    found = stats.column_summary(_lines(spark, sf), _MEASURES)
    scaled = found.withColumns(
        {"variance": F.col("variance") / 1e6, "norm_l1": F.col("norm_l1") / 1e6, "norm_l2": F.col("norm_l2") / 1e3}
    )
    return rounded(scaled, "mean", "variance", "norm_l1", "norm_l2")


@book.add("correlation_pearson", f"SELECT {sql6('corr(l_quantity, l_extendedprice)')} AS correlation FROM lineitem")
def correlation_pearson(spark, sf):
    return rounded(stats.pearson(_lines(spark, sf), "l_quantity", "l_extendedprice"), "correlation")


@book.add(
    "correlation_spearman",
    f"""WITH a AS (SELECT l_quantity AS x, l_extendedprice AS y FROM lineitem),
r AS (SELECT rank() OVER (ORDER BY x) + (count(*) OVER (PARTITION BY x) - 1) / 2.0 AS rx,
  rank() OVER (ORDER BY y) + (count(*) OVER (PARTITION BY y) - 1) / 2.0 AS ry FROM a)
SELECT {sql6("corr(rx, ry)")} AS correlation FROM r""",
)
def correlation_spearman(spark, sf):
    return rounded(stats.spearman(_lines(spark, sf), "l_quantity", "l_extendedprice"), "correlation")


@book.add(
    "chi_square",
    f"""WITH c AS (SELECT l_returnflag AS x, l_linenumber AS y, count(*) AS o FROM lineitem GROUP BY ALL),
m AS (SELECT *, sum(o) OVER (PARTITION BY x) AS r, sum(o) OVER (PARTITION BY y) AS k, sum(o) OVER () AS t FROM c)
SELECT {sql6("sum((o - r * k / t) * (o - r * k / t) / (r * k / t))")} AS statistic,
  (count(DISTINCT x) - 1) * (count(DISTINCT y) - 1) AS freedom FROM m""",
)
def chi_square(spark, sf):
    found = stats.chi_square(_lines(spark, sf), "l_returnflag", "l_linenumber")
    return rounded(found, "statistic")


@book.add("chi_square_p_value")
def chi_square_p_value(spark, sf):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.stat import ChiSquareTest

    rows = _lines(spark, sf).select(
        F.col("l_linenumber").cast("double").alias("x"), F.ascii("l_returnflag").cast("double").alias("label")
    )
    vectors = VectorAssembler(inputCols=["x"], outputCol="v").transform(rows)
    return ChiSquareTest.test(vectors, "v", "label", flatten=True)


_MEAN = 50.0


@book.add(
    "kolmogorov_smirnov",
    f"""WITH s AS (SELECT value, row_number() OVER (ORDER BY value) AS i, count(*) OVER () AS n FROM events)
SELECT {sql6(f"max(greatest(i / n - (1 - exp(-value / {_MEAN})), (1 - exp(-value / {_MEAN})) - (i - 1) / n))")} AS distance FROM s""",
)
def kolmogorov_smirnov(spark, sf):
    """Distance of event values from an exponential distribution."""
    found = stats.ks_statistic(_events(spark, sf), "value", lambda x: 1 - F.exp(-x / _MEAN))
    return rounded(found, "distance")


@book.add("kolmogorov_smirnov_normal")
def kolmogorov_smirnov_normal(spark, sf):
    from pyspark.ml.stat import KolmogorovSmirnovTest

    return KolmogorovSmirnovTest.test(_events(spark, sf), "value", "norm", 50.0, 50.0)


_POINTS = [0.0, 10.0, 50.0, 100.0, 200.0]


@book.add(
    "kernel_density",
    f"""SELECT point, {sql6("1000 * avg(exp(-0.5 * ((value - point) / 5.0) ** 2) / (5.0 * sqrt(2 * pi())))")} AS density
FROM events, (SELECT unnest([{", ".join(map(str, _POINTS))}]::DOUBLE[]) AS point) GROUP BY point""",
)
def kernel_density(spark, sf):
    found = stats.kernel_density(_events(spark, sf), "value", _POINTS, 5.0)
    return rounded(found.withColumn("density", F.col("density") * 1000), "density")


# --- experiments, daily means, samples -------------------------------------------------------


@book.add(
    "welch_per_day",
    f"""WITH a AS (SELECT CAST(ts AS DATE) AS d, CASE WHEN event_type = 'view' THEN 1 ELSE 0 END AS arm, value FROM events
  WHERE event_type IN ('view', 'click')),
m AS (SELECT d, count(*) FILTER (WHERE arm = 0) AS n0, count(*) FILTER (WHERE arm = 1) AS n1,
  avg(value) FILTER (WHERE arm = 0) AS m0, avg(value) FILTER (WHERE arm = 1) AS m1,
  var_samp(value) FILTER (WHERE arm = 0) AS v0, var_samp(value) FILTER (WHERE arm = 1) AS v1 FROM a GROUP BY d)
SELECT strftime(d, '%Y-%m-%d') AS day, n0, n1, {sql6("m0")} AS mean0, {sql6("m1")} AS mean1,
  {sql6("(m0 - m1) / sqrt(v0 / n0 + v1 / n1)")} AS t,
  {sql6("(v0 / n0 + v1 / n1) ** 2 / ((v0 / n0) ** 2 / (n0 - 1) + (v1 / n1) ** 2 / (n1 - 1))")} AS freedom
FROM m WHERE n0 > 1 AND n1 > 1""",
)
def welch_per_day(spark, sf):
    arms = _events(spark, sf).filter(F.col("event_type").isin("view", "click"))
    observed = arms.select(
        F.to_date("ts").cast("string").alias("day"),
        F.when(F.col("event_type") == "view", 1).otherwise(0).alias("arm"),
        "value",
    )
    return rounded(stats.welch(observed, ["day"]), "mean0", "mean1", "t", "freedom")


@book.add(
    "daily_delays",
    f"""SELECT strftime(CAST(o_orderdate AS DATE), '%Y-%m-%d') AS day, count(*) AS n,
  {sql6("avg(date_diff('day', o_orderdate, l_shipdate))")} AS mean_delay, {sql6("avg(l_extendedprice)")} AS mean_price
FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate > o_orderdate GROUP BY CAST(o_orderdate AS DATE)""",
)
def daily_delays(spark, sf):
    orders = driver_table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    late = (
        _lines(spark, sf)
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .filter("l_shipdate > o_orderdate")
        .select(
            "o_orderdate",
            F.date_diff("l_shipdate", "o_orderdate").alias("delay"),
            F.col("l_extendedprice").alias("price"),
        )
    )
    found = stats.daily_means(late, "o_orderdate", ["delay", "price"])
    return rounded(found.withColumn("day", F.col("day").cast("string")), "mean_delay", "mean_price")


_SHARE = "CAST('0x' || substr(md5(CAST(event_id AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0"


@book.add("sample_by_hash", f"SELECT event_id, value FROM events WHERE {_SHARE} < 0.1")
def sample_by_hash(spark, sf):
    return stats.hash_sample(_events(spark, sf), "event_id", 0.1).select("event_id", "value")


@book.add(
    "sample_by_hash_stratified",
    f"""SELECT event_id, event_type FROM events
WHERE (event_type = 'purchase' AND {_SHARE} < 0.5) OR (event_type = 'view' AND {_SHARE} < 0.05)""",
)
def sample_by_hash_stratified(spark, sf):
    found = stats.stratified_hash_sample(
        _events(spark, sf), "event_id", "event_type", {"purchase": 0.5, "view": 0.05}
    )
    return found.select("event_id", "event_type")


@book.add("sample_random")
def sample_random(spark, sf):
    return stats.random_sample(_events(spark, sf), 0.1, 7)


@book.add("sample_stratified")
def sample_stratified(spark, sf):
    return stats.stratified_sample(_events(spark, sf), "event_type", {"purchase": 0.5, "view": 0.05}, 7)


@book.add(
    "chi_square_significance",
    f"""WITH cells AS (SELECT l_returnflag AS x, l_linenumber AS y, count(*) AS o FROM lineitem GROUP BY ALL),
sums AS (SELECT *, sum(o) OVER (PARTITION BY x) AS r, sum(o) OVER (PARTITION BY y) AS c, sum(o) OVER () AS n FROM cells),
tested AS (SELECT max(n) * (sum(o * o / (r * c)) - 1) AS statistic, (count(DISTINCT x) - 1) * (count(DISTINCT y) - 1) AS freedom FROM sums)
SELECT {sql6("statistic")} AS statistic, freedom,
  {sql6("exp(-statistic / 2) * list_sum([pow(statistic / 2, j) / gamma(j + 1) FOR j IN range(CAST(freedom / 2 AS BIGINT))])")} AS p_value
FROM tested""",
)
def chi_square_significance(spark, sf):
    """The oracle adds up the closed form that even degrees of freedom have."""
    tested = stats.chi_square(_lines(spark, sf), "l_returnflag", "l_linenumber")
    return rounded(stats.with_chi_square_chance(tested), "statistic", "p_value")


_PHI = """CASE WHEN z = 0 THEN 0.5 ELSE 0.5 + sign(z) * list_sum([
  exp((2 * k + 1) * ln(abs(z)) - z * z / 2 - 0.5 * ln(2 * pi()) - (k + 1) * ln(2) - lgamma(k + 1.5) + 0.5 * ln(pi())) FOR k IN range(160)]) END"""


@book.add(
    "kolmogorov_smirnov_chance",
    f"""WITH counted AS (SELECT value AS v, count(*) AS n FROM events GROUP BY 1),
placed AS (SELECT (v - 50) / 50 AS z, n, sum(n) OVER (ORDER BY v) AS upto, sum(n) OVER () AS total FROM counted),
theory AS (SELECT *, {_PHI} AS phi FROM placed),
found AS (SELECT max(greatest(upto / total - phi, phi - (upto - n) / total)) AS distance, max(total) AS n FROM theory),
scaled AS (SELECT *, (sqrt(n) + 0.12 + 0.11 / sqrt(n)) * distance AS l FROM found)
SELECT {sql6("distance")} AS distance, CAST(n AS BIGINT) AS n,
  {sql6("greatest(0, least(1, list_sum([CASE WHEN j % 2 = 1 THEN 2 ELSE -2 END * exp(-2.0 * j * j * l * l) FOR j IN range(1, 101)])))")} AS p_value
FROM scaled""",
)
def kolmogorov_smirnov_chance(spark, sf):
    """Distance of the values from a normal distribution, and the chance of such a distance."""
    return rounded(stats.ks_normal(_events(spark, sf), "value", 50.0, 50.0), "distance", "p_value")


_SHARES = [0.1, 0.25, 0.5, 0.75, 0.9]


@book.add(
    "quantiles_per_group",
    f"""SELECT event_type, share, count(value) AS n, TRUE AS within_bound
FROM events, (SELECT unnest({_SHARES}) AS share) GROUP BY ALL""",
)
def quantiles_per_group(spark, sf):
    """Sketched quantiles per event type, and whether their exact ranks are within the bound."""
    events, accuracy = _events(spark, sf), 200
    sketched = scaling.group_quantiles(events, ["event_type"], "value", _SHARES, accuracy)
    shares = F.array(*[F.lit(s) for s in _SHARES])
    found = sketched.select("event_type", "n", F.inline(F.arrays_zip(shares.alias("share"), F.col("borders").alias("border"))))
    value, border = F.col("value"), F.col("border")
    ranked = events.join(found, "event_type").groupBy("event_type", "share", "n").agg(
        F.count_if(value < border).alias("below"), F.count_if(value <= border).alias("upto")
    )
    slack = F.col("n") / accuracy + 1
    wanted = F.col("share") * F.col("n")
    within = (F.col("below") <= wanted + slack) & (F.col("upto") >= wanted - slack)
    return ranked.select("event_type", "share", "n", within.alias("within_bound"))


@book.add(
    "singular_energy_wide",
    f"""SELECT {sql6("sum(x * x)")} AS energy, {sql6("sum(v)")} AS variance FROM (
  SELECT i, x, 0 AS v FROM (SELECT unnest(range(len(embedding))) AS i, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings)
  UNION ALL SELECT i, 0, var_samp(x) FROM (
    SELECT unnest(range(len(embedding))) AS i, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings) GROUP BY i)""",
)
def singular_energy_wide(spark, sf):
    """All singular values, and all variances of the principal components, found by blocks of
    directions; their sums are the table's energy and variance."""
    vectors = driver_table(spark, sf, "embeddings")
    energy = wide.decompose(vectors, "embedding", 64)
    spread = wide.decompose(vectors, "embedding", 64, centred=True)
    rows = [(float((energy.values**2).sum()), float(spread.variances().sum()))]
    return rounded(spark.createDataFrame(rows, "energy double, variance double"), "energy", "variance")
