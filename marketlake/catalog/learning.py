"""Scaling, encoding, selection, training, clustering, recommendation."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import Window
from pyspark.sql import functions as F

from marketlake.catalog import views as V
from marketlake.catalog.entry import Book, r6, rounded, sql6
from marketlake.operators import models, scaling
from marketlake.operators.ordered import CHUNK, POS, WARMUP, halo_chunks, number_rows
from marketlake.operators.text import words
from marketlake.plans import gold
from marketlake.session import cut_lineage
from marketlake.sources import adapters
from marketlake.sources.tables import driver_table

book = Book()

# --- scaling and binning -------------------------------------------------------------

_MEASURES = ["l_quantity", "l_extendedprice", "l_discount"]
_LINE = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]


def _lines(spark, sf):
    return driver_table(spark, sf, "lineitem").select(*_LINE, *_MEASURES)


def _scaling_query(name, expression, run):
    """``expression`` is SQL over column {c}, {c}_mean and so on."""
    stat = ", ".join(
        f"avg({c}) AS {c}_mean, stddev_samp({c}) AS {c}_sd, min({c}) AS {c}_lo, max({c}) AS {c}_hi,"
        f" quantile_cont({c}, 0.25) AS {c}_q1, quantile_cont({c}, 0.5) AS {c}_q2, quantile_cont({c}, 0.75) AS {c}_q3"
        for c in _MEASURES
    )
    shown = ", ".join(f"{sql6(expression.format(c=c))} AS {c}" for c in _MEASURES)
    sql = f"WITH s AS (SELECT {stat} FROM lineitem) SELECT {', '.join(_LINE)}, {shown} FROM lineitem, s"
    book.add(name, sql)(run)


def _with_fit(function):
    def run(spark, sf):
        lines = _lines(spark, sf)
        fits = scaling.fit_columns(lines, _MEASURES)
        return lines.select(*_LINE, *[r6(function(c, fits[c])).alias(c) for c in _MEASURES])

    return run


_scaling_query("scale_standard", "({c} - {c}_mean) / {c}_sd", _with_fit(scaling.standard))
_scaling_query("scale_min_max", "({c} - {c}_lo) / ({c}_hi - {c}_lo)", _with_fit(scaling.min_max))
_scaling_query("scale_max_abs", "{c} / greatest(abs({c}_lo), abs({c}_hi))", _with_fit(scaling.max_abs))


def _scale_robust(spark, sf):
    lines = _lines(spark, sf)
    return lines.select(*_LINE, *[r6(scaling.robust(lines, c)).alias(c) for c in _MEASURES])


_scaling_query("scale_robust", "({c} - {c}_q2) / ({c}_q3 - {c}_q1)", _scale_robust)


def _normalise(spark, sf):
    columns = scaling.normalised(_MEASURES)
    return _lines(spark, sf).select(*_LINE, *[r6(v).alias(c) for c, v in zip(_MEASURES, columns)])


_scaling_query("normalise_rows", "{c} / sqrt(l_quantity ** 2 + l_extendedprice ** 2 + l_discount ** 2)", _normalise)


@book.add(
    "binarise_and_bucket",
    f"""WITH q AS (SELECT quantile_cont(l_extendedprice, 0.25) AS a, quantile_cont(l_extendedprice, 0.5) AS b,
  quantile_cont(l_extendedprice, 0.75) AS c FROM lineitem)
SELECT {", ".join(_LINE)}, CASE WHEN l_discount > 0.05 THEN 1.0 ELSE 0.0 END::DOUBLE AS discounted,
  CASE WHEN l_quantity < 10 THEN 0 WHEN l_quantity < 25 THEN 1 ELSE 2 END AS size_bucket,
  CASE WHEN l_extendedprice < a THEN 0 WHEN l_extendedprice < b THEN 1 WHEN l_extendedprice < c THEN 2 ELSE 3 END AS price_bin
FROM lineitem, q""",
)
def binarise_and_bucket(spark, sf):
    lines = _lines(spark, sf)
    return lines.select(
        *_LINE,
        scaling.binarised("l_discount", 0.05).alias("discounted"),
        scaling.bucketed("l_quantity", [0, 10, 25, 1000]).alias("size_bucket"),
        scaling.quantile_bins(lines, "l_extendedprice", 4).alias("price_bin"),
    )


# --- missing values and categories -------------------------------------------------------


def _gappy(spark, sf):
    """Values of error events count as missing."""
    known = F.when(F.col("event_type") != "error", F.col("value"))
    return driver_table(spark, sf, "events").select("event_id", "event_type", known.alias("value"))


_GAPPY = "gappy AS (SELECT event_id, event_type, CASE WHEN event_type <> 'error' THEN value END AS value FROM events)"


def _impute_query(strategy, fill):
    def run(spark, sf):
        filled = scaling.imputed(_gappy(spark, sf), ["value"], strategy)
        return rounded(filled.select("event_id", "value"), "value")

    sql = f"WITH {_GAPPY}, f AS (SELECT {fill} AS fill FROM gappy) SELECT event_id, {sql6('coalesce(value, fill)')} AS value FROM gappy, f"
    book.add(f"impute_{strategy}", sql)(run)


_impute_query("mean", "avg(value)")
_impute_query("median", "quantile_cont(value, 0.5)")
_impute_query("mode", "max((SELECT value FROM gappy WHERE value IS NOT NULL GROUP BY value ORDER BY count(*) DESC, value LIMIT 1))")


@book.add(
    "category_index",
    """WITH n AS (SELECT p_brand AS category, row_number() OVER (ORDER BY count(*) DESC, p_brand) - 1 AS index FROM part GROUP BY 1)
SELECT p_partkey, index AS brand_index, CASE WHEN index < 3 THEN 1.0 ELSE 0.0 END::DOUBLE AS in_top_three
FROM part JOIN n ON p_brand = category""",
)
def category_index(spark, sf):
    parts = driver_table(spark, sf, "part").select("p_partkey", "p_brand")
    index = scaling.category_index(parts, "p_brand")
    placed = scaling.indexed(parts, "p_brand", index, "brand_index")
    slots = scaling.one_hot("brand_index", 4)
    return placed.select(
        "p_partkey", "brand_index", F.aggregate(slots, F.lit(0.0), lambda a, x: a + x).alias("in_top_three")
    )


@book.add("encode_features")
def encode_features(spark, sf):
    out = models.encoded(_gappy(spark, sf).withColumn("size", F.length("event_type").cast("double")), ["value", "size"], "event_type")
    arrays = models.as_arrays(out, "category_slots", "indexed", "sliced", "expanded", "crossed")
    return arrays.select("event_id", "category_back", "category_slots", "indexed", "sliced", "expanded", "crossed")


@book.add(
    "formula_features",
    f"""WITH flags AS (SELECT l_returnflag AS flag, row_number() OVER (ORDER BY count(*) DESC, l_returnflag) AS r
  FROM lineitem GROUP BY 1)
SELECT {", ".join(_LINE)}, [{sql6("l_quantity")}, {sql6("l_extendedprice / l_quantity")},
  CASE WHEN r = 1 THEN 1.0 ELSE 0.0 END::DOUBLE, CASE WHEN r = 2 THEN 1.0 ELSE 0.0 END::DOUBLE] AS features,
  l_tax AS label FROM lineitem JOIN flags ON l_returnflag = flag""",
)
def formula_features(spark, sf):
    lines = driver_table(spark, sf, "lineitem")
    more = models.derived(lines, "SELECT *, l_extendedprice / l_quantity AS unit_price FROM __THIS__")
    out = models.formula(more, "l_tax ~ l_quantity + unit_price + l_returnflag")
    return models.as_arrays(out, "features").select(*_LINE, _r6_array("features"), "label")


# --- reduction and selection -----------------------------------------------------------------


def _r6_array(name):
    return F.transform(name, r6).alias(name)


def _embeddings(spark, sf):
    return models.as_vectors(driver_table(spark, sf, "embeddings"), "embedding")


@book.add("principal_components")
def principal_components(spark, sf):
    out = models.principal_components(_embeddings(spark, sf), 4)
    return models.as_arrays(out, "components").select("vec_id", "components")


@book.add("singular_values")
def singular_values(spark, sf):
    values = models.singular_values(driver_table(spark, sf, "embeddings"), "embedding", 5)
    return spark.createDataFrame(list(enumerate(values)), "place int, value double")


def _selection(method, sql=None, **params):
    def run(spark, sf):
        labelled = _embeddings(spark, sf).withColumn("label", F.col("label").cast("double"))
        out = models.selected(labelled, method, **params)
        return models.as_arrays(out, "selected").select("vec_id", _r6_array("selected"))

    book.add(f"select_features_{method}", sql)(run)


_CELLS = """cells AS MATERIALIZED (SELECT vec_id, generate_subscripts(embedding, 1) AS i,
  CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings)"""
_selection(
    "variance",
    f"""WITH {_CELLS}, wide AS (SELECT i FROM cells GROUP BY i HAVING var_samp(x) > 0.0155)
SELECT vec_id, list({sql6("x")} ORDER BY i) AS selected FROM cells JOIN wide USING (i) GROUP BY vec_id""",
    varianceThreshold=0.0155,
)
_selection("univariate")


@book.add("select_features_chi_square")
def select_features_chi_square(spark, sf):
    """Chi-square wants categories: embeddings are cut at zero."""
    signs = driver_table(spark, sf, "embeddings").select(
        "vec_id",
        F.col("label").cast("double").alias("label"),
        F.transform("embedding", lambda x: F.when(x > 0, 1.0).otherwise(0.0)).alias("signs"),
    )
    out = models.selected(models.as_vectors(signs, "signs"), "chi_square", numTopFeatures=5)
    return models.as_arrays(out, "selected").select("vec_id", "selected")


@book.add(
    "transform_vectors",
    f"""WITH {_CELLS},
waves AS (SELECT vec_id, k, sum(x * cos(pi() / 64 * (i - 0.5) * k)) * CASE k WHEN 0 THEN sqrt(1 / 64.0) ELSE sqrt(2 / 64.0) END AS y
  FROM cells, range(64) AS r(k) GROUP BY vec_id, k),
t AS (SELECT vec_id, list({sql6("y")} ORDER BY k) AS transformed FROM waves GROUP BY vec_id),
w AS (SELECT vec_id, list({sql6("x * (1 + (i - 1) / 64.0)")} ORDER BY i) AS weighted FROM cells GROUP BY vec_id)
SELECT vec_id, transformed, weighted FROM t JOIN w USING (vec_id)""",
)
def transform_vectors(spark, sf):
    out = models.weighted(models.cosine_transformed(_embeddings(spark, sf)), [1 + k / 64 for k in range(64)])
    return models.as_arrays(out, "transformed", "weighted").select(
        "vec_id", _r6_array("transformed"), _r6_array("weighted")
    )


# --- classification ------------------------------------------------------------------------------

_TEXT_FEATURES = ["chars", "n_words", "mean_word", "capitals", "digits"]


def _documents(spark, sf):
    docs = driver_table(spark, sf, "documents").select("doc_id", "text")
    n = F.size(words("text"))
    numbers = docs.select(
        "doc_id",
        F.log1p(F.length("text")).alias("chars"),
        F.log1p(n).alias("n_words"),
        (F.length("text") / (n + 1)).alias("mean_word"),
        (F.regexp_count("text", F.lit("[A-Z]")) / (F.length("text") + 1)).alias("capitals"),
        (F.regexp_count("text", F.lit("[0-9]")) / (F.length("text") + 1)).alias("digits"),
    )
    labels = driver_table(spark, sf, "labels").select("doc_id", F.col("quality").cast("double").alias("label"))
    return models.assembled(cut_lineage(numbers.join(labels, "doc_id", "left")), _TEXT_FEATURES)


def _labelled(rows):
    """Training and held-out rows of those that have a label."""
    return models.split_by_hash(rows.filter("label IS NOT NULL"), "doc_id")


def _metrics_frame(spark, algorithm, metrics):
    rows = [(algorithm, name, float(value)) for name, value in metrics.items()]
    return spark.createDataFrame(rows, "algorithm string, metric string, value double")


def _classification(algorithm, **params):
    def run(spark, sf):
        rows = _documents(spark, sf)
        scored = models.classify(_labelled(rows)[0], rows, algorithm, **params)
        return scored.select("doc_id", "label", "prediction")

    book.add(f"classify_{algorithm}")(run)


for _name in models.CLASSIFIERS:
    _classification(_name, **({"width": len(_TEXT_FEATURES)} if _name == "perceptron" else {}))


@book.add("classify_metrics")
def classify_metrics(spark, sf):
    train, test = _labelled(_documents(spark, sf))
    scored = cut_lineage(
        models.as_arrays(models.classify(train, test, "forest"), "rawPrediction").select(
            "label", "prediction", "rawPrediction"
        )
    )
    scored = scored.withColumn("rawPrediction", array_to_vector("rawPrediction"))
    return _metrics_frame(spark, "forest", models.classification_metrics(scored))


# --- regression: next hour's close -------------------------------------------------------------------


def next_hour(spark, sf):
    """Hourly means with the next hour's mean close as label."""
    hours = gold.hourly_prices(adapters.minute_bars(spark, sf))
    ahead = Window.partitionBy("symbol").orderBy("timestamp")
    rows = hours.withColumns(
        {"label": F.lead("avg_close").over(ahead), "previous": F.lag("avg_close").over(ahead)}
    )
    features = ["avg_close", "previous", "avg_volume", "avg_transactions"]
    rows = rows.withColumn("censor", F.lit(1.0)).na.drop(subset=features)
    return models.assembled(cut_lineage(rows), features)


def _past(rows):
    """Training rows: the label is known, and lies in the first four fifths of the time."""
    first, last = rows.agg(F.unix_seconds(F.min("timestamp")), F.unix_seconds(F.max("timestamp"))).first()
    if first is None:
        return rows, rows
    split = F.timestamp_seconds(F.lit(first + (last - first) * 4 // 5))
    past, later = models.split_by_time(rows, "timestamp", split)
    return past.filter("label > 0"), later


def _regression(algorithm):
    def run(spark, sf):
        train, later = _past(next_hour(spark, sf))
        return models.regress(train, later, algorithm).select("symbol", "timestamp", "label", "prediction")

    book.add(f"regress_{algorithm}")(run)


for _name in models.REGRESSORS:
    _regression(_name)


# --- clustering and recommendation ---------------------------------------------------------------------


def _clustering(algorithm):
    def run(spark, sf):
        return models.cluster(_embeddings(spark, sf), algorithm, 5).select("vec_id", "prediction")

    book.add(f"cluster_{algorithm}")(run)


for _name in models.CLUSTERERS:
    _clustering(_name)


def _part_ratings(spark, sf):
    lines = driver_table(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    orders = driver_table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    joined = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.groupBy(F.col("o_custkey").cast("int").alias("user"), F.col("l_partkey").cast("int").alias("item")).agg(
        F.avg("l_quantity").cast("float").alias("rating")
    )


@book.add("cluster_graph")
def cluster_graph(spark, sf):
    """Customers and parts as one weighted graph."""
    edges = _part_ratings(spark, sf).select(
        F.col("user").cast("long").alias("src"),
        (F.col("item") + 1_000_000_000).cast("long").alias("dst"),
        F.col("rating").cast("double").alias("weight"),
    )
    return models.cluster_graph(edges, 3)


@book.add("recommend_parts")
def recommend_parts(spark, sf):
    """Five parts per customer, out of all parts that were bought."""
    return models.recommendations(cut_lineage(_part_ratings(spark, sf)), 5)


@book.add("recommend_error")
def recommend_error(spark, sf):
    rated = _part_ratings(spark, sf).withColumn("pair", F.concat_ws("-", "user", "item"))
    rated = cut_lineage(rated)
    train, test = models.split_by_hash(rated, "pair")
    return _metrics_frame(spark, "factors", {"rmse": models.recommendation_error(train, test)})


@book.add("choose_by_cross_validation")
def choose_by_cross_validation(spark, sf):
    rows = _documents(spark, sf)
    return models.cross_validated(_labelled(rows)[0], rows)[0].select("doc_id", "label", "prediction")


@book.add("choose_by_split_validation")
def choose_by_split_validation(spark, sf):
    train, later = _past(next_hour(spark, sf))
    return models.split_validated(train, later)[0].select("symbol", "timestamp", "label", "prediction")


# --- properties that fitted models must have -----------------------------------------------------------

_HOURS = """hours AS (SELECT symbol, date_trunc('hour', ts) AS ts, avg(close) AS close FROM bars GROUP BY ALL),
ahead AS (SELECT *, lead(close) OVER w AS label, lag(close) OVER w AS previous FROM hours WINDOW w AS (PARTITION BY symbol ORDER BY ts)),
rows AS (SELECT * FROM ahead WHERE previous IS NOT NULL),
border AS (SELECT epoch(min(ts)) + (CAST(epoch(max(ts)) AS BIGINT) - CAST(epoch(min(ts)) AS BIGINT)) * 4 // 5 AS split_at FROM rows),
past AS (SELECT * FROM rows, border WHERE epoch(ts) < split_at AND label > 0)"""


@book.add(
    "regress_general_residuals",
    V.with_views(V.TICKS, V.bars(), _HOURS)
    + "SELECT feature, count(*) AS n, TRUE AS orthogonal FROM past,"
    " (SELECT unnest(['constant', 'avg_close', 'previous', 'avg_volume', 'avg_transactions']) AS feature) GROUP BY 1",
)
def regress_general_residuals(spark, sf):
    """Least squares leave residuals that are orthogonal to every feature, to the fit's own
    tolerance of a millionth."""
    train, _ = _past(next_hour(spark, sf))
    fitted = models.regress(train, train, "general")
    residual = F.col("label") - F.col("prediction")
    features = ["constant", "avg_close", "previous", "avg_volume", "avg_transactions"]
    values = fitted.withColumn("constant", F.lit(1.0))
    sums = [
        F.struct(
            F.lit(c).alias("feature"),
            F.count(F.lit(1)).alias("n"),
            (F.abs(F.sum(residual * F.col(c))) <= 1e-6 * F.sum(F.abs(residual * F.col(c)))).alias("orthogonal"),
        )
        for c in features
    ]
    return values.agg(F.array(*sums).alias("s")).select(F.inline("s"))


@book.add("cluster_kmeans_nearest", "SELECT vec_id, TRUE AS nearest FROM embeddings")
def cluster_kmeans_nearest(spark, sf):
    """Every vector is in the cluster whose centre is the nearest to it."""
    rows = _embeddings(spark, sf)
    model = models.CLUSTERERS["kmeans"](5).fit(rows)
    scored = models.as_arrays(model.transform(rows), "features")
    centres = [F.array(*[F.lit(float(x)) for x in c]) for c in model.clusterCenters()]

    def distance(centre):
        gaps = F.zip_with("features", centre, lambda x, y: (x - y) * (x - y))
        return F.aggregate(gaps, F.lit(0.0), lambda a, x: a + x)

    distances = F.array(*[distance(c) for c in centres])
    own = F.element_at("_distances", F.col("prediction") + 1)
    return scored.withColumn("_distances", distances).select(
        "vec_id", (own <= F.array_min("_distances") + 1e-9).alias("nearest")
    )


@book.add(
    "regress_isotonic_order",
    V.with_views(V.TICKS, V.bars(), _HOURS)
    + """SELECT count(*) AS n, TRUE AS ordered, """
    + sql6("avg(label)")
    + " AS mean FROM past",
)
def regress_isotonic_order(spark, sf):
    """Predictions rise with the feature, and their mean is the labels' mean."""
    train, _ = _past(next_hour(spark, sf))
    fitted = models.regress(train, train, "isotonic").select("avg_close", "prediction")
    # predictions per value of the feature, then compared with those of the value before
    steps = fitted.groupBy("avg_close").agg(
        F.min("prediction").alias("low"), F.max("prediction").alias("high"), F.sum("prediction").alias("sum"), F.count(F.lit(1)).alias("n")
    )
    chunks = halo_chunks(number_rows(steps, [], ["avg_close"]), 1)
    before = F.lag("high").over(Window.partitionBy(CHUNK).orderBy(POS))
    marked = chunks.withColumn("_falls", (F.col("low") < before - 1e-9) | (F.col("low") < F.col("high") - 1e-9))
    found = marked.filter(~F.col(WARMUP)).agg(
        F.sum("n").alias("n"),
        (F.coalesce(F.max(F.col("_falls").cast("int")), F.lit(0)) == 0).alias("ordered"),
        (F.sum("sum") / F.sum("n")).alias("mean"),
    )
    return rounded(found, "mean")
