"""Feature assembly, selection and model training with Spark ML."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.ml import Pipeline
from pyspark.ml import classification as C
from pyspark.ml import clustering as K
from pyspark.ml import feature as X
from pyspark.ml import regression as R
from pyspark.ml.evaluation import (
    BinaryClassificationEvaluator,
    ClusteringEvaluator,
    MulticlassClassificationEvaluator,
    RegressionEvaluator,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.recommendation import ALS
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder, TrainValidationSplit
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketlake.operators import inner_products
from marketlake.operators.similarity import gram
from marketlake.operators.stats import hash_share
from marketlake.session import cut_by_key

# --- assembling features ------------------------------------------------------------


def assembled(df: DataFrame, columns: Sequence[str], output: str = "features") -> DataFrame:
    return X.VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid="skip").transform(df)


def encoded(df: DataFrame, numbers: Sequence[str], category: str) -> DataFrame:
    """Index and one-hot a category, assemble and size-check the vector, index its
    low-cardinality slots, slice out the numbers, expand them to degree two and
    cross them with the category."""
    width = len(numbers)
    stages = [
        X.Imputer(inputCols=list(numbers), outputCols=list(numbers)),
        X.StringIndexer(inputCol=category, outputCol="category_index", handleInvalid="keep"),
        X.IndexToString(inputCol="category_index", outputCol="category_back"),
        X.OneHotEncoder(inputCol="category_index", outputCol="category_slots"),
        X.VectorAssembler(inputCols=list(numbers), outputCol="numbers"),
        X.VectorSizeHint(inputCol="numbers", size=width, handleInvalid="skip"),
        X.VectorAssembler(inputCols=["numbers", "category_index"], outputCol="joined"),
        X.VectorIndexer(inputCol="joined", outputCol="indexed", maxCategories=8, handleInvalid="keep"),
        X.VectorSlicer(inputCol="joined", outputCol="sliced", indices=list(range(width))),
        X.PolynomialExpansion(inputCol="sliced", outputCol="expanded", degree=2),
        X.Interaction(inputCols=["numbers", "category_slots"], outputCol="crossed"),
    ]
    known = X.StringIndexer(inputCol=category, outputCol="_").fit(df)
    # IndexToString reads its labels from the indexed column's metadata
    stages[2].setLabels([*known.labels, "__unknown"])
    return Pipeline(stages=stages).fit(df).transform(df)


def formula(df: DataFrame, text: str) -> DataFrame:
    return X.RFormula(formula=text).fit(df).transform(df)


def derived(df: DataFrame, statement: str) -> DataFrame:
    """A SELECT over ``__THIS__``, as one more feature step."""
    return X.SQLTransformer(statement=statement).transform(df)


# --- reducing and selecting -----------------------------------------------------------


def principal_components(df: DataFrame, k: int) -> DataFrame:
    model = X.PCA(k=k, inputCol="features", outputCol="components").fit(df)
    return model.transform(df)


def singular_values(df: DataFrame, column: str, k: int) -> list[float]:
    """From the gram matrix, width x width whatever the rows."""
    cells = gram(df, column).collect()
    width = 1 + max((r["j"] for r in cells), default=-1)
    matrix = np.zeros((width, width))
    for r in cells:
        matrix[r["i"], r["j"]] = matrix[r["j"], r["i"]] = r["dot"]
    roots = np.sqrt(np.maximum(np.linalg.eigvalsh(matrix)[::-1], 0))
    return [float(v) for v in roots[:k]]


SELECTORS = {
    "variance": lambda p: X.VarianceThresholdSelector(featuresCol="features", outputCol="selected", **p),
    "chi_square": lambda p: X.ChiSqSelector(featuresCol="features", labelCol="label", outputCol="selected", **p),
    "univariate": lambda p: X.UnivariateFeatureSelector(featuresCol="features", labelCol="label", outputCol="selected", **p)
    .setFeatureType("continuous")
    .setLabelType("categorical"),
}


def selected(df: DataFrame, method: str, **params) -> DataFrame:
    return SELECTORS[method](params).fit(df).transform(df)


def cosine_transformed(df: DataFrame) -> DataFrame:
    return X.DCT(inputCol="features", outputCol="transformed").transform(df)


def weighted(df: DataFrame, weights: Sequence[float]) -> DataFrame:
    return X.ElementwiseProduct(
        scalingVec=Vectors.dense(list(weights)), inputCol="features", outputCol="weighted"
    ).transform(df)


# --- training --------------------------------------------------------------------------


def _perceptron(p):
    width, classes = p.pop("width"), p.pop("classes", 2)
    return C.MultilayerPerceptronClassifier(layers=[width, 8, classes], maxIter=30, seed=1, **p)


CLASSIFIERS = {
    "logistic": lambda p: C.LogisticRegression(**{"maxIter": 20, "regParam": 0.01, "elasticNetParam": 0.5, **p}),
    "multinomial": lambda p: C.LogisticRegression(**{"maxIter": 20, "family": "multinomial", **p}),
    "svm": lambda p: C.LinearSVC(**{"maxIter": 20, **p}),
    "tree": lambda p: C.DecisionTreeClassifier(**{"seed": 1, **p}),
    "forest": lambda p: C.RandomForestClassifier(**{"numTrees": 10, "seed": 1, **p}),
    "boosted": lambda p: C.GBTClassifier(**{"maxIter": 5, "seed": 1, **p}),
    "bayes": lambda p: C.NaiveBayes(**{"modelType": "gaussian", **p}),
    "perceptron": _perceptron,
    "one_vs_rest": lambda p: C.OneVsRest(classifier=C.LogisticRegression(maxIter=10), **p),
    "factorisation": lambda p: C.FMClassifier(**{"maxIter": 20, "stepSize": 0.01, "seed": 1, **p}),
}

REGRESSORS = {
    "linear": lambda p: R.LinearRegression(**{"maxIter": 20, "regParam": 0.01, "elasticNetParam": 0.5, **p}),
    "general": lambda p: R.GeneralizedLinearRegression(**{"family": "gaussian", "maxIter": 20, **p}),
    "tree": lambda p: R.DecisionTreeRegressor(**{"seed": 1, **p}),
    "forest": lambda p: R.RandomForestRegressor(**{"numTrees": 10, "seed": 1, **p}),
    "boosted": lambda p: R.GBTRegressor(**{"maxIter": 5, "seed": 1, **p}),
    "isotonic": lambda p: R.IsotonicRegression(**p),
    "survival": lambda p: R.AFTSurvivalRegression(**{"censorCol": "censor", "maxIter": 20, **p}),
    "factorisation": lambda p: R.FMRegressor(**{"maxIter": 20, "stepSize": 0.01, "seed": 1, **p}),
}


def split_by_hash(df: DataFrame, key: str, train: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """The same rows train in every run, whatever the partitioning."""
    share = hash_share(key)
    return df.filter(share < train), df.filter(share >= train)


def split_by_time(df: DataFrame, column: str, at) -> tuple[DataFrame, DataFrame]:
    """Train on the past, test on what follows."""
    return df.filter(F.col(column) < at), df.filter(F.col(column) >= at)


def classify(train: DataFrame, rows: DataFrame, algorithm: str, **params) -> DataFrame:
    """Rows scored by a model of the training rows.  Input: ``features``, ``label``."""
    return CLASSIFIERS[algorithm](dict(params)).fit(train).transform(rows)


def classification_metrics(scored: DataFrame) -> dict[str, float]:
    metrics = {
        m: MulticlassClassificationEvaluator(metricName=m).evaluate(scored)
        for m in ("accuracy", "f1", "weightedPrecision", "weightedRecall")
    }
    if "rawPrediction" in scored.columns and scored.select("label").distinct().count() == 2:
        metrics["area_roc"] = BinaryClassificationEvaluator().evaluate(scored)
    return metrics


def training_history(train: DataFrame) -> list[float]:
    """Loss per round of a logistic fit."""
    return list(CLASSIFIERS["logistic"]({}).fit(train).summary.objectiveHistory)


def regress(train: DataFrame, rows: DataFrame, algorithm: str, **params) -> DataFrame:
    return REGRESSORS[algorithm](dict(params)).fit(train).transform(rows)


def regression_metrics(scored: DataFrame) -> dict[str, float]:
    return {m: RegressionEvaluator(metricName=m).evaluate(scored) for m in ("rmse", "mae", "r2")}


CLUSTERERS = {
    "kmeans": lambda k: K.KMeans(k=k, seed=1, maxIter=10),
    "bisecting": lambda k: K.BisectingKMeans(k=k, seed=1, maxIter=10),
    "mixture": lambda k: K.GaussianMixture(k=k, seed=1, maxIter=5),
}


def cluster(df: DataFrame, algorithm: str, k: int) -> DataFrame:
    """Rows with their ``prediction``."""
    return CLUSTERERS[algorithm](k).fit(df).transform(df)


def silhouette(scored: DataFrame) -> float:
    return ClusteringEvaluator().evaluate(scored)


def power_iteration(edges: DataFrame, rounds: int = 10, seed: int = 1) -> DataFrame:
    """(id, x) after rounds over undirected edges (src, dst, weight): a vertex takes the weighted
    mean of its neighbours, and all are scaled so that the mean of abs(x) is 1.  x begins as a
    normal number drawn from the hash of the vertex.  Stops early once x moves as much as it did
    in the round before."""

    def drawn(salt: int) -> Column:
        return (F.pmod(F.xxhash64("id", F.lit(seed), F.lit(salt)), F.lit(1 << 32)) + 0.5) / float(1 << 32)

    sides = F.array(F.struct("src", "dst"), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")))
    both = edges.select(F.explode(F.array_distinct(sides)).alias("e"), "weight").select("e.*", "weight")
    links = cut_by_key(both, "src")
    normal = F.sqrt(-2 * F.log(drawn(0))) * F.cos(2 * math.pi * drawn(1))
    state = cut_by_key(links.select(F.col("src").alias("id")).distinct().withColumn("x", normal), "id")
    n, scale = state.agg(F.count(F.lit(1)), F.avg(F.abs("x"))).first()
    state = state.withColumn("x", F.col("x") / F.lit(scale or 1.0))
    moved = 0.0
    for _ in range(rounds):
        taken = (
            links.join(state.select(F.col("id").alias("src"), "x"), "src")
            .groupBy(F.col("dst").alias("id"))
            .agg((F.sum(F.col("weight") * F.col("x")) / F.sum("weight")).alias("x"))
        )
        held = cut_by_key(taken.join(state.withColumnRenamed("x", "old"), "id"), "id")
        scale = held.agg(F.avg(F.abs("x"))).first()[0] or 1.0
        step = held.withColumn("x", F.col("x") / F.lit(scale))
        before, moved = moved, step.agg(F.avg(F.abs(F.col("x") - F.col("old")))).first()[0] or 0.0
        state = step.select("id", "x")
        if abs(moved - before) < max(1e-5 / max(n, 1), 1e-8):
            break
    return state


def cluster_graph(edges: DataFrame, k: int) -> DataFrame:
    """(id, cluster) by power iteration over weighted edges (src, dst, weight).  Edges stay in
    joins that can spill; no graph is held in memory."""
    points = power_iteration(edges).withColumn("features", array_to_vector(F.array("x")))
    found = K.KMeans(k=k, seed=1, maxIter=20).fit(points).transform(points)
    return found.select("id", F.col("prediction").alias("cluster"))


def factor_model(ratings: DataFrame, rank: int = 8, rounds: int = 5) -> ALS:
    return ALS(
        userCol="user",
        itemCol="item",
        ratingCol="rating",
        rank=rank,
        maxIter=rounds,
        regParam=0.1,
        seed=1,
        coldStartStrategy="drop",
    ).fit(ratings)


def recommendations(ratings: DataFrame, top: int) -> DataFrame:
    """(user, item, score, place): the best of all items for each user."""
    model = factor_model(ratings)
    return inner_products.largest(model.userFactors, model.itemFactors, top)


def recommendation_error(train: DataFrame, test: DataFrame) -> float:
    scored = factor_model(train).transform(test)
    return RegressionEvaluator(labelCol="rating", predictionCol="prediction").evaluate(scored)


# --- choosing -----------------------------------------------------------------------------


def _grid(model):
    return ParamGridBuilder().addGrid(model.regParam, [0.1, 0.01]).addGrid(model.elasticNetParam, [0.0, 0.5]).build()


def cross_validated(train: DataFrame, test: DataFrame, folds: int = 2) -> tuple[DataFrame, list[float]]:
    """Best logistic model of a small grid by k-fold validation, with the mean
    metric of every candidate."""
    model = C.LogisticRegression(maxIter=10)
    search = CrossValidator(
        estimator=Pipeline(stages=[model]),
        estimatorParamMaps=_grid(model),
        evaluator=BinaryClassificationEvaluator(),
        numFolds=folds,
        seed=1,
        parallelism=2,
    ).fit(train)
    return search.transform(test), list(search.avgMetrics)


def split_validated(train: DataFrame, test: DataFrame) -> tuple[DataFrame, list[float]]:
    model = R.LinearRegression(maxIter=10)
    search = TrainValidationSplit(
        estimator=model,
        estimatorParamMaps=_grid(model),
        evaluator=RegressionEvaluator(),
        trainRatio=0.8,
        seed=1,
        parallelism=2,
    ).fit(train)
    return search.transform(test), list(search.validationMetrics)


def as_vectors(df: DataFrame, column: str, output: str = "features") -> DataFrame:
    return df.withColumn(output, array_to_vector(F.col(column).cast("array<double>")))


def as_arrays(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: vector_to_array(c) for c in columns})
