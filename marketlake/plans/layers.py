"""Bronze to silver to gold to serving, each layer one job over all symbols.

A layer takes what has changed in the one below since it last did: its own commits note the
versions it has consumed, in the same atomic step as the rows made from them.  So a run after
one new day reads and rewrites that day, and a failed run is simply repeated."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.functions.columns import millis_to_timestamp
from marketlake.operators import indicators as ind
from marketlake.plans import tables
from marketlake.plans.gold import build_gold, gold_since, news_of_hours, with_news_again
from marketlake.plans.news import articles_by_symbol
from marketlake.plans.serving import SERVING_DAYS, front_end, since
from marketlake.session import cut_lineage
from marketlake.sources.lake import LakeTable, differing


class MissingTable(LookupError):
    pass


def stamped(df: DataFrame, at: dt.datetime | None = None) -> DataFrame:
    """Audit column; the run's own time unless the caller fixes it."""
    return df.withColumn("updated_at", F.lit(at) if at else F.current_timestamp())


def _need(spark: SparkSession, table: LakeTable) -> DataFrame:
    rows = table.read(spark)
    if rows is None:
        raise MissingTable(table.path)
    return rows.drop(*table.partitions)


def bronze(root: str, prices: DataFrame, indicators: DataFrame, at: dt.datetime) -> None:
    """Replicate the serving store's tables into the lake."""
    tables.price_table(root, "bronze").merge(stamped(prices, at))
    tables.indicator_table(root, "bronze").merge(stamped(indicators, at))


def bronze_news(root: str, articles: DataFrame, at: dt.datetime, keep_versions: bool = False) -> None:
    table = tables.news_versions_table(root) if keep_versions else tables.news_table(root, "bronze")
    table.merge(stamped(articles, at))


def feed(
    spark: SparkSession, source: LakeTable, target: LakeTable
) -> tuple[DataFrame | None, dict[str, int]]:
    """(rows of ``source`` that ``target`` hasn't taken yet or None, the version to note)."""
    version = source.state(spark).version
    if version == 0:
        raise MissingTable(source.path)
    name = "/".join(source.path.split("/")[-2:])
    since = target.state(spark).consumed.get(name, 0)
    rows = source.changed(spark, since, version)
    return (None if rows is None else rows.drop(*source.partitions)), {name: version}


def silver(spark: SparkSession, root: str, at: dt.datetime) -> None:
    """Epoch milliseconds become timestamps."""
    for table in (tables.price_table, tables.indicator_table):
        target = table(root, "silver")
        rows, consumed = feed(spark, table(root, "bronze"), target)
        if rows is not None:
            timed = rows.withColumn("timestamp", millis_to_timestamp("timestamp"))
            target.merge(stamped(timed, at), consumed=consumed)


def silver_news(spark: SparkSession, root: str, at: dt.datetime) -> None:
    target = tables.news_table(root, "silver")
    articles, consumed = feed(spark, tables.news_table(root, "bronze"), target)
    if articles is not None:
        target.merge(stamped(articles_by_symbol(articles), at), consumed=consumed)


def indicators_from_bars(spark: SparkSession, root: str) -> DataFrame:
    """Indicators computed from silver prices, for lakes without an indicator feed."""
    bars = ind.number_bars(_need(spark, tables.price_table(root, "silver")).select("symbol", "timestamp", "close"))
    return ind.long_form(ind.all_indicators(bars))


def _first_hour(*feeds: DataFrame | None) -> dt.datetime | None:
    """Earliest hour among the changed rows."""
    found = [
        rows.agg(F.unix_timestamp(F.date_trunc("hour", F.min("timestamp")))).first()[0]
        for rows in feeds
        if rows is not None
    ]
    hours = [s for s in found if s is not None]
    return dt.datetime.fromtimestamp(min(hours), dt.timezone.utc) if hours else None


def gold(spark: SparkSession, root: str, at: dt.datetime) -> None:
    """Features from the first changed hour on, and the hours whose articles have changed;
    only rows that come out differently are merged."""
    target = tables.gold_table(root)
    sources = [
        tables.price_table(root, "silver"),
        tables.indicator_table(root, "silver"),
        tables.news_table(root, "silver"),
    ]
    feeds = [feed(spark, source, target) for source in sources]
    if all(rows is None for rows, _ in feeds):
        return
    consumed = {name: version for _, note in feeds for name, version in note.items()}
    prices, indicators, articles = (_need(spark, source) for source in sources)
    known = target.read(spark)
    if known is None:
        articles = news_of_hours(articles, prices)
        features = build_gold(prices, indicators, articles)
        return target.merge(stamped(features, at), consumed=consumed)
    (new_prices, _), (new_indicators, _), (new_articles, _) = feeds
    start = _first_hour(new_prices, new_indicators)
    parts = []
    if start is not None:
        near = news_of_hours(articles, prices.filter(F.col("timestamp") >= F.lit(start)))
        parts.append(gold_since(prices, indicators, near, known, start))
    if new_articles is not None:
        hour = F.date_trunc("hour", "published_utc").alias("timestamp")
        touched = new_articles.select("symbol", hour).distinct()
        if start is not None:
            touched = touched.filter(F.col("timestamp") < F.lit(start))
        parts.append(with_news_again(known, articles, cut_lineage(touched)))
    features = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    made = differing(features, known, target.keys)
    target.merge(stamped(made, at), consumed=consumed)


def serving(spark: SparkSession, root: str, at: dt.datetime) -> None:
    """Full refresh of the table the front end reads."""
    recent = since(_need(spark, tables.gold_table(root)), at, SERVING_DAYS)
    tables.serving_table(root).create(front_end(recent, F.lit(at)))


def store_forecasts(root: str, scored: DataFrame, at: dt.datetime) -> None:
    """Predicted closes (symbol, timestamp, prediction) of the hour that follows."""
    rows = scored.select(
        "symbol",
        (F.col("timestamp") + F.expr("INTERVAL 1 HOUR")).alias("timestamp"),
        F.col("prediction").alias("close"),
    )
    tables.forecast_table(root).merge(stamped(rows, at))


def forecasts_of(spark: SparkSession, root: str, symbol: str) -> DataFrame:
    rows = _need(spark, tables.forecast_table(root)).filter(F.col("symbol") == symbol)
    return rows.select("timestamp", "close").orderBy("timestamp")


def run_layers(
    spark: SparkSession,
    root: str,
    prices: DataFrame,
    indicators: DataFrame,
    articles: DataFrame,
    at: dt.datetime,
) -> None:
    """All layers in order; the first failure stops the run."""
    bronze(root, prices, indicators, at)
    bronze_news(root, articles, at)
    silver(spark, root, at)
    silver_news(spark, root, at)
    gold(spark, root, at)
    serving(spark, root, at)
