"""Hourly feature table: price means, indicator means, news, filled forward."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.plans.serving import latest_per_symbol
from marketlake.schemas import INDICATORS

PRICE_COLUMNS = [
    "open",
    "high",
    "low",
    "close",
    "volume",
    "volume_weighted",
    "transactions",
]
FEATURES = [f"avg_{c}" for c in PRICE_COLUMNS + INDICATORS]
NO_NEWS = "NoNews"


def _hour(column: str):
    return F.window(column, "1 hour").alias("w")


def hourly_prices(prices: DataFrame) -> DataFrame:
    return (
        prices.groupBy("symbol", _hour("timestamp"))
        .agg(*[F.avg(c).alias(f"avg_{c}") for c in PRICE_COLUMNS])
        .select("symbol", F.col("w.start").alias("timestamp"), *[f"avg_{c}" for c in PRICE_COLUMNS])
    )


def hourly_indicators(indicators: DataFrame) -> DataFrame:
    """Long-form indicators to one row per symbol and hour, one column each."""
    pivoted = (
        indicators.groupBy("symbol", _hour("timestamp"))
        .pivot("indicator", INDICATORS)
        .agg(F.avg("value"))
    )
    return pivoted.select(
        "symbol",
        F.col("w.start").alias("timestamp"),
        *[F.col(i).alias(f"avg_{i}") for i in INDICATORS],
    )


def hourly_features(prices: DataFrame, indicators: DataFrame) -> DataFrame:
    """``hourly_prices`` left-joined with ``hourly_indicators``, as one aggregate.

    Both inputs are stacked into a common layout and averaged together, so the
    only shuffle moves hourly partial sums.  Hours without a price row go away,
    which is what the left join from prices would do."""
    stacked = prices.select("symbol", "timestamp", *PRICE_COLUMNS, F.lit(1).alias("_priced")).unionByName(
        indicators.select(
            "symbol",
            "timestamp",
            *[F.when(F.col("indicator") == i, F.col("value")).alias(i) for i in INDICATORS],
        ),
        allowMissingColumns=True,
    )
    return (
        stacked.groupBy("symbol", _hour("timestamp"))
        .agg(
            *[F.avg(c).alias(f"avg_{c}") for c in PRICE_COLUMNS + INDICATORS],
            F.count("_priced").alias("_priced"),
        )
        .filter("_priced > 0")
        .select("symbol", F.col("w.start").alias("timestamp"), *FEATURES)
    )


def hourly_news(news: DataFrame) -> DataFrame:
    """Descriptions per symbol and hour in publication order.

    ``news`` has one row per (symbol, article).  Its hour is named before the texts are dealt
    out, so that a join on symbol and hour finds them where they are."""
    entry = F.struct("published_utc", "id", "description")
    return (
        news.select("symbol", F.window("published_utc", "1 hour")["start"].alias("timestamp"), entry.alias("entry"))
        .groupBy("symbol", "timestamp")
        .agg(F.array_sort(F.collect_list("entry")).alias("entries"))
        .select("symbol", "timestamp", F.col("entries.description").alias("news_descriptions"))
    )


def news_of_hours(news: DataFrame, hours: DataFrame) -> DataFrame:
    """The articles from the first to the last hour in which ``hours`` has a ``timestamp``; the
    others meet no feature and would only be dealt out."""
    first, last = hours.agg(*[F.unix_micros(f("timestamp")) for f in (F.min, F.max)]).first()
    if first is None:
        return news.limit(0)
    hour = 3_600_000_000
    start, end = (F.timestamp_micros(F.lit(h * hour)) for h in (first // hour, last // hour + 1))
    return news.filter((F.col("published_utc") >= start) & (F.col("published_utc") < end))


def dense_hours(features: DataFrame) -> DataFrame:
    """Optional spine: every hour between a symbol's first and last price hour."""
    spine = (
        features.groupBy("symbol")
        .agg(F.min("timestamp").alias("first"), F.max("timestamp").alias("last"))
        .select("symbol", F.explode(F.expr("sequence(first, last, interval 1 hour)")).alias("timestamp"))
    )
    return spine.join(features, ["symbol", "timestamp"], "left")


def fill_hours(features: DataFrame) -> DataFrame:
    """Carry the last known value forward within a symbol.

    The input has one row per symbol and hour, so a symbol has fewer than 9,000
    rows a year however many ticks it had; a window per symbol is safe here."""
    so_far = Window.partitionBy("symbol").orderBy("timestamp")
    filled = {c: F.last(c, ignorenulls=True).over(so_far) for c in FEATURES}
    return features.withColumns(filled)


def finish_gold(filled: DataFrame, news: DataFrame) -> DataFrame:
    """Drop hours before all indicators exist, attach the news or its default."""
    complete = filled.na.drop(subset=[f"avg_{i}" for i in INDICATORS])
    return complete.join(hourly_news(news), ["symbol", "timestamp"], "left").withColumn(
        "news_descriptions", F.coalesce("news_descriptions", F.array(F.lit(NO_NEWS)))
    )


def build_gold(
    prices: DataFrame, indicators: DataFrame, news: DataFrame, dense: bool = False
) -> DataFrame:
    features = hourly_features(prices, indicators)
    if dense:
        features = dense_hours(features)
    return finish_gold(fill_hours(features), news)


def gold_since(
    prices: DataFrame,
    indicators: DataFrame,
    news: DataFrame,
    known: DataFrame,
    start: dt.datetime,
) -> DataFrame:
    """The rows of ``build_gold`` from the hour ``start`` on, given the table's rows before it.

    What the fill carries over the border stands in each symbol's last complete row; only
    symbols without one are read from their beginning."""
    at = F.lit(start)
    recent = hourly_features(
        prices.filter(F.col("timestamp") >= at), indicators.filter(F.col("timestamp") >= at)
    )
    complete = known.filter(F.col("timestamp") < at)
    carried = latest_per_symbol(complete.select("symbol", "timestamp", *FEATURES), 1)
    begun = recent.select("symbol").distinct().join(carried, "symbol", "left_anti")
    hours = recent.unionByName(carried)
    if not begun.isEmpty():
        early = [
            rows.filter(F.col("timestamp") < at).join(begun, "symbol", "left_semi")
            for rows in (prices, indicators)
        ]
        hours = hours.unionByName(hourly_features(*early))
    filled = fill_hours(hours).filter(F.col("timestamp") >= at)
    return finish_gold(filled, news.filter(F.col("published_utc") >= at))


def with_news_again(known: DataFrame, news: DataFrame, touched: DataFrame) -> DataFrame:
    """The table's rows at the touched (symbol, timestamp) hours, with their articles anew."""
    rows = known.join(touched, ["symbol", "timestamp"], "left_semi").select(
        "symbol", "timestamp", *FEATURES
    )
    hour = F.date_trunc("hour", "published_utc")
    there = news_of_hours(news, rows).withColumn("timestamp", hour)
    there = there.join(touched, ["symbol", "timestamp"], "left_semi")
    return finish_gold(rows, there.drop("timestamp"))
