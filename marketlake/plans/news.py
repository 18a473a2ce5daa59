"""News articles: first-seen dedup, fan-out to symbols, serving query."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def first_seen(articles: DataFrame, order: list[str]) -> DataFrame:
    """Keep the first fetched copy of every article id.

    ``row_number() = 1`` is trimmed before the shuffle (window group limit), so an
    id with very many copies sends one row per input task."""
    w = Window.partitionBy("id").orderBy(*order)
    return articles.withColumn("_seen", F.row_number().over(w)).filter("_seen = 1").drop("_seen")


def articles_by_symbol(articles: DataFrame) -> DataFrame:
    """One row per (symbol, article), for all symbols at once.

    A null or empty ``tickers`` list yields nothing."""
    return articles.withColumn("symbol", F.explode(F.array_distinct("tickers")))


def of_symbols(rows: DataFrame, symbols: DataFrame) -> DataFrame:
    """The rows of followed symbols."""
    return rows.join(symbols.select("symbol").distinct(), "symbol", "left_semi")


def articles_for(articles: DataFrame, symbol: str) -> DataFrame:
    return articles.filter(F.array_contains("tickers", symbol))


def newest_on_day(articles: DataFrame, symbol: str, day: dt.date, limit: int = 5) -> DataFrame:
    """The newest articles about a symbol published on one UTC day."""
    start = dt.datetime.combine(day, dt.time(), dt.timezone.utc)
    return (
        articles_for(articles, symbol)
        .filter(
            (F.col("published_utc") >= F.lit(start))
            & (F.col("published_utc") < F.lit(start + dt.timedelta(days=1)))
        )
        .orderBy(F.desc("published_utc"), F.desc("id"))
        .limit(limit)
    )
