"""A registered query: the Spark callable and, where SQL can say it, its oracle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


class Book:
    """Queries of one area, in the order they were registered."""

    def __init__(self):
        self.queries: dict[str, Query] = {}

    def add(self, name: str, sql: str | None = None):
        def register(run):
            if name in self.queries:
                raise ValueError(f"query {name} is registered twice")
            self.queries[name] = Query(run, sql)
            return run

        return register


# The nudge settles ties: a mean that ends in exactly ...5 is a hair above or
# below it depending on the order of the additions.
def r6(column: Column | str) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.round(column + F.lit(1e-9), 6) + F.lit(0.0)


def sql6(expression: str) -> str:
    return f"(ROUND(CAST({expression} AS DOUBLE) + 1e-9, 6) + 0.0)"


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: r6(c) for c in columns})


def millis(df: DataFrame, *columns: str) -> DataFrame:
    """Timestamps as epoch milliseconds, which both engines print alike."""
    return df.withColumns({c: F.unix_millis(c) for c in columns})
