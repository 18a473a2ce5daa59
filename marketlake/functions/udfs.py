"""User-defined functions: scalar, vectorised, aggregate and table-valued.

Built-in functions come first; these show how a user's own Python joins in, one
Arrow batch at a time."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.udtf import AnalyzeArgument, AnalyzeResult, OrderingColumn, PartitioningColumn


# --- scalar -----------------------------------------------------------------------


@F.pandas_udf(T.DoubleType())
def centred_square(values: pd.Series) -> pd.Series:
    """Series to series."""
    return (values - 50.0) ** 2


@F.pandas_udf(T.BooleanType())
def is_high(values: pd.Series) -> pd.Series:
    return values > 100.0


@F.pandas_udf(T.LongType())
def text_lengths(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    """Iterator form: set-up code before the loop runs once per task."""
    for batch in batches:
        yield batch.str.strip().str.len().astype("Int64")


def random_draw():
    """A new number in [0, 1) for every row and every run, a batch at a time."""

    @F.pandas_udf(T.DoubleType())
    def draw(ids: pd.Series) -> pd.Series:
        return pd.Series(np.random.default_rng().random(len(ids)))

    return draw.asNondeterministic()(F.monotonically_increasing_id())


def register_all(spark: SparkSession) -> None:
    """Make the scalar and table functions known to SQL text."""
    spark.udf.register("centred_square", centred_square)
    spark.udf.register("is_high", is_high)
    spark.udtf.register("word_positions", WordPositions)


# --- aggregates ------------------------------------------------------------------------


def moments(df: DataFrame, key: str, value: str) -> DataFrame:
    """(key, n, mean, deviation) by a mergeable state: count, mean and squared distance
    from the mean of the values seen.

    Each Arrow batch gives one state per key it holds; Spark adds the states up, partly
    before the shuffle."""
    kind = df.schema[key].dataType.simpleString()

    def states(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            known = batch.dropna(subset=[value])
            centred = known[value] - known.groupby(key, dropna=False)[value].transform("mean")
            parts = known.assign(apart=centred**2).groupby(key, dropna=False)
            yield parts.agg(n=(value, "size"), mean=(value, "mean"), apart=("apart", "sum")).reset_index()

    parts = df.select(key, value).mapInPandas(
        states, f"`{key}` {kind}, n long, mean double, apart double"
    )
    total = F.sum("n")
    mean = F.sum(F.col("n") * F.col("mean")) / total
    apart = F.sum("apart") + F.sum(F.col("n") * F.col("mean") ** 2) - total * mean**2
    return parts.groupBy(key).agg(
        total.alias("n"),
        mean.alias("mean"),
        F.sqrt(F.greatest(apart, F.lit(0.0)) / total).alias("deviation"),
    )


def typed_aggregates(df: DataFrame, key: str, value: str) -> DataFrame:
    return df.groupBy(key).agg(
        F.sum(value).alias("total"),
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        F.min(value).alias("low"),
        F.max(value).alias("high"),
    )


@F.pandas_udf(T.DoubleType())
def spread(values: pd.Series) -> float:
    """Series to scalar.  Use it on groups known to be small: each group is handed
    over as a whole."""
    return float(values.max() - values.min())


# --- grouped maps -------------------------------------------------------------------------


def standing_in_group(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str]
) -> DataFrame:
    """Grouped map over groups known to be small (the hours of a day): each column's
    distance from the group's median in units of the group's range, and the row's rank by
    the sum of them."""
    names = [f"{c}_standing" for c in columns]
    schema = T.StructType(
        [*df.schema.fields]
        + [T.StructField(n, T.DoubleType()) for n in names]
        + [T.StructField("place", T.LongType())]
    )

    def place(group: pd.DataFrame) -> pd.DataFrame:
        values = group[list(columns)]
        width = (values.max() - values.min()).replace(0.0, 1.0)
        scaled = ((values - values.median()) / width).set_axis(names, axis=1)
        order = scaled.sum(axis=1).round(9).rank(method="min").astype("int64")
        return pd.concat([group, scaled, order.rename("place")], axis=1)

    return df.groupBy(*keys).applyInPandas(place, schema)


def started_steps(df: DataFrame, key: str, column: str, width: float) -> DataFrame:
    """Map over batches, any number of rows out: (key, step) for every step of ``width``
    that a value reaches into, from the first; none for nulls and values up to zero."""

    def steps(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            counts = np.ceil(batch[column].clip(lower=0).fillna(0) / width).astype("int64")
            again = batch.loc[batch.index.repeat(counts), [key]]
            yield again.assign(step=again.groupby(level=0).cumcount() + 1)

    kind = df.schema[key].dataType.simpleString()
    return df.select(key, column).mapInPandas(steps, f"`{key}` {kind}, step long")


def day_on_day(today: DataFrame, before: DataFrame, keys: Sequence[str], on: str, value: str) -> DataFrame:
    """Cogrouped map, again for small groups: both sides of a key meet in one call and are
    compared place by place.  One row per key: places on either side, places they share,
    and the mean change of the value there (null if none)."""
    names = list(keys)
    schema = T.StructType(
        [today.schema[k] for k in names]
        + [T.StructField(c, T.LongType()) for c in ("n_today", "n_before", "n_both")]
        + [T.StructField("mean_change", T.DoubleType())]
    )

    def compare(key: tuple, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        both = a.set_index(on)[value].sub(b.set_index(on)[value]).dropna()
        change = float(both.mean()) if len(both) else None
        return pd.DataFrame(
            [[*key, len(a), len(b), len(both), change]], columns=schema.names
        )

    # columns that both sides have from one frame get names of their own here: the
    # optimizer would prune them on the right
    before = before.toDF(*before.columns)
    return today.groupBy(*names).cogroup(before.groupBy(*names)).applyInPandas(compare, schema)


# --- table function -------------------------------------------------------------------------


@F.udtf(returnType=T.StructType().add("word", "string").add("place", "integer"), useArrow=True)
class WordPositions:
    """One row per word of a text."""

    def eval(self, text: str):
        if text is None:
            return
        for place, word in enumerate(text.split(" ")):
            yield word, place


def word_positions(spark: SparkSession, table: str, key: str, text: str) -> DataFrame:
    spark.udtf.register("word_positions", WordPositions)
    return spark.sql(
        f"SELECT t.{key}, w.word, w.place FROM {table} t, LATERAL word_positions(t.{text}) w"
    )


class MarkSessions:
    """Every row of a table with its session's number and the seconds since the key's row
    before; works on any table that has the named key and time columns.

    SQL: mark_sessions(TABLE(t), 'key', 'time', gap_seconds).  ``analyze`` adds two columns to
    the table's own and asks for its rows by key in the order of time, so a key's rows pass
    through one task, one at a time: memory doesn't grow with them, but a key that owns most
    rows keeps one task busy.  ``operators.sessions`` has no such limit."""

    @staticmethod
    def analyze(table: AnalyzeArgument, key, time, gap_seconds) -> AnalyzeResult:
        names = table.dataType.fieldNames()
        for name in (key.value, time.value):
            if name not in names:
                raise ValueError(f"the table has no column {name}")
        added = [T.StructField("session", T.LongType()), T.StructField("gap", T.DoubleType())]
        return AnalyzeResult(
            schema=T.StructType([*table.dataType.fields, *added]),
            partitionBy=[PartitioningColumn(key.value)],
            orderBy=[OrderingColumn(time.value)],
        )

    def __init__(self):
        self._before, self._session = None, 0

    def eval(self, row, key, time, gap_seconds):
        at = row[time]
        gap = None if self._before is None else (at - self._before).total_seconds()
        if gap is not None and gap >= gap_seconds:
            self._session += 1
        self._before = at
        yield (*row, self._session, gap)


def mark_sessions(spark: SparkSession, table: str, key: str, time: str, gap_seconds: int) -> DataFrame:
    """The rows of a table or view with ``session`` and ``gap``, by the table function."""
    spark.udtf.register("mark_sessions", F.udtf(MarkSessions))
    return spark.sql(f"SELECT * FROM mark_sessions(TABLE({table}), '{key}', '{time}', {gap_seconds})")
