"""Position on a space-filling (Z-order) curve, as a Column.

Each column's value becomes its rank among 2^bits quantiles of the column, so that skewed and
clustered values spread over all ranks; the bits of the ranks are interleaved, the most
significant first.  Rows that are near each other in all columns then lie near each other on
the curve, and files cut from it have narrow ranges in every column."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS = 8
_HEAD = 7  # bytes of a text that fit a long
_ACCURACY = 10_000


def as_number(df: DataFrame, name: str) -> Column:
    """An order-preserving number: texts by their first bytes, times in microseconds."""
    kind, column = df.schema[name].dataType, F.col(name)
    if isinstance(kind, (T.StringType, T.BinaryType)):
        head = F.rpad(F.hex(F.substring(column.cast("binary"), 1, _HEAD)), 2 * _HEAD, "0")
        return F.conv(head, 16, 10).cast("long")
    if isinstance(kind, T.DateType):
        return F.datediff(column, F.lit("1970-01-01").cast("date")).cast("long")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column)
    if isinstance(kind, T.TimestampNTZType):
        return F.unix_micros(column.cast("timestamp"))
    if isinstance(kind, T.BooleanType):
        return column.cast("long")
    if isinstance(kind, T.NumericType):
        return column.cast("double") if isinstance(kind, (T.FloatType, T.DoubleType, T.DecimalType)) else column.cast("long")
    raise TypeError(f"no order for {name} {kind.simpleString()}")


def rank(value: Column, borders: Sequence, bits: int) -> Column:
    """How many of the 2^bits - 1 ascending borders are below the value, by binary search;
    nulls come first."""
    table = F.array(*[F.lit(b) for b in borders])
    steps = F.array(*[F.lit(1 << b) for b in range(bits - 1, -1, -1)])
    found = F.aggregate(
        steps,
        F.lit(0),
        lambda at, step: at + F.when(F.element_at(table, at + step) < value, step).otherwise(F.lit(0)),
    )
    return F.when(value.isNull(), F.lit(0)).otherwise(found)


def interleaved(ranks: Sequence[Column], bits: int) -> Column:
    out = F.lit(0).cast("long")
    for bit in range(bits - 1, -1, -1):
        for r in ranks:
            one = F.shiftright(r.cast("long"), bit).bitwiseAND(F.lit(1))
            out = F.shiftleft(out, 1).bitwiseOR(one)
    return out


def curve(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> Column:
    """The curve's position over ``columns`` (at most 63 / bits of them).  One pass makes a
    quantile sketch of each; 2^bits borders a column reach the driver."""
    if len(columns) * bits > 63:
        raise ValueError(f"{len(columns)} columns of {bits} bits don't fit a position")
    numbers = [as_number(df, c) for c in columns]
    shares = [k / (1 << bits) for k in range(1, 1 << bits)]
    borders = df.agg(
        *[F.percentile_approx(v, shares, _ACCURACY).alias(f"b{i}") for i, v in enumerate(numbers)]
    ).first()
    ranks = [
        F.lit(0) if borders[i] is None else rank(v, borders[i], bits)
        for i, v in enumerate(numbers)
    ]
    return interleaved(ranks, bits)
