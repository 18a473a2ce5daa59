"""As-of join: each left row meets the closest right row in time.

Both sides are stacked, sorted by (key, time), and the last right row seen is
carried forward (``ordered.fill_forward``).  Work grows with the number of rows,
never with the number of pairs, and a hot key is spread over many tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.operators.ordered import fill_forward, number_rows

_TIME, _SIDE, _TIE, _LEFT, _MATCH = "_time", "_side", "_tie", "_left", "_match"


def _instant(df: DataFrame, on: str) -> Column:
    """Timestamps as microseconds; whole numbers order themselves."""
    if df.schema[on].dataType.typeName() in ("timestamp", "timestamp_ntz"):
        return F.unix_micros(F.col(on).cast("timestamp"))
    return F.col(on).cast("bigint")


def _one_way(
    left: DataFrame,
    right: DataFrame,
    on: str,
    keys: Sequence[str],
    ties: tuple[Column, Column],
    forward: bool,
    exact: bool,
    chunk: int | None,
) -> DataFrame:
    """``left`` plus ``_match``, the struct of the right row found in one direction."""
    sign = -1 if forward else 1
    left_time, right_time = (
        (_instant(side, on) * sign).alias(_TIME) for side in (left, right)
    )
    # at equal times the right row has to pass first, unless it must not count
    left_rank, right_rank = (1, 0) if exact else (0, 1)
    left_rows = left.select(
        *keys, left_time, F.lit(left_rank).alias(_SIDE), ties[0].alias(_TIE),
        F.struct(*left.columns).alias(_LEFT),
    )
    right_rows = right.select(
        *keys, right_time, F.lit(right_rank).alias(_SIDE), (ties[1] * sign).alias(_TIE),
        F.struct(*right.columns).alias(_MATCH),
    )
    stacked = left_rows.unionByName(right_rows, allowMissingColumns=True)
    numbered = number_rows(stacked, keys, [_TIME, _SIDE, _TIE])
    return (
        fill_forward(numbered, [_MATCH], chunk)
        .filter(F.col(_LEFT).isNotNull())
        .select(f"{_LEFT}.*", _MATCH)
    )


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: str,
    keys: Sequence[str],
    left_tie: Column,
    right_tie: Column,
    direction: str = "backward",
    tolerance: float | None = None,
    exact: bool = True,
    prefix: str = "right_",
    chunk: int | None = None,
) -> DataFrame:
    """Left rows with the columns of their match, named with ``prefix``.

    ``direction``: backward (latest right row not after), forward (earliest not
    before) or nearest (the closer one; backward wins a draw).  ``exact=False``
    ignores right rows at the very same time.  A match farther away than the
    tolerance (seconds, or units of a numeric ``on``) is dropped.  The numeric tie columns make repeated times orderly:
    of several right rows at one time the highest tie is taken going backward and
    the lowest going forward."""
    ties = (left_tie, right_tie)
    ways = {"backward": [False], "forward": [True], "nearest": [False, True]}[direction]
    found, names = left, []
    for forward in ways:
        found = _one_way(found, right, on, keys, ties, forward, exact, chunk)
        name = "_after" if forward else "_before"
        found = found.withColumnRenamed(_MATCH, name)
        names.append(name)

    timed = left.schema[on].dataType.typeName().startswith("timestamp")

    def distance(name: str) -> Column:
        if timed:
            return F.abs(F.unix_micros(F.col(name)[on]) - F.unix_micros(on))
        return F.abs(F.col(name)[on] - F.col(on))

    if len(names) == 2:
        before, after = names
        closer = F.col(before).isNull() | (distance(after) < distance(before))
        match = F.when(closer, F.col(after)).otherwise(F.col(before))
        match = F.coalesce(match, F.col(before))
    else:
        match = F.col(names[0])
    found = found.withColumn(_MATCH, match)
    if tolerance is not None:
        near = distance(_MATCH) <= int(tolerance * (1_000_000 if timed else 1))
        found = found.withColumn(_MATCH, F.when(near, F.col(_MATCH)))
    added = [c for c in right.columns if c not in keys]
    return found.select(
        *left.columns, *[F.col(_MATCH)[c].alias(f"{prefix}{c}") for c in added]
    )
