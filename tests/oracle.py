"""Run a query on Spark and its SQL on DuckDB and compare the rows as bags."""

from __future__ import annotations

import datetime as dt
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb


def duck(sf_dir: str):
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, (dt.datetime, dt.date)):
        return str(value)
    if isinstance(value, (list, tuple)):
        return tuple(plain(v) for v in value)
    return value


def differences(df, con, sql: str) -> str | None:
    result = con.execute(sql)
    names = [c[0] for c in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns differ: spark {sorted(df.columns)} sql {sorted(names)}"
    order = sorted(names)
    ours = Counter(tuple(plain(r[c]) for c in order) for r in df.collect())
    theirs = Counter(
        tuple(plain(v) for _, v in sorted(zip(names, row))) for row in result.fetchall()
    )
    if not ours:
        return "no rows"
    if ours == theirs:
        return None
    return (
        f"rows: spark {sum(ours.values())} sql {sum(theirs.values())}\n"
        f"  only spark: {[dict(zip(order, r)) for r in list((ours - theirs))[:3]]}\n"
        f"  only sql:   {[dict(zip(order, r)) for r in list((theirs - ours))[:3]]}"
    )
