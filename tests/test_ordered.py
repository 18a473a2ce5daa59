"""Chunked operators against plain pandas, with chunks far smaller than the data."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from marketlake.operators import indicators as ind
from marketlake.operators.asof import asof_join
from marketlake.operators.ordered import POS, fill_forward, halo_chunks, number_rows
from marketlake.operators.sessions import sessions


def prices(n=12_000, hot=0.7):
    """One symbol owns most rows."""
    rng = np.random.default_rng(7)
    symbol = np.where(rng.random(n) < hot, "hot", rng.choice(["a", "b", "c"], n))
    close = 100 + rng.normal(0, 1, n).cumsum()
    ts = pd.Timestamp("2024-01-01", tz="UTC") + pd.to_timedelta(np.arange(n), unit="min")
    return pd.DataFrame({"symbol": symbol, "timestamp": ts, "close": close})


@pytest.fixture(scope="module")
def bars(spark):
    pdf = prices()
    df = spark.createDataFrame(pdf.sample(frac=1, random_state=1)).select(
        "symbol", F.col("timestamp").cast("timestamp"), "close"
    )
    return pdf, ind.number_bars(df)


def check(got, pdf, expected, column):
    got = got.select("symbol", F.unix_millis("timestamp").alias("t"), column).toPandas()
    want = pdf.assign(t=pdf["timestamp"].astype("int64") // 10**6, want=expected)
    unit = str(pdf["timestamp"].dtype)
    if "us" in unit:
        want["t"] = pdf["timestamp"].astype("int64") // 10**3
    both = want.merge(got, on=["symbol", "t"])
    assert len(both) == len(pdf) == len(got)
    np.testing.assert_allclose(both[column], both["want"], rtol=1e-12, atol=1e-9)


def plain_ema(values, alpha):
    out, y = [], None
    for x in values:
        y = x if y is None else alpha * x + (1 - alpha) * y
        out.append(y)
    return pd.Series(out, index=values.index)


def by_symbol(pdf, function):
    return pd.concat([function(g["close"]) for _, g in pdf.groupby("symbol")]).reindex(pdf.index)


def test_positions_are_consecutive_in_key_order(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), (1000 - F.col("id")).alias("o"))
    numbered = number_rows(df, ["k"], ["o"])
    rows = sorted((r[POS], r.k, r.o) for r in numbered.rows.collect())
    assert [r[0] for r in rows] == list(range(1000)) and numbered.count == 1000
    assert [r[1:] for r in rows] == sorted(r[1:] for r in rows)


def test_sma_over_chunk_borders(bars):
    pdf, numbered = bars
    want = by_symbol(pdf, lambda s: s.rolling(20, min_periods=1).mean())
    check(ind.sma(numbered, chunk=50), pdf, want, "value")


def test_ema_over_chunk_borders(bars):
    pdf, numbered = bars
    want = by_symbol(pdf, lambda s: plain_ema(s, 2 / 21))
    check(ind.ema(numbered, chunk=1500), pdf, want, "value")


def test_macd_over_chunk_borders(bars):
    pdf, numbered = bars

    def signal(s):
        return plain_ema(plain_ema(s, 2 / 11) - plain_ema(s, 2 / 41), 2 / 26)

    check(ind.macd(numbered, chunk=2500), pdf, by_symbol(pdf, signal), "signal")


def test_rsi_over_chunk_borders(bars):
    pdf, numbered = bars

    def rsi(s):
        change = s.diff().iloc[1:]
        gain, loss = plain_ema(change.clip(lower=0), 1 / 20), plain_ema((-change).clip(lower=0), 1 / 20)
        return (100 * gain / (gain + loss)).reindex(s.index)

    check(ind.rsi(numbered, chunk=2000), pdf, by_symbol(pdf, rsi), "value")


def test_all_indicators_agree_with_the_single_ones(bars):
    pdf, numbered = bars
    wide = ind.all_indicators(numbered, chunk=2500)
    check(wide, pdf, by_symbol(pdf, lambda s: plain_ema(s, 2 / 21)), "ema")
    check(wide, pdf, by_symbol(pdf, lambda s: s.rolling(20, min_periods=1).mean()), "sma")


def test_flat_price_is_neutral(spark):
    flat = spark.range(5).select(
        F.lit("x").alias("symbol"), F.timestamp_seconds("id").alias("timestamp"), F.lit(5.0).alias("close")
    )
    values = [r.value for r in ind.rsi(ind.number_bars(flat)).orderBy("timestamp").collect()]
    assert values == [None, 50.0, 50.0, 50.0, 50.0]


def test_halo_must_fit_into_a_chunk(bars):
    with pytest.raises(ValueError):
        halo_chunks(bars[1], 100, 50)


def test_fill_forward_over_many_empty_chunks(spark):
    pdf = pd.DataFrame({"k": ["a"] * 500 + ["b"] * 500, "o": list(range(1000))})
    pdf["v"] = [float(i) if i in (10, 300, 900) else None for i in range(1000)]
    df = spark.createDataFrame(pdf).withColumn("v", F.when(~F.isnan("v"), F.col("v")))
    got = fill_forward(number_rows(df, ["k"], ["o"]), ["v"], 20).orderBy("o").toPandas()
    want = pdf.groupby("k")["v"].ffill()
    np.testing.assert_array_equal(got["v"], want)


@pytest.mark.parametrize("direction", ["backward", "forward", "nearest"])
@pytest.mark.parametrize("exact", [True, False])
@pytest.mark.parametrize("tolerance", [None, 5])
def test_asof_equals_pandas(spark, direction, exact, tolerance):
    rng = np.random.default_rng(3)

    def side(n, name):
        t = np.sort(rng.choice(900, n, replace=False))
        k = np.where(rng.random(n) < 0.8, "hot", "cold")
        return pd.DataFrame({"k": k, "t": pd.to_datetime(t, unit="s", utc=True), name: np.arange(n)})

    left, right = side(300, "l"), side(80, "r")
    want = pd.merge_asof(
        left, right, on="t", by="k", direction=direction, allow_exact_matches=exact,
        tolerance=None if tolerance is None else pd.Timedelta(seconds=tolerance),
    )
    got = asof_join(
        spark.createDataFrame(left), spark.createDataFrame(right), "t", ["k"], F.col("l"), F.col("r"),
        direction, tolerance, exact, chunk=25,
    ).orderBy("l").toPandas()
    np.testing.assert_array_equal(got["right_r"].to_numpy(float), want["r"].to_numpy(float))


def test_session_edges(spark):
    rows = [("u", 0), ("u", 1799), ("u", 3599), ("u", 3600 + 1799), ("v", 5)]
    df = spark.createDataFrame([(k, s, i, "x") for i, (k, s) in enumerate(rows)], "u string, s long, event_id long, e string")
    df = df.withColumn("ts", F.timestamp_seconds("s"))
    got = sorted((r.u, r.start.timestamp(), r.events) for r in sessions(df, "u", 1800, chunk=2).collect())
    # 3599 is exactly one gap after 1799: a new session, as session_window has it
    assert [g[2] for g in got] == [2, 1, 1, 1]
    one = df.filter("u = 'u'")
    assert [r.events for r in sessions(one, "u", 1801, chunk=2).collect()] == [4]
    closed = sessions(one, "u", 10_000, F.col("s") == 1799, chunk=2).orderBy("start").collect()
    assert [(r.events, r.closed) for r in closed] == [(2, True), (2, False)]
