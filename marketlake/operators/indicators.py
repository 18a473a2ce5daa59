"""Technical indicators over bars: SMA, EMA, MACD, RSI.

All work on chunks of consecutive bars (see ``ordered``), never on "all bars of
one symbol", so one dominant symbol is spread over many tasks.

The exponential averages are recursive, but they forget: after ``m`` bars the
starting value keeps a weight of ``(1 - alpha) ** m``.  A chunk that begins with a
warm-up of bars from the previous chunk therefore reproduces the recursion to the
last bit of a double once that weight is below 2**-60, and the very first bar of
a symbol is the true seed."""

from __future__ import annotations

import math
from collections.abc import Iterable
from dataclasses import replace

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketlake.operators.ordered import (
    CHUNK,
    POS,
    WARMUP,
    Numbered,
    halo_chunks,
    number_rows,
)

# fixed parameters of the indicator feeds
SMA_WINDOW = 20
EMA_WINDOW = 20
RSI_WINDOW = 20
MACD_SHORT, MACD_LONG, MACD_SIGNAL = 10, 40, 25

_FORGET_BITS = 60


def ema_alpha(window: int) -> float:
    return 2.0 / (window + 1)


def warmup_bars(alphas: Iterable[float]) -> int:
    """Bars after which chained averages with these weights have forgotten their
    seed.  Chained averages need the sum of the single warm-ups."""
    return sum(math.ceil(_FORGET_BITS * math.log(2) / -math.log1p(-a)) for a in alphas)


def number_bars(bars: DataFrame) -> Numbered:
    """Bars are unique per (symbol, timestamp), so that pair orders them fully."""
    return number_rows(bars, ["symbol"], ["timestamp"])


def _closes(bars: Numbered) -> Numbered:
    return replace(bars, rows=bars.rows.select("symbol", "timestamp", "close", POS))


def sma(bars: Numbered, window: int = SMA_WINDOW, chunk: int | None = None) -> DataFrame:
    """Mean close of the last ``window`` bars (fewer at the start of a symbol)."""
    frame = Window.partitionBy("symbol", CHUNK).orderBy(POS).rowsBetween(1 - window, 0)
    return (
        halo_chunks(_closes(bars), window - 1, chunk)
        .withColumn("value", F.avg("close").over(frame))
        .filter(~F.col(WARMUP))
        .select("symbol", "timestamp", "value")
    )


def _ewm(values: pd.Series, symbols: pd.Series, alpha: float) -> pd.Series:
    smooth = values.groupby(symbols, sort=False).ewm(alpha=alpha, adjust=False).mean()
    return smooth.reset_index(level=0, drop=True).reindex(values.index)


def _in_chunks(bars: Numbered, warmup: int, chunk: int | None, compute, columns: str) -> DataFrame:
    """Run ``compute(pdf)`` on each sorted chunk and keep the home rows."""
    size = max(bars.chunk_size(), 10 * warmup) if chunk is None else chunk
    wanted = [c.split()[0] for c in columns.split(",")]

    def per_chunk(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(POS, ignore_index=True)
        out = compute(pdf)
        return out.loc[~pdf[WARMUP], ["symbol", "timestamp", *wanted]]

    return (
        halo_chunks(_closes(bars), warmup, size)
        .groupBy(CHUNK)
        .applyInPandas(per_chunk, f"symbol string, timestamp timestamp, {columns}")
    )


def ema(bars: Numbered, window: int = EMA_WINDOW, chunk: int | None = None) -> DataFrame:
    """y = alpha * close + (1 - alpha) * previous y, alpha = 2 / (window + 1),
    starting from the first close."""
    alpha = ema_alpha(window)

    def compute(pdf):
        return pdf.assign(value=_ewm(pdf["close"], pdf["symbol"], alpha))

    return _in_chunks(bars, warmup_bars([alpha]), chunk, compute, "value double")


def _macd_columns(pdf: pd.DataFrame, short: int, long: int, signal: int) -> pd.DataFrame:
    value = _ewm(pdf["close"], pdf["symbol"], ema_alpha(short)) - _ewm(
        pdf["close"], pdf["symbol"], ema_alpha(long)
    )
    smoothed = _ewm(value, pdf["symbol"], ema_alpha(signal))
    return pd.DataFrame({"value": value, "signal": smoothed, "histogram": value - smoothed})


def macd(
    bars: Numbered,
    short: int = MACD_SHORT,
    long: int = MACD_LONG,
    signal: int = MACD_SIGNAL,
    chunk: int | None = None,
) -> DataFrame:
    """EMA(short) - EMA(long), its EMA(signal), and the difference of the two."""
    warmup = warmup_bars([ema_alpha(min(signal, long)), ema_alpha(max(signal, long))])

    def compute(pdf):
        return pd.concat([pdf, _macd_columns(pdf, short, long, signal)], axis=1)

    return _in_chunks(
        bars, warmup, chunk, compute, "value double, signal double, histogram double"
    )


def _rsi_column(pdf: pd.DataFrame, window: int) -> pd.Series:
    change = pdf["close"].groupby(pdf["symbol"], sort=False).diff()
    gain = _ewm(change.clip(lower=0), pdf["symbol"], 1.0 / window)
    loss = _ewm((-change).clip(lower=0), pdf["symbol"], 1.0 / window)
    moved = gain + loss
    # 100 * gain / (gain + loss); a price that never moved is neutral
    return (100.0 * gain / moved.where(moved > 0)).mask(moved == 0, 50.0).where(change.notna())


def rsi(bars: Numbered, window: int = RSI_WINDOW, chunk: int | None = None) -> DataFrame:
    """Relative strength with Wilder smoothing; null on the first bar of a symbol."""

    def compute(pdf):
        return pdf.assign(value=_rsi_column(pdf, window))

    # one more bar because the change of the first warm-up bar is unknown
    return _in_chunks(bars, warmup_bars([1.0 / window]) + 1, chunk, compute, "value double")


def all_indicators(bars: Numbered, chunk: int | None = None) -> DataFrame:
    """The four indicators side by side, from one pass over the chunks."""
    warmup = max(
        warmup_bars([ema_alpha(MACD_SIGNAL), ema_alpha(MACD_LONG)]),
        warmup_bars([ema_alpha(EMA_WINDOW)]),
        warmup_bars([1.0 / RSI_WINDOW]) + 1,
    )

    def compute(pdf):
        mean = pdf["close"].groupby(pdf["symbol"], sort=False).rolling(SMA_WINDOW, min_periods=1)
        macd = _macd_columns(pdf, MACD_SHORT, MACD_LONG, MACD_SIGNAL)
        return pdf.assign(
            ema=_ewm(pdf["close"], pdf["symbol"], ema_alpha(EMA_WINDOW)),
            macd=macd["value"],
            macd_signal=macd["signal"],
            macd_histogram=macd["histogram"],
            rsi=_rsi_column(pdf, RSI_WINDOW),
            sma=mean.mean().reset_index(level=0, drop=True).reindex(pdf.index),
        )

    return _in_chunks(
        bars,
        warmup,
        chunk,
        compute,
        "ema double, macd double, macd_signal double, macd_histogram double, rsi double, sma double",
    )


def long_form(wide: DataFrame) -> DataFrame:
    """(symbol, timestamp, indicator, value, signal, histogram): the shape of the
    indicator feeds; only MACD has the last two."""
    none = F.lit(None).cast("double")

    def row(name: str) -> F.Column:
        more = ("macd_signal", "macd_histogram") if name == "macd" else (None, None)
        return F.struct(
            F.lit(name).alias("indicator"),
            F.col(name).alias("value"),
            *[
                (none if c is None else F.col(c)).alias(alias)
                for c, alias in zip(more, ("signal", "histogram"))
            ],
        )

    rows = F.inline(F.array(*map(row, ("ema", "macd", "rsi", "sma"))))
    return wide.select("symbol", "timestamp", rows).filter(F.col("value").isNotNull())
