"""Fixed schemas of the wire messages and lake tables, and the contract check."""

from __future__ import annotations

from pyspark.sql import DataFrame

# --- fixed values: wire field names, table column names and types -----------
PRICE_MESSAGE = (
    "t BIGINT NOT NULL, o DOUBLE, h DOUBLE, l DOUBLE, c DOUBLE, v BIGINT, vw DOUBLE,"
    " n BIGINT, symbol STRING NOT NULL"
)
INDICATOR_MESSAGE = "timestamp BIGINT NOT NULL, value DOUBLE, symbol STRING NOT NULL"
MACD_MESSAGE = (
    "timestamp BIGINT NOT NULL, value DOUBLE, signal DOUBLE, histogram DOUBLE,"
    " symbol STRING NOT NULL"
)
QUOTE_MESSAGE = (
    "ARRAY<STRUCT<ev: STRING, sym: STRING, v: BIGINT, av: BIGINT, op: DOUBLE, vw: DOUBLE,"
    " o: DOUBLE, c: DOUBLE, h: DOUBLE, l: DOUBLE, a: DOUBLE, z: BIGINT, s: BIGINT, e: BIGINT>>"
)
NEWS_ROW = (
    "id STRING, amp_url STRING, article_url STRING, author STRING, description STRING,"
    " image_url STRING, keywords ARRAY<STRING>, published_utc STRING,"
    " publisher STRUCT<name: STRING>, tickers ARRAY<STRING>, title STRING"
)

PRICE_NAMES = {
    "t": "timestamp",
    "o": "open",
    "h": "high",
    "l": "low",
    "c": "close",
    "v": "volume",
    "vw": "volume_weighted",
    "n": "transactions",
}
QUOTE_NAMES = {
    "ev": "event",
    "sym": "symbol",
    "v": "volume",
    "av": "agg_volume",
    "op": "open_price",
    "vw": "volume_weighted",
    "o": "open",
    "c": "close",
    "h": "high",
    "l": "low",
    "a": "avg_price",
    "z": "total_trades",
    "s": "start_time",
    "e": "end_time",
}

PRICE_TABLE = {
    "symbol": "string",
    "timestamp": "bigint",
    "open": "double",
    "high": "double",
    "low": "double",
    "close": "double",
    "volume": "bigint",
    "volume_weighted": "double",
    "transactions": "bigint",
    "updated_at": "timestamp",
}
INDICATOR_TABLE = {
    "timestamp": "bigint",
    "value": "double",
    "symbol": "string",
    "updated_at": "timestamp",
}
MACD_TABLE = {**INDICATOR_TABLE, "signal": "double", "histogram": "double"}
QUOTE_TABLE = {
    "event": "string",
    "symbol": "string",
    "volume": "bigint",
    "agg_volume": "bigint",
    "open_price": "double",
    "volume_weighted": "double",
    "open": "double",
    "close": "double",
    "high": "double",
    "low": "double",
    "avg_price": "double",
    "total_trades": "bigint",
    "start_time": "bigint",
    "end_time": "bigint",
    "updated_at": "timestamp",
}
FORECAST_TABLE = {"timestamp": "timestamp", "close": "double"}
SERVING_TABLE = {
    "symbol": "string",
    "timestamp": "timestamp",
    "close": "double",
    "volume": "double",
    "volume_weighted": "double",
    "transactions": "double",
    "ema": "double",
    "macd": "double",
    "rsi": "double",
    "sma": "double",
    "updated_at": "timestamp",
}
INDICATORS = ["ema", "macd", "rsi", "sma"]
# -----------------------------------------------------------------------------


class SchemaMismatch(ValueError):
    """Actual columns differ from the contract; ``differences`` lists how."""

    def __init__(self, differences: list[tuple[str, str | None, str | None]]):
        self.differences = differences
        lines = [f"{name}: expected {want}, found {have}" for name, want, have in differences]
        super().__init__("schema mismatch: " + "; ".join(lines))


def schema_differences(
    df: DataFrame, expected: dict[str, str]
) -> list[tuple[str, str | None, str | None]]:
    """(column, expected type, actual type) for each disagreement."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    names = sorted({**expected, **actual})
    return [
        (name, expected.get(name), actual.get(name))
        for name in names
        if expected.get(name) != actual.get(name)
    ]


def assert_schema(df: DataFrame, expected: dict[str, str]) -> DataFrame:
    """Hand the frame back when it honours the contract, raise otherwise."""
    differences = schema_differences(df, expected)
    if differences:
        raise SchemaMismatch(differences)
    return df
