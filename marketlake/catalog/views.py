"""SQL views the oracles share: the adapters of ``sources.adapters`` in SQL."""

TICKS = """ticks AS (
  SELECT event_type AS symbol, ts, event_id, value AS price,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS size
  FROM events)"""


def bars(unit: str = "minute", name: str = "bars") -> str:
    return f"""{name} AS (
  SELECT symbol, date_trunc('{unit}', ts) AS ts,
         first(price ORDER BY ts, event_id) AS open, max(price) AS high,
         min(price) AS low, last(price ORDER BY ts, event_id) AS close,
         CAST(sum(size) AS BIGINT) AS volume,
         sum(price * size) / nullif(sum(size), 0) AS volume_weighted,
         count(*) AS transactions
  FROM ticks GROUP BY ALL)"""


NUMBERED = """numbered AS (
  SELECT symbol, ts, close, row_number() OVER (PARTITION BY symbol ORDER BY ts) AS i FROM bars)"""

# EMA(20), EMA(10), EMA(40), signal EMA(25) and Wilder gain/loss in one recursion
RECURSION = """recursion AS (
  SELECT symbol, ts, close, i, close AS ema, close AS e10, close AS e40,
         CAST(0 AS DOUBLE) AS signal, CAST(NULL AS DOUBLE) AS gain, CAST(NULL AS DOUBLE) AS loss
  FROM numbered WHERE i = 1
  UNION ALL
  SELECT n.symbol, n.ts, n.close, n.i,
         n.close * 2.0 / 21 + p.ema * 19.0 / 21,
         n.close * 2.0 / 11 + p.e10 * 9.0 / 11,
         n.close * 2.0 / 41 + p.e40 * 39.0 / 41,
         (n.close * 2.0 / 11 + p.e10 * 9.0 / 11 - n.close * 2.0 / 41 - p.e40 * 39.0 / 41) * 2.0 / 26
           + p.signal * 24.0 / 26,
         CASE WHEN p.gain IS NULL THEN greatest(n.close - p.close, 0)
              ELSE (p.gain * 19 + greatest(n.close - p.close, 0)) / 20 END,
         CASE WHEN p.loss IS NULL THEN greatest(p.close - n.close, 0)
              ELSE (p.loss * 19 + greatest(p.close - n.close, 0)) / 20 END
  FROM recursion p JOIN numbered n ON n.symbol = p.symbol AND n.i = p.i + 1)"""

INDICATORS = """ind AS (
  SELECT symbol, ts, ema, e10 - e40 AS macd, signal, e10 - e40 - signal AS histogram,
         CASE WHEN i = 1 THEN NULL WHEN gain + loss = 0 THEN 50 ELSE 100 * gain / (gain + loss) END AS rsi,
         avg(close) OVER (PARTITION BY symbol ORDER BY ts ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS sma
  FROM recursion)"""

NEWS = """news AS (
  SELECT CAST(doc_id AS VARCHAR) AS id, text AS description, source AS publisher,
         TIMESTAMP '2024-01-01' + to_hours(doc_id) AS published_utc,
         CASE WHEN doc_id % 3 = 0
              THEN [s[1 + doc_id % 5], s[1 + (doc_id + 1) % 5]] ELSE [s[1 + doc_id % 5]] END AS tickers
  FROM documents, (SELECT ['click', 'error', 'purchase', 'signup', 'view'] AS s)),
symbol_news AS (SELECT unnest(tickers) AS symbol, * FROM news)"""

HOURLY = """hourly AS (
  SELECT b.symbol, date_trunc('hour', b.ts) AS ts,
         avg(open) AS avg_open, avg(high) AS avg_high, avg(low) AS avg_low, avg(close) AS avg_close,
         avg(volume) AS avg_volume, avg(volume_weighted) AS avg_volume_weighted,
         avg(transactions) AS avg_transactions
  FROM bars b GROUP BY ALL),
hourly_ind AS (
  SELECT symbol, date_trunc('hour', ts) AS ts, avg(ema) AS avg_ema, avg(macd) AS avg_macd,
         avg(rsi) AS avg_rsi, avg(sma) AS avg_sma
  FROM ind GROUP BY ALL),
features AS (SELECT * FROM hourly LEFT JOIN hourly_ind USING (symbol, ts)),
hourly_news AS (
  SELECT symbol, date_trunc('hour', published_utc) AS ts,
         list(description ORDER BY published_utc, id) AS news_descriptions
  FROM symbol_news GROUP BY ALL)"""

FEATURES = [
    "avg_open",
    "avg_high",
    "avg_low",
    "avg_close",
    "avg_volume",
    "avg_volume_weighted",
    "avg_transactions",
    "avg_ema",
    "avg_macd",
    "avg_rsi",
    "avg_sma",
]


def fill(columns: list[str], source: str = "features", name: str = "filled") -> str:
    filled = ",\n         ".join(
        f"last_value({c} IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY ts"
        f" ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {c}"
        for c in columns
    )
    return f"{name} AS (SELECT symbol, ts,\n         {filled}\n  FROM {source})"


GOLD = f"""{fill(FEATURES)},
gold AS (
  SELECT f.*, coalesce(news_descriptions, ['NoNews']) AS news_descriptions
  FROM filled f LEFT JOIN hourly_news USING (symbol, ts)
  WHERE avg_ema IS NOT NULL AND avg_macd IS NOT NULL AND avg_rsi IS NOT NULL AND avg_sma IS NOT NULL)"""


def with_views(*views: str, recursive: bool = False) -> str:
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(views) + "\n"


INDICATOR_VIEWS = [TICKS, bars(), NUMBERED, RECURSION, INDICATORS]
GOLD_VIEWS = INDICATOR_VIEWS + [NEWS, HOURLY, GOLD]
