"""As-of joins, sessions and click-stream measures over ``events``."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlake.catalog.entry import Book, millis, rounded, sql6
from marketlake.operators import clicks
from marketlake.operators.asof import asof_join
from marketlake.operators.sessions import session_windows, sessions
from marketlake.sources.tables import driver_table

book = Book()


def _events(spark, sf):
    return driver_table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type", "value")


# --- as-of joins: every purchase meets a view of the same user ------------------

_SIDES = """WITH p AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'purchase'),
v AS (SELECT event_id, user_id, ts, value FROM events WHERE event_type = 'view'),
"""
_BACK = "SELECT event_id, value, ts FROM v WHERE v.user_id = p.user_id AND v.ts {op} p.ts ORDER BY v.ts {dir}, v.event_id {dir} LIMIT 1"


def _asof_sql(op, direction, extra="TRUE"):
    return (
        _SIDES
        + f"""m AS (SELECT p.event_id, p.user_id, p.ts, v.event_id AS v_id, v.value AS v_value, v.ts AS v_ts
  FROM p ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.ts {op} v.ts)
SELECT event_id, user_id, CASE WHEN {extra} THEN v_id END AS right_event_id,
  CASE WHEN {extra} THEN v_value END AS right_value FROM m"""
    )


def _asof(spark, sf, **options):
    events = _events(spark, sf)
    purchases = events.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    viewed = events.filter("event_type = 'view'").select("event_id", "user_id", "ts", "value")
    joined = asof_join(
        purchases, viewed, "ts", ["user_id"], F.col("event_id"), F.col("event_id"), **options
    )
    return joined.drop("ts", "right_ts")


@book.add("asof_backward", _asof_sql(">=", "backward"))
def asof_backward(spark, sf):
    return _asof(spark, sf)


@book.add(
    "asof_backward_within_hour",
    _asof_sql(">", "backward", "epoch_us(p_ts) - epoch_us(v_ts) <= 3600000000").replace(
        "p.ts, v.event_id", "p.ts AS p_ts, v.event_id"
    ),
)
def asof_backward_within_hour(spark, sf):
    return _asof(spark, sf, exact=False, tolerance=3600)


@book.add("asof_forward", _asof_sql("<=", "forward"))
def asof_forward(spark, sf):
    return _asof(spark, sf, direction="forward")


@book.add(
    "asof_nearest",
    _SIDES
    + """b AS (SELECT p.event_id, p.user_id, p.ts, v.event_id AS id, v.value AS val, v.ts AS t
  FROM p ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.ts >= v.ts),
f AS (SELECT p.event_id, v.event_id AS id, v.value AS val, v.ts AS t
  FROM p ASOF LEFT JOIN v ON p.user_id = v.user_id AND p.ts <= v.ts),
m AS (SELECT b.event_id, b.user_id, b.id AS bid, b.val AS bval, f.id AS fid, f.val AS fval,
  f.t IS NOT NULL AND (b.t IS NULL OR epoch_us(f.t) - epoch_us(b.ts) < epoch_us(b.ts) - epoch_us(b.t)) AS ahead
  FROM b JOIN f USING (event_id))
SELECT event_id, user_id, CASE WHEN ahead THEN fid ELSE bid END AS right_event_id,
  CASE WHEN ahead THEN fval ELSE bval END AS right_value FROM m""",
)
def asof_nearest(spark, sf):
    return _asof(spark, sf, direction="nearest")


# --- sessions -------------------------------------------------------------------

_ISLANDS = """WITH marked AS (
  SELECT *, lag(ts) OVER w AS prev_ts, lag(event_type) OVER w AS prev_type FROM events
  WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
numbered AS (
  SELECT *, sum(CASE WHEN prev_ts IS NULL OR epoch_us(ts) - epoch_us(prev_ts) >= {gap} {close}
    THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s FROM marked)
SELECT user_id, epoch_us(min(ts)) // 1000 AS start, epoch_us(max(ts)) // 1000 AS "end",
  {duration} AS duration_seconds, count(*) AS events, {closed} AS closed
FROM numbered GROUP BY user_id, s"""
_DURATION = sql6("(epoch_us(max(ts)) - epoch_us(min(ts))) / 1000000.0")


@book.add("sessions_by_gap", _ISLANDS.format(gap=1800 * 10**6, close="", duration=_DURATION, closed="FALSE"))
def sessions_by_gap(spark, sf):
    found = sessions(_events(spark, sf), "user_id", 1800)
    return rounded(millis(found, "start", "end"), "duration_seconds")


@book.add(
    "sessions_with_close_event",
    _ISLANDS.format(
        gap=86400 * 10**6,
        close="OR prev_type = 'purchase'",
        duration=_DURATION,
        closed="bool_or(event_type = 'purchase')",
    ),
)
def sessions_with_close_event(spark, sf):
    closes = F.col("event_type") == "purchase"
    found = sessions(_events(spark, sf), "user_id", 86400, closes)
    return rounded(millis(found, "start", "end"), "duration_seconds")


@book.add(
    "session_windows",
    """SELECT user_id, start, "end" + 1800000 AS "end", events FROM ("""
    + _ISLANDS.format(gap=1800 * 10**6, close="", duration=_DURATION, closed="FALSE")
    + ")",
)
def session_windows_query(spark, sf):
    return millis(session_windows(_events(spark, sf), "user_id", 1800), "start", "end")


# --- windows ----------------------------------------------------------------------


def _windows(size: int, slide: int, source: str = "events") -> str:
    """Every event once per sliding window that holds it (seconds)."""
    return f"""WITH starts AS (
  SELECT *, (epoch_us(ts) // {slide * 10**6}) * {slide * 1000} - k * {slide * 1000} AS start
  FROM {source}, generate_series(0, {-(-size // slide) - 1}) AS g(k)),
windowed AS (SELECT *, start + {size * 1000} AS "end" FROM starts
  WHERE epoch_us(ts) < (start + {size * 1000}) * 1000)
"""


@book.add(
    "word_windows",
    _windows(600, 300)
    + 'SELECT start, "end", event_type AS word, count(*) AS n FROM windowed GROUP BY ALL',
)
def word_windows(spark, sf):
    counted = clicks.word_windows(_events(spark, sf), "event_type", "10 minutes", "5 minutes")
    return millis(counted, "start", "end")


@book.add("click_page_counts", "SELECT event_type, count(*) AS views FROM events GROUP BY 1")
def click_page_counts(spark, sf):
    return clicks.page_counts(_events(spark, sf))


@book.add(
    "click_sliding_page_counts",
    _windows(10, 2) + 'SELECT start, "end", event_type, count(*) AS views FROM windowed GROUP BY ALL',
)
def click_sliding_page_counts(spark, sf):
    return millis(clicks.sliding_page_counts_by_slot(_events(spark, sf)), "start", "end")


@book.add(
    "click_error_rates",
    _windows(30, 2, "(SELECT e.*, c_nationkey FROM events e JOIN customer ON user_id = c_custkey)")
    + f"""SELECT start, "end", c_nationkey,
  {sql6("avg(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END)")} AS error_rate, count(*) AS views,
  avg(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) > 0.05 AS alert
FROM windowed GROUP BY start, "end", c_nationkey""",
)
def click_error_rates(spark, sf):
    areas = driver_table(spark, sf, "customer").select(
        F.col("c_custkey").alias("user_id"), "c_nationkey"
    )
    located = _events(spark, sf).join(areas, "user_id")
    return rounded(millis(clicks.error_rates_by_slot(located, "c_nationkey"), "start", "end"), "error_rate")


@book.add(
    "click_active_users",
    _windows(15, 2) + 'SELECT start, "end", count(DISTINCT user_id) AS users FROM windowed GROUP BY ALL',
)
def click_active_users(spark, sf):
    return millis(clicks.active_users_by_slot(_events(spark, sf)), "start", "end")


@book.add(
    "click_known_users",
    """SELECT user_id, c_name AS name, count(*) AS views FROM events
JOIN customer ON user_id = c_custkey GROUP BY ALL""",
)
def click_known_users(spark, sf):
    users = driver_table(spark, sf, "customer").select(
        F.col("c_custkey").alias("user_id"), F.col("c_name").alias("name")
    )
    return clicks.known_users_seen(_events(spark, sf), users)
