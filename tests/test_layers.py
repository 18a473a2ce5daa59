"""Layers that take only what has changed: equal to a full build, whatever comes late."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from marketlake.plans import gold as features
from marketlake.plans import layers, tables
from marketlake.schemas import INDICATORS

UTC = dt.timezone.utc
START = dt.datetime(2024, 1, 1, tzinfo=UTC)
HOUR = 3_600_000
PRICES = "symbol string, timestamp long, open double, high double, low double, close double, volume long, volume_weighted double, transactions long"
VALUES = "indicator string, symbol string, timestamp long, value double"
NEWS = "id string, description string, published_utc timestamp, publisher string, tickers array<string>"
ZERO = int(START.timestamp() * 1000)


def price(symbol, hour, close, minute=0):
    return (symbol, ZERO + hour * HOUR + minute * 60_000, close, close, close, close, 1, close, 2)


def value(name, symbol, hour, x):
    return (name, symbol, ZERO + hour * HOUR, x)


def article(i, hour, *symbols, text="t"):
    return (f"n{i}", f"{text}{i}", START + dt.timedelta(hours=hour, minutes=5), "p", list(symbols))


def run(spark, root, prices, values, news, day):
    at = START + dt.timedelta(days=40 + day)
    layers.run_layers(
        spark,
        root,
        spark.createDataFrame(prices, PRICES),
        spark.createDataFrame(values, VALUES),
        spark.createDataFrame(news, NEWS),
        at,
    )


def gold(spark, root):
    rows = tables.gold_table(root).read(spark).drop("updated_at", "day")
    names = sorted(rows.columns)
    return sorted((tuple(r[c] for c in names) for r in rows.collect()), key=str)


def test_one_new_day_rewrites_that_day(spark, root):
    first = [price(s, h, 1.0 + h) for s in "ab" for h in range(48)]
    values = [value(i, s, h, 0.5 * h) for i in INDICATORS for s in "ab" for h in range(48)]
    new = [price(s, h, 2.0 + h) for s in "ab" for h in range(48, 72)]
    new_values = [value(i, "a", h, 0.1 * h) for i in INDICATORS for h in range(48, 72)]
    run(spark, root, first, values, [article(0, 3, "a")], 0)
    run(spark, root, new, new_values, [article(1, 50, "a", "b")], 1)
    for table in (
        tables.price_table(root, "bronze"),
        tables.price_table(root, "silver"),
        tables.indicator_table(root, "silver"),
        tables.gold_table(root),
    ):
        assert table.last_operation(spark).touched == ["day=2024-01-03"]
    whole = f"{root}-whole"
    run(spark, whole, first + new, values + new_values, [article(0, 3, "a"), article(1, 50, "a", "b")], 0)
    assert gold(spark, root) == gold(spark, whole)
    # nothing new: no layer writes
    versions = [tables.gold_table(root).state(spark).version, tables.price_table(root, "silver").state(spark).version]
    layers.silver(spark, root, START)
    layers.gold(spark, root, START)
    assert versions == [tables.gold_table(root).state(spark).version, tables.price_table(root, "silver").state(spark).version]


def test_a_late_article_touches_its_hour(spark, root):
    first = [price("a", h, 1.0 + h) for h in range(72)]
    values = [value(i, "a", h, 0.5 * h) for i in INDICATORS for h in range(72)]
    run(spark, root, first, values, [article(0, 3, "a")], 0)
    run(spark, root, [], [], [article(1, 30, "a"), article(0, 3, "a", text="new")], 1)
    assert tables.gold_table(root).last_operation(spark).touched == ["day=2024-01-01", "day=2024-01-02"]
    assert tables.gold_table(root).last_operation(spark).updated == 2
    rows = tables.gold_table(root).read(spark).filter(~F.array_contains("news_descriptions", "NoNews"))
    assert sorted(r.news_descriptions for r in rows.collect()) == [["new0"], ["t1"]]


@pytest.mark.parametrize("seed", [1, 2])
def test_rows_in_any_order_of_arrival(spark, root, seed):
    """Gaps in indicators, symbols that complete late, corrections far back."""
    rng = random.Random(seed)
    prices = [price(s, h, rng.random(), m) for s in "abc" for h in range(60) for m in (0, 30) if rng.random() < 0.7]
    values = [
        value(i, s, h, rng.random())
        for i in INDICATORS for s in "abc" for h in range(60)
        if rng.random() < 0.3 and not (s == "c" and h < 40)
    ]
    news = [article(i, rng.randrange(60), *rng.sample("abc", rng.randint(1, 2))) for i in range(40)]
    whole = f"{root}-whole"
    run(spark, whole, prices, values, news, 0)
    for rows in (prices, values, news):
        rows.sort(key=lambda r: (r[2] if rows is news else r[1 if rows is prices else 2]).__str__())
        for _ in range(len(rows) // 10):  # some come late
            rows.append(rows.pop(rng.randrange(len(rows))))
    cuts = [0, 0.5, 0.8, 1]
    for day, (a, b) in enumerate(zip(cuts[:-1], cuts[1:])):
        part = [rows[int(a * len(rows)) : int(b * len(rows))] for rows in (prices, values, news)]
        run(spark, root, *part, day)
    assert gold(spark, root) == gold(spark, whole)


def test_a_failed_run_is_repeated(spark, root, monkeypatch):
    first = [price("a", h, 1.0 + h) for h in range(24)]
    values = [value(i, "a", h, 0.5) for i in INDICATORS for h in range(24)]
    run(spark, root, first, values, [article(0, 3, "a")], 0)
    with monkeypatch.context() as m:
        m.setattr(layers, "build_gold", None)
        m.setattr(layers, "gold_since", None)
        with pytest.raises(TypeError):
            run(spark, root, [price("a", 24, 9.0)], [], [], 1)
    layers.gold(spark, root, START)
    assert tables.gold_table(root).read(spark).count() == 25


def test_layers_need_the_one_below(spark, root):
    with pytest.raises(layers.MissingTable):
        layers.silver(spark, root, START)


def _hours_and_news(spark):
    hours = spark.createDataFrame([("a", START + dt.timedelta(hours=h)) for h in (2, 3, 5)], "symbol string, timestamp timestamp")
    hours = hours.withColumns({name: F.lit(1.0) for name in features.FEATURES})
    minutes = (0, 119, 120, 130, 245, 359, 360, 900)
    news = [("a", f"n{m}", f"t{m}", START + dt.timedelta(minutes=m)) for m in minutes] + [("a", "none", "none", None)]
    return hours, spark.createDataFrame(news, "symbol string, id string, description string, published_utc timestamp")


def test_news_outside_the_hours_stays_where_it_is(spark):
    hours, news = _hours_and_news(spark)
    near = features.news_of_hours(news, hours)
    assert sorted(r.id for r in near.collect()) == ["n120", "n130", "n245", "n359"]
    every, some = (features.finish_gold(hours, rows).collect() for rows in (news, near))
    assert sorted(every) == sorted(some)
    assert {r.timestamp.hour: r.news_descriptions for r in some}[2] == ["t120", "t130"]
    assert features.news_of_hours(news, hours.limit(0)).isEmpty()


def test_texts_are_dealt_out_once_for_gold(spark):
    hours, news = _hours_and_news(spark)
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        made = features.finish_gold(hours, news)
        plan = made._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    assert plan.count("Exchange hashpartitioning") == 2
