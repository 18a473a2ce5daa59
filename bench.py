"""Time the headline queries and print one JSON line.

BENCH_SF_DIR  folder with the parquet tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_RUNS    timed runs per query after one warm-up; the median counts (default 3)
BENCH_ONLY    comma-separated query names (default: the headline list)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

from marketlake.catalog import all_queries
from marketlake.session import build_session, scratch_path
from marketlake.sources.adapters import NEWS_SYMBOLS, indicator_messages, price_messages
from marketlake.streaming.router import Router, message_stream

HEADLINE = [
    "bars_minute",
    "indicator_sma",
    "indicator_ema",
    "indicator_macd",
    "indicator_rsi",
    "parse_price_messages",
    "hourly_price_means",
    "gold_features",
    "latest_bars",
    "bar_changes",
    "latest_version_per_key",
    "asof_backward",
    "sessions_by_gap",
    "click_error_rates",
    "lake_merge",
    "stream_ingest",
    "word_counts",
    "term_weights",
    "skewed_group_by",
    "daily_delays",
    "correlation_spearman",
    "scale_standard",
    "frequent_item_sets",
    "column_cosines",
    "graph_pagerank",
    "graph_components",
    "graph_triangles",
    "udaf_mean",
]


def run_all(query, spark, sf_dir: str) -> float:
    """Seconds to compute every row and column; nothing is collected."""
    started = time.perf_counter()
    query.run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def ingest_rate(spark, sf_dir: str) -> int:
    """Messages per second through the router (parse, route, merge) for a batch of
    price and indicator messages that is already there: median of three runs after
    a warm-up, each into a new lake."""
    inbox = scratch_path(spark, "bench-inbox")
    price_messages(spark, sf_dir).union(indicator_messages(spark, sf_dir)).write.parquet(inbox)
    count = spark.read.parquet(inbox).count()
    seconds = []
    for _ in range(4):
        root = scratch_path(spark, "bench-ingest")
        stream = message_stream(spark, "parquet", {}, inbox)
        started = time.perf_counter()
        query = Router(root, NEWS_SYMBOLS).start(stream, f"{root}/checkpoint", availableNow=True)
        query.awaitTermination()
        seconds.append(time.perf_counter() - started)
    print(f"ingest: {count} messages, seconds {[round(s, 2) for s in seconds]}", file=sys.stderr)
    return round(count / statistics.median(seconds[1:]))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_ONLY")
    spark = build_session(
        "marketlake-bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    seconds = {}
    for name in names.split(",") if names else HEADLINE:
        warm = run_all(queries[name], spark, sf_dir)
        timed = [run_all(queries[name], spark, sf_dir) for _ in range(runs)]
        seconds[name] = round(statistics.median(timed), 3)
        print(f"{name}: warm-up {warm:.2f}s, median {seconds[name]}s", file=sys.stderr)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": Path(sf_dir).name.removeprefix("sf"),
    }
    if not names:
        result["ingest_rows_per_sec"] = ingest_rate(spark, sf_dir)
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
