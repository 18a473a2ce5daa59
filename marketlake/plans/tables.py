"""The lake's tables, below one root folder."""

from __future__ import annotations

from marketlake.sources.lake import LakeTable, day_of, day_of_millis, hash_bucket


def price_table(root: str, layer: str) -> LakeTable:
    """One table for all symbols, instead of one per symbol."""
    day = day_of_millis() if layer == "bronze" else day_of()
    return LakeTable(
        f"{root}/{layer}/price",
        ("symbol", "timestamp"),
        {"day": day},
        cluster_by=("symbol", "timestamp"),
    )


def indicator_table(root: str, layer: str) -> LakeTable:
    day = day_of_millis() if layer == "bronze" else day_of()
    return LakeTable(
        f"{root}/{layer}/indicators",
        ("indicator", "symbol", "timestamp"),
        {"day": day},
        cluster_by=("symbol", "timestamp"),
    )


def quote_table(root: str) -> LakeTable:
    return LakeTable(
        f"{root}/bronze/quotes",
        ("symbol", "end_time"),
        {"day": day_of_millis("end_time")},
        cluster_by=("symbol", "end_time"),
    )


def news_table(root: str, layer: str) -> LakeTable:
    """Keyed by article, so partitioned by a hash of the key."""
    keys = ("id",) if layer == "bronze" else ("symbol", "id")
    return LakeTable(
        f"{root}/{layer}/news",
        keys,
        {"bucket": hash_bucket(*keys)},
        cluster_by=("published_utc",),
        wide=True,
    )


def news_versions_table(root: str) -> LakeTable:
    """Keeps every fetched version of an article."""
    keys = ("id", "updated_at")
    return LakeTable(f"{root}/bronze/news_versions", keys, {"bucket": hash_bucket("id")})


def gold_table(root: str) -> LakeTable:
    return LakeTable(f"{root}/gold/features", ("symbol", "timestamp"), {"day": day_of()})


def serving_table(root: str) -> LakeTable:
    return LakeTable(f"{root}/serving/cleaned", ("symbol", "timestamp"), {"day": day_of()})


def forecast_table(root: str) -> LakeTable:
    return LakeTable(f"{root}/serving/ml", ("symbol", "timestamp"), {"day": day_of()})
