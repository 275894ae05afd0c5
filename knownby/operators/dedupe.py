"""Reductions to one row per key. All are aggregates with a map-side combine."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_row_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """The whole row (nulls included) with the greatest ``order`` tuple for every key."""
    rest = [c for c in df.columns if c not in keys]
    rank = F.struct(*[F.col(o) if isinstance(o, str) else o for o in order])
    picked = df.groupBy(*keys).agg(
        F.max_by(F.struct(*[F.col(c) for c in rest]), rank).alias("_row"))
    return picked.select(*[F.col(c) if c in keys else F.col(f"_row.`{c}`").alias(c)
                           for c in df.columns])


def daily_axis(prices: DataFrame) -> DataFrame:
    """One bar per (permaTicker, p_date).

    The shuffle key includes the day, so a security landed many times over spreads out and folds
    down before any per-security window sees it; afterwards a group is at most one row per calendar
    day. Among differing bars for one day the greatest value tuple is kept, which is repeatable.
    """
    keys = ["permaTicker", "p_date"]
    return last_row_per_key(prices, keys, [c for c in prices.columns if c not in keys])


def union_dedupe(sources: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Concatenate sources and keep one row per key, an earlier source winning over a later one."""
    ranked = [df.withColumn("_source", F.lit(-position)) for position, df in enumerate(sources)]
    merged = ranked[0]
    for df in ranked[1:]:
        merged = merged.unionByName(df)
    rest = [c for c in merged.columns if c not in keys and c != "_source"]
    return last_row_per_key(merged, keys, ["_source", *rest]).drop("_source")
