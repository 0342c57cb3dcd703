"""Approximate distinct counts that merge across days."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LG_BUCKETS = 12


def daily_sketches(listens: DataFrame, keys: list[str], lg_buckets: int = LG_BUCKETS) -> DataFrame:
    """One HyperLogLog sketch of event ids per key and day; the table to store."""
    return listens.groupBy(*keys, "day").agg(F.hll_sketch_agg("event_id", lg_buckets).alias("sketch"))


def approx_item_counts(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct events per key over all days in ``sketches``; an id seen on two days counts once."""
    merged = sketches.groupBy(*keys).agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.select(*keys, F.hll_sketch_estimate("sketch").alias("approx_count"))


def approx_item_counts_once(listens: DataFrame, keys: list[str], rsd: float = 0.02) -> DataFrame:
    """The one-shot form, nothing stored."""
    return listens.groupBy(*keys).agg(F.approx_count_distinct("event_id", rsd).alias("approx_count"))
