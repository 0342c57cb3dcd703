"""Batch deduplication with a time to live, as a cache key with an expiry would do it."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridtally.session import saved

# How long a seen batch id is remembered.
BATCH_TTL_HOURS = 24
BATCH_KEY = ["client_id", "batch_id"]


def dedup_batches(
    batches: DataFrame, time: str = "received_at", tie: tuple[str, ...] = (), ttl_hours: int = BATCH_TTL_HOURS
) -> DataFrame:
    """Drop repeats of (client_id, batch_id) arriving within the TTL of the last kept copy.

    Blank batch ids are never deduplicated. Runs on whole batches, before they are exploded.

    Each round keeps every key's first copy (one row per key and map task reaches the shuffle) and
    hands on only copies that came after the TTL ran out, which needs the keys seen for longer than
    the TTL: a slim aggregate, evaluated here. Usually there are none and one round is enough; at
    most one round per TTL in the data's time span is needed. What is handed on is written to the
    shared folder, so later rounds neither recompute nor lose it.
    """
    blank = F.coalesce(F.col("batch_id") == "", F.lit(True))
    unkeyed, remaining = batches.filter(blank), batches.filter(~blank)
    kept = [unkeyed]
    ttl = F.make_interval(hours=F.lit(ttl_hours))
    order = Window.partitionBy(*BATCH_KEY).orderBy(time, *tie)
    while True:
        ranked = remaining.withColumn("_n", F.row_number().over(order))
        kept.append(ranked.filter("_n = 1").drop("_n"))
        lasting = (
            remaining.groupBy(*BATCH_KEY)
            .agg(F.min(time).alias("_seen"), F.max(time).alias("_last"))
            .filter(F.col("_last") >= F.col("_seen") + ttl)
            .select(*BATCH_KEY, "_seen")
        )
        lasting = saved(lasting, "lasting-batches")
        if lasting.isEmpty():
            return reduce(DataFrame.unionByName, kept)
        # Broadcast while few keys outlive the TTL; beyond that both sides are plain shuffles, of
        # which AQE splits the skewed ones.
        later = remaining.join(lasting, BATCH_KEY).filter(F.col(time) >= F.col("_seen") + ttl)
        remaining = saved(later.select(*batches.columns), "expired-batches")
