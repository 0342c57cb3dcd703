"""Listen activity end to end: log → history and counters → ranked lists."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridtally import schemas
from gridtally.operators import checks, ingest, listens
from gridtally.sources import tables
from gridtally.streaming import sinks, streams


def consume_log(
    records: Callable[[], DataFrame], history_path: str, counters_path: str, checkpoints: str,
    every: str | None = sinks.COUNT_EVERY,
) -> list[StreamingQuery]:
    """Two consumers of one log: raw history, and deduplicated counters. Bad records are skipped."""
    decoded = lambda: ingest.decode_log(records(), schemas.LISTEN_EVENT)[0]
    unique = streams.dedup_events_stream(decoded())
    return [
        sinks.upsert_history(decoded(), history_path, f"{checkpoints}/history", every),
        sinks.increment_counters(unique, counters_path, f"{checkpoints}/counters", every),
    ]


def serve_topk(
    spark: SparkSession, counters_path: str, as_of, days=None, k=None, user_id: str | None = None,
    base: str | None = None, folded: int | None = None,
) -> DataFrame:
    """Ranked songs from the stored counters, for one user or all. Only days in the window are read."""
    counters = tables.read_deltas(spark, counters_path, sinks.COUNTER_DELTA, base, folded)
    if user_id is not None:
        counters = counters.filter(F.col("user_id") == user_id)
    return listens.user_topk(counters.withColumnRenamed("delta", "listen_count"), as_of, days, k)


def reconcile(spark: SparkSession, history_path: str, counters_path: str, threshold: float = 0.01) -> DataFrame:
    """(user, day, song) counters that disagree with an exact recount of the history."""
    keys = ["user_id", "day", "song_id"]
    history = sinks.read_history(spark, history_path)
    recount = history.select("event_id", *keys).distinct().groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    stored = sinks.read_counters(spark, counters_path).withColumnRenamed("listen_count", "n")
    return checks.reconcile_counts(stored, recount, keys, threshold)

