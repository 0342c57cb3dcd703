"""Streaming transformations (stateful dedup) that return streaming frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally.operators.bloom import KEEP_DAYS
from gridtally.operators.dedup import BATCH_KEY, BATCH_TTL_HOURS
from gridtally.operators.grid import listen_day
from gridtally.session import use_rocksdb_state


def _arriving(rows: DataFrame, keep: str) -> DataFrame:
    """Stamp rows with the time of their micro-batch and let state live for ``keep`` after it.

    No row can arrive before its own micro-batch, so none is ever late, whatever times it carries.
    """
    use_rocksdb_state(rows.sparkSession)
    return rows.withColumn("_arrived", F.current_timestamp()).withWatermark("_arrived", keep)


def dedup_batches_stream(batches: DataFrame, ttl_hours: int = BATCH_TTL_HOURS) -> DataFrame:
    """Drop repeats of (client_id, batch_id) that arrive within the TTL of the first copy.

    State is kept per id from its arrival, not from any time a client sent, so an odd time loses
    nothing. Blank ids go around the state.
    """
    blank = F.coalesce(F.col("batch_id") == "", F.lit(True))
    keyed = _arriving(batches.filter(~blank), f"{ttl_hours} hours").dropDuplicatesWithinWatermark(BATCH_KEY)
    return batches.filter(blank).unionByName(keyed.drop("_arrived"))


def dedup_events_stream(listens: DataFrame, keep_days: int = KEEP_DAYS) -> DataFrame:
    """Drop an event_id that repeats within its day; ids are remembered for ``keep_days`` after
    they arrive. Events of any day count, however late or far ahead."""
    arrived = _arriving(listen_day(listens), f"{keep_days} days")
    return arrived.dropDuplicatesWithinWatermark(["day", "event_id"]).drop("_arrived")
