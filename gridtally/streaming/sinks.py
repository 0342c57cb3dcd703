"""Streaming sinks: hour folders, and idempotent per-batch delta tables.

Counters are written as one delta folder per micro-batch id and summed on read. A micro-batch that
runs twice overwrites its own folder, so a restart never counts twice.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from gridtally import schemas
from gridtally.operators import bloom, spacing
from gridtally.operators.grid import listen_day
from gridtally.operators.keyed import fold_status_events, merge_status, schedule_rows
from gridtally.operators.listens import history_rows, sum_deltas
from gridtally.operators.rollups import KEYS, heatmap_hourly
from gridtally.session import use_rocksdb_state
from gridtally.sources.raw_files import RECORDS_PER_FILE, with_landing_hour
from gridtally.sources.tables import append_delta, compact, current_history, read_deltas
from gridtally.streaming import bloom_state, spacing_state

# Flush intervals.
LAND_EVERY, COUNT_EVERY = "60 seconds", "30 seconds"

HISTORY_DELTA = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("listened_at", T.TimestampType()),
        T.StructField("event_id", T.StringType()),
        T.StructField("song_id", T.StringType()),
        T.StructField("provider", T.StringType()),
        T.StructField("position", T.LongType()),
        T.StructField("day", T.DateType()),
    ]
)
COUNTER_DELTA = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("song_id", T.StringType()),
        T.StructField("delta", T.LongType()),
        T.StructField("day", T.DateType()),
    ]
)
_AT = [T.StructField("ts", T.TimestampType()), T.StructField("seq", T.LongType())]
STATUS_DELTA = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("provider", T.StringType()),
        T.StructField("status_set", T.StructType([*_AT, T.StructField("status", T.StringType())])),
        T.StructField("error_set", T.StructType([*_AT, T.StructField("error", T.StringType())])),
        T.StructField("done_set", T.StructType(_AT)),
        T.StructField("created_at", T.TimestampType()),
    ]
)
HOURLY_DELTA = T.StructType(schemas.TIER_ROW.fields + [T.StructField("dt", T.DateType())])


def _trigger(every: str | None) -> dict:
    """Processing-time trigger, or with None: everything available now, then stop."""
    return {"processingTime": every} if every else {"availableNow": True}


def land_events(
    raw: DataFrame, base: str, checkpoint: str, file_format: str = "json", every: str | None = LAND_EVERY,
    by_client: bool = False, records_per_file: int = RECORDS_PER_FILE, hour_writers: int | None = None,
) -> StreamingQuery:
    """Stream of raw events → immutable files by event hour (UTC) of limited length.

    Straight from a source each hour is gathered in one task, and one too big for a task in several (REBALANCE):
    a source may hand over a micro-batch of many hours as one split, or every hour in every split. Behind
    state, as after dedup, Spark drops REBALANCE; there ``hour_writers`` gathers each hour in that many
    tasks, by hash.
    """
    folders = (["client_id"] if by_client else []) + ["dt", "hour"]
    placed = with_landing_hour(raw)
    if not hour_writers:
        placed = placed.hint("rebalance", *folders)
    else:
        share = F.pmod(F.xxhash64("client_id", "screen_id", "event_time"), F.lit(hour_writers))
        placed = placed.withColumn("_share", share).repartition("dt", "hour", "_share").drop("_share")
    writer = placed.writeStream.format(file_format).partitionBy(*folders)
    return (
        writer.option("path", base)
        .option("checkpointLocation", checkpoint)
        .option("maxRecordsPerFile", records_per_file)
        .option("compression", "snappy" if file_format == "parquet" else "none")
        .trigger(**_trigger(every))
        .start()
    )


def _each_batch(
    stream: DataFrame, write: Callable, checkpoint: str, every: str | None, timers: bool = False
) -> StreamingQuery:
    """Start a stream that writes by micro-batch. One with processing-time timers would go on with empty
    micro-batches for ever; where it is to stop after what is available, it runs none."""
    writer = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**_trigger(every))
    if not timers:
        return writer.start()
    spark, setting = stream.sparkSession, "spark.sql.streaming.noDataMicroBatches.enabled"
    before = spark.conf.get(setting, "true")
    spark.conf.set(setting, before if every else "false")
    try:
        return writer.outputMode("update").start()
    finally:
        spark.conf.set(setting, before)


def _append_balanced(rows: Callable[[DataFrame], DataFrame], batch: DataFrame, path: str, batch_id: int, by: list[str]) -> None:
    """Write ``rows`` of a micro-batch as few files of a folder, a folder too big for a task in several.

    Spark turns adaptive execution off for a stream with state, and REBALANCE is then dropped without a word: every
    task of the last shuffle writes into every folder. The state's own plan is fixed before a micro-batch is
    handed over, so adaptive execution is on for what is written of it, and as it was again after.
    """
    spark, setting = batch.sparkSession, "spark.sql.adaptive.enabled"
    before = spark.conf.get(setting, "true")
    spark.conf.set(setting, "true")
    try:
        append_delta(rows(batch).hint("rebalance", *by), path, batch_id, by)
    finally:
        spark.conf.set(setting, before)


def _listen_deltas(batch: DataFrame) -> DataFrame:
    return batch.groupBy("user_id", "day", "song_id").agg(F.count(F.lit(1)).alias("delta"))


def upsert_history(listens: DataFrame, path: str, checkpoint: str, every: str | None = COUNT_EVERY) -> StreamingQuery:
    """Listen events into the history table; read it with ``read_history``.

    Rows carry their position in the micro-batch, so of two versions of a key the later written wins. A
    log keeps a key in one partition, where positions rise in the order of the log.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = history_rows(batch).withColumn("position", F.monotonically_increasing_id())
        append_delta(rows, path, batch_id, ["day"])

    return _each_batch(listens, write, checkpoint, every)


def read_history(spark: SparkSession, path: str, base: str | None = None, folded: int | None = None) -> DataFrame:
    rows = current_history(read_deltas(spark, path, HISTORY_DELTA, base, folded))
    return rows.select("user_id", "day", "listened_at", "event_id", "song_id", "provider")


def increment_counters(events: DataFrame, path: str, checkpoint: str, every: str | None = COUNT_EVERY) -> StreamingQuery:
    """Add (user, day, song) counts of deduplicated events; read them with ``read_counters``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        _append_balanced(_listen_deltas, batch, path, batch_id, ["day"])

    return _each_batch(events, write, checkpoint, every)


def read_counters(spark: SparkSession, path: str, base: str | None = None, folded: int | None = None) -> DataFrame:
    return sum_deltas(read_deltas(spark, path, COUNTER_DELTA, base, folded))


def stream_hourly_counts(raw: DataFrame, path: str, checkpoint: str, every: str | None = COUNT_EVERY) -> StreamingQuery:
    """Running hourly cells; read them with ``read_hourly_counts``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        counts = lambda rows: heatmap_hourly(rows).withColumn("dt", F.to_date("bucket_start"))
        _append_balanced(counts, batch, path, batch_id, ["dt"])

    return _each_batch(raw, write, checkpoint, every)


def read_hourly_counts(spark: SparkSession, path: str, base: str | None = None, folded: int | None = None) -> DataFrame:
    deltas = read_deltas(spark, path, HOURLY_DELTA, base, folded)
    return deltas.groupBy(*KEYS).agg(F.sum("count").cast("bigint").alias("count"))


def count_with_bloom(
    listens: DataFrame, counters: str, checkpoint: str, first_layer: int = bloom_state.FIRST_LAYER,
    shares: int = bloom_state.SHARES, keep_days: float = bloom.KEEP_DAYS, every: str | None = COUNT_EVERY,
) -> StreamingQuery:
    """Counters behind the approximate dedup: events that hit the day's filter are skipped.

    The filter is state: per day and share of its ids, layers of growing size and tightening error, so a day
    may bring any number of ids. A day is remembered for ``keep_days`` after the last arrival of its
    events, so a wrong date touches its own day only, and a replay of old days is known as long as they
    keep coming in.
    """
    use_rocksdb_state(listens.sparkSession)
    fresh = bloom_state.fresh_events(listen_day(listens), first_layer, shares, keep_days)

    def write(batch: DataFrame, batch_id: int) -> None:
        _append_balanced(_listen_deltas, batch, counters, batch_id, ["day"])

    return _each_batch(fresh, write, checkpoint, every, timers=True)


def thin_events_stream(
    events: DataFrame, path: str, checkpoint: str, rate: float | None = None,
    keys: tuple[str, ...] = ("client_id", "screen_id"), time: str = "event_time", order: tuple[str, ...] = (),
    forget_ms: int | None = None, every: str | None = COUNT_EVERY,
) -> StreamingQuery:
    """Cap the event rate per (client, screen) across micro-batches; read with ``read_thinned``.

    Events may arrive in any order; the result is that of ``thin_events`` over all of them. They are kept in
    the state store, on disk, from where late ones are set beside their neighbours. With ``forget_ms`` a key
    that has brought nothing for so long, by arrival, drops its events and keeps its last kept time only:
    events that come later than that, but are of a time before it, are no longer kept. Order columns are
    numbers, strings, times or booleans.
    """
    use_rocksdb_state(events.sparkSession)
    gap = spacing.gap_for_rate(rate)
    verdicts = spacing_state.verdicts(events, list(keys), time, list(order), gap, forget_ms)

    def write(batch: DataFrame, batch_id: int) -> None:
        append_delta(batch, path, batch_id, [])

    return _each_batch(verdicts, write, checkpoint, every, timers=True)


def read_thinned(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spacing_state.kept_rows(read_deltas(spark, path, spacing_state.VERDICT), schema)


def apply_status_stream(events: DataFrame, path: str, checkpoint: str, every: str | None = COUNT_EVERY) -> StreamingQuery:
    """Fold each micro-batch of status events; read the current schedule with ``read_schedule``."""

    def write(batch: DataFrame, batch_id: int) -> None:
        fold_status_events(batch).write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return _each_batch(events, write, checkpoint, every)


def read_schedule(spark: SparkSession, path: str, base: str | None = None, folded: int | None = None) -> DataFrame:
    return schedule_rows(merge_status(read_deltas(spark, path, STATUS_DELTA, base, folded)))


# Compaction: delta folders up to batch ``upto`` folded into a table at a new path. Readers then take
# that path as ``base`` and ``upto`` as ``folded``; the stream goes on writing meanwhile.

def _upto(spark: SparkSession, path: str, schema: T.StructType, upto: int) -> DataFrame:
    return read_deltas(spark, path, schema).filter(F.col("batch") <= upto)


def compact_counters(spark: SparkSession, path: str, target: str, upto: int) -> None:
    totals = sum_deltas(_upto(spark, path, COUNTER_DELTA, upto)).withColumnRenamed("listen_count", "delta")
    compact(totals, target, ["day"], ["user_id", "song_id"])


def compact_history(spark: SparkSession, path: str, target: str, upto: int) -> None:
    """Each day's files are sorted by user, newest first inside."""
    rows = current_history(_upto(spark, path, HISTORY_DELTA, upto))
    compact(rows.withColumn("age", -F.unix_micros("listened_at")), target, ["day"], ["user_id", "age", "event_id"])


def compact_hourly_counts(spark: SparkSession, path: str, target: str, upto: int) -> None:
    totals = _upto(spark, path, HOURLY_DELTA, upto).groupBy("dt", *KEYS).agg(F.sum("count").cast("bigint").alias("count"))
    compact(totals, target, ["dt"], KEYS)


def compact_status(spark: SparkSession, path: str, target: str, upto: int) -> None:
    compact(merge_status(_upto(spark, path, STATUS_DELTA, upto)), target, [], ["user_id", "provider"])
