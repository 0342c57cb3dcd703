"""Streaming forms, run over the whole input with ``availableNow`` and read back as tables.

Each has the same expected result as its batch form.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridtally import schemas
from gridtally.functions import utc_text
from gridtally.operators import ingest
from gridtally.plans import ingest_streams
from gridtally.session import work_path
from gridtally.sources import event_log, raw_files
from gridtally.streaming import sinks, streams
from workload import views
from workload.queries_heatmap import _FAST, TIER, _LANDED, _spaced_sql
from workload.queries_listens import _SCHEDULE_COLUMNS
from workload.registry import query


#: Files, and so micro-batches, that a table arrives in.
ARRIVALS = 6
ROW_GROUP_BYTES = 4 << 20


def _arriving(spark, rows: DataFrame) -> DataFrame:
    """Rows as a stream of several micro-batches, dealt out in turn: out of time order, copies apart."""
    folder = work_path(spark, "arrivals")
    # A row group is read by one task: with small ones a micro-batch of one file is still read by many.
    rows.repartition(ARRIVALS).write.option("parquet.block.size", ROW_GROUP_BYTES).parquet(folder)
    return event_log.read_file_stream(spark, folder, rows.schema, files_per_batch=1)


def _replayed(spark, d) -> DataFrame:
    return _arriving(spark, views.listens_replayed(spark, d))


def _finish(running: StreamingQuery) -> None:
    running.awaitTermination()


def _events(spark, d):
    return _arriving(spark, views.timed_events(views.table(spark, d, "events")))


def _raw_text(rows):
    raw = views.raw_from(rows).drop("event_id")
    return raw.withColumns({c: utc_text(F.col(c)) for c in ("event_time", "received_at")})


@query("land_events", _LANDED)
def _(spark, d):
    base = raw_files.raw_base(work_path(spark, "landed-stream"), "parquet")
    _finish(sinks.land_events(_raw_text(_events(spark, d)), base, work_path(spark, "cp"), "parquet", every=None))
    return raw_files.read_raw_parquet(spark, base)


@query("admit_batches", f"""WITH {views.BATCH_EVENTS} SELECT client_id, screen_id, batch_id,
  {views.TEXT_TIME.format('event_time')} AS event_time, x_norm, y_norm, event_type,
  CAST(event_time AS DATE) AS dt, CAST(hour(event_time) AS INTEGER) AS hour FROM sent WHERE (event_id // 100) % 13 <> 0""")
def _(spark, d):
    """Batches sent twice: validated, deduplicated, exploded and landed."""
    arrived, base = work_path(spark, "batches"), raw_files.raw_base(work_path(spark, "admitted"), "parquet")
    sent = views.replayed(views.batches(spark, d))
    sent.repartition(ARRIVALS).write.parquet(arrived)
    for running in ingest_streams.admit_batches(
        lambda: event_log.read_file_stream(spark, arrived, sent.schema, files_per_batch=1), base, work_path(spark, "quarantine"),
        work_path(spark, "cp"), "parquet", every=None, hour_writers=1,
    ):
        _finish(running)
    return raw_files.read_raw_parquet(spark, base).drop("received_at")


@query("land_events_json", _LANDED)
def _(spark, d):
    base = raw_files.raw_base(work_path(spark, "landed-stream"))
    _finish(sinks.land_events(_raw_text(_events(spark, d)), base, work_path(spark, "cp"), every=None))
    return raw_files.read_raw_json(spark, base)


@query("read_event_stream", f"WITH {views.LISTENS} SELECT event_id, user_id, song_id, provider, listened_at FROM listens")
def _(spark, d):
    """Keyed JSON records as a file stream, decoded on the way into a table."""
    log, out = work_path(spark, "log"), work_path(spark, "decoded")
    event_log.encode_listens(views.listens(spark, d)).repartition(ARRIVALS).write.parquet(log)
    decoded, _ = ingest.decode_log(event_log.read_file_stream(spark, log, files_per_batch=1), schemas.LISTEN_EVENT)
    writer = decoded.writeStream.format("parquet").option("path", out).option("checkpointLocation", work_path(spark, "cp"))
    _finish(writer.trigger(availableNow=True).start())
    return spark.read.schema(schemas.LISTEN_EVENT).parquet(out)


@query("upsert_history", f"""WITH {views.LISTENS} SELECT user_id, day, CAST(make_timestamp(listened_at * 1000000) AS TIMESTAMP) AS listened_at,
  event_id, song_id, provider FROM listens""")
def _(spark, d):
    path = work_path(spark, "history")
    _finish(sinks.upsert_history(_replayed(spark, d), path, work_path(spark, "cp"), every=None))
    return sinks.read_history(spark, path)


@query("increment_counters", f"WITH {views.LISTENS} SELECT user_id, day, song_id, count(*) AS listen_count FROM replayed GROUP BY ALL")
def _(spark, d):
    """Counters without dedup in front: replays count, as the counter itself has no memory."""
    path = work_path(spark, "counters")
    rows = _replayed(spark, d)
    days = rows.withColumn("day", F.to_date(F.timestamp_seconds("listened_at")))
    _finish(sinks.increment_counters(days, path, work_path(spark, "cp"), every=None))
    return sinks.read_counters(spark, path)


@query("dedup_batches_stream", f"WITH {views.BATCH_EVENTS} SELECT client_id, screen_id, batch_id, n FROM batch")
def _(spark, d):
    out = work_path(spark, "unique-batches")
    slim = views.batches(spark, d).withColumn("n", F.size("events").cast("bigint")).drop("events")
    # Copies differ in arrival only, and which of one micro-batch is kept is not defined.
    unique = streams.dedup_batches_stream(_arriving(spark, views.replayed(slim)))
    writer = unique.writeStream.format("parquet").option("path", out).option("checkpointLocation", work_path(spark, "cp"))
    _finish(writer.trigger(availableNow=True).start())
    return spark.read.schema("client_id string, screen_id string, batch_id string, n bigint").parquet(out)


@query("dedup_events_stream", f"WITH {views.LISTENS} SELECT day, event_id, user_id, song_id, provider, listened_at FROM listens")
def _(spark, d):
    out = work_path(spark, "unique-events")
    unique = streams.dedup_events_stream(_replayed(spark, d))
    writer = unique.drop("listened_ts").writeStream.format("parquet").option("path", out)
    _finish(writer.option("checkpointLocation", work_path(spark, "cp")).trigger(availableNow=True).start())
    return spark.read.schema("event_id string, user_id string, song_id string, provider string, listened_at bigint, day date").parquet(out)


@query("stream_hourly_counts", f"WITH {views.HOURLY} SELECT {TIER} FROM hourly")
def _(spark, d):
    path = work_path(spark, "hourly-deltas")
    _finish(sinks.stream_hourly_counts(views.raw_from(_events(spark, d)), path, work_path(spark, "cp"), every=None))
    return sinks.read_hourly_counts(spark, path)


@query("stream_daily_counts", f"WITH {views.DAILY_COUNTS} SELECT user_id, day, song_id, listen_count FROM daily_counts")
def _(spark, d):
    """Dedup by event, then 30-second counter flushes."""
    path = work_path(spark, "counters")
    unique = streams.dedup_events_stream(_replayed(spark, d))
    _finish(sinks.increment_counters(unique, path, work_path(spark, "cp"), every=None))
    return sinks.read_counters(spark, path)


@query("apply_status_stream", f"WITH {views.STATUS} SELECT {_SCHEDULE_COLUMNS} FROM schedule")
def _(spark, d):
    path = work_path(spark, "status")
    changes = _arriving(spark, views.status_events(spark, d))
    _finish(sinks.apply_status_stream(changes, path, work_path(spark, "cp"), every=None))
    return sinks.read_schedule(spark, path)


@query("thin_events_stream", _spaced_sql("1 SECOND", _FAST))
def _(spark, d):
    """The month played 3600 times as fast, at most one event per second and screen."""
    path = work_path(spark, "thinned")
    raw = views.raw_from(_events(spark, d))
    fast = F.timestamp_micros(F.expr("unix_micros(event_time) div 3600")).alias("event_time")
    moves = raw.select("client_id", "screen_id", fast, "event_id")
    _finish(sinks.thin_events_stream(moves, path, work_path(spark, "cp"), rate=1, order=("event_id",), every=None))
    return sinks.read_thinned(spark, path, moves.schema)


@query("bloom_counters", f"WITH {views.DAILY_COUNTS} SELECT user_id, day, song_id, listen_count FROM daily_counts")
def _(spark, d):
    """Counters behind the Bloom filter, which at its planned size makes no mistake on this data."""
    counters = work_path(spark, "counters")
    rows = _replayed(spark, d)
    _finish(sinks.count_with_bloom(rows, counters, work_path(spark, "cp"), every=None))
    return sinks.read_counters(spark, counters)
