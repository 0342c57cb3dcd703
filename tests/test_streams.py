"""Streaming forms over files that arrive one by one, with restarts and repeated micro-batches."""

import random
from datetime import datetime, timedelta
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridtally import schemas
from gridtally.operators import bloom, keyed, listens, rollups, spacing
from gridtally.plans import ingest_streams, listen_jobs
from gridtally.sources import event_log, raw_files, tables
from gridtally.streaming import bloom_state, sinks, spacing_state, streams
from workload import views

SF = "/root/testdata/sf0.001"


def _rows(df, *columns):
    return sorted(tuple(map(repr, r)) for r in (df.select(*columns) if columns else df).collect())


def _arrive(df, folder, time, parts=3):
    """Write ``df`` in time order as ``parts`` files; yields after each, as new data would come in."""
    spark = df.sparkSession
    cuts = [None] + df.approxQuantile("_t", [i / parts for i in range(1, parts)], 0.0) + [None]
    for low, high in zip(cuts[:-1], cuts[1:]):
        part = df
        if low is not None:
            part = part.filter(F.col("_t") >= low)
        if high is not None:
            part = part.filter(F.col("_t") < high)
        part.drop("_t").coalesce(1).write.mode("append").parquet(folder)
        yield spark


def _timed(df, time):
    return df.withColumn("_t", F.col(time).cast("timestamp").cast("double") if time != "listened_at" else F.col(time).cast("double"))


def _run(query):
    query.awaitTermination()


def test_counters_survive_restarts_and_replayed_batches(spark, path):
    rows = _timed(views.listens_replayed(spark, SF), "listened_at")
    for _ in _arrive(rows, path("in"), "listened_at"):
        # a new query object each time: restarted from the checkpoint
        source = event_log.read_file_stream(spark, path("in"), schemas.LISTEN_EVENT)
        _run(sinks.increment_counters(streams.dedup_events_stream(source), path("counters"), path("cp"), every=None))
    expected = listens.daily_song_counts(views.listens_replayed(spark, SF))
    columns = ("user_id", "day", "song_id", "listen_count")
    assert _rows(sinks.read_counters(spark, path("counters")), *columns) == _rows(expected, *columns)

    # the last micro-batch written once more under its own id changes nothing
    stored = tables.read_deltas(spark, path("counters"), sinks.COUNTER_DELTA)
    last = stored.agg(F.max("batch")).first()[0]
    again = stored.filter(F.col("batch") == last).drop("batch")
    tables.append_delta(spark.createDataFrame(again.collect(), again.schema), path("counters"), last, ["day"])
    assert _rows(sinks.read_counters(spark, path("counters")), *columns) == _rows(expected, *columns)

    served = listen_jobs.serve_topk(spark, path("counters"), views.EVENTS_AS_OF)
    assert _rows(served) == _rows(listens.user_topk(expected, views.EVENTS_AS_OF).select(served.columns))
    one = served.first().user_id
    only = listen_jobs.serve_topk(spark, path("counters"), views.EVENTS_AS_OF, user_id=one)
    assert _rows(only) == _rows(served.filter(F.col("user_id") == one))
    for upto in (0, last):
        sinks.compact_counters(spark, path("counters"), path(f"compact{upto}"), upto)
        both = sinks.read_counters(spark, path("counters"), path(f"compact{upto}"), upto)
        assert _rows(both, *columns) == _rows(expected, *columns)
    from_base = listen_jobs.serve_topk(spark, path("counters"), views.EVENTS_AS_OF, base=path("compact0"), folded=0)
    assert _rows(from_base) == _rows(served)


def test_history_upserts(spark, path):
    base = datetime(2024, 1, 1, 12)
    seconds = int((base - datetime(1970, 1, 1)).total_seconds())
    first = [("e1", "u", "old song", "p", seconds), ("e2", "u", "s2", "p", seconds + 1)]
    second = [("e1", "u", "new song", "p", seconds), ("e1", "u", "s3", "p", seconds + 9), ("e1", "v", "s1", "p", seconds)]
    for rows in (first, second):
        spark.createDataFrame(rows, schemas.LISTEN_EVENT).coalesce(1).write.mode("append").parquet(path("in"))
        source = event_log.read_file_stream(spark, path("in"), schemas.LISTEN_EVENT)
        _run(sinks.upsert_history(source, path("history"), path("cp"), every=None))
    out = {(r.user_id, r.event_id, r.listened_at): r.song_id for r in sinks.read_history(spark, path("history")).collect()}
    assert out == {
        ("u", "e1", base): "new song", ("u", "e2", base + timedelta(seconds=1)): "s2",
        ("u", "e1", base + timedelta(seconds=9)): "s3", ("v", "e1", base): "s1",
    }
    for upto in (0, 1):
        sinks.compact_history(spark, path("history"), path(f"compact{upto}"), upto)
        from_base = sinks.read_history(spark, path("history"), path(f"compact{upto}"), upto)
        assert {(r.user_id, r.event_id, r.listened_at): r.song_id for r in from_base.collect()} == out


def test_log_consumers_and_reconciliation(spark, path):
    rows = views.listens_replayed(spark, SF)
    event_log.encode_listens(rows).write.parquet(path("log"))
    spark.createDataFrame([("u", "{broken")], schemas.LOG_RECORD).write.mode("append").parquet(path("log"))
    for query in listen_jobs.consume_log(
        lambda: event_log.read_file_stream(spark, path("log")), path("history"), path("counters"), path("cp"), every=None
    ):
        _run(query)
    assert listen_jobs.reconcile(spark, path("history"), path("counters")).isEmpty()
    tables.append_delta(
        spark.createDataFrame([("u", "s", 5, datetime(2024, 1, 1).date())], sinks.COUNTER_DELTA), path("counters"), 99, ["day"]
    )
    off = listen_jobs.reconcile(spark, path("history"), path("counters")).collect()
    assert [(r.user_id, r.exact_n, r.approx_n) for r in off] == [("u", 0, 5)]


def test_hourly_counts_over_several_files(spark, path):
    raw = views.raw_events(spark, SF)
    schema = raw.schema
    for _ in _arrive(_timed(raw, "event_time"), path("in"), "event_time"):
        source = event_log.read_file_stream(spark, path("in"), schema)
        _run(sinks.stream_hourly_counts(source, path("deltas"), path("cp"), every=None))
    columns = (*rollups.KEYS, "count")
    expected = _rows(rollups.heatmap_hourly(raw), *columns)
    assert _rows(sinks.read_hourly_counts(spark, path("deltas")), *columns) == expected
    sinks.compact_hourly_counts(spark, path("deltas"), path("compact"), 1)
    assert _rows(sinks.read_hourly_counts(spark, path("deltas"), path("compact"), 1), *columns) == expected


def test_status_stream(spark, path):
    changes = _timed(views.status_events(spark, SF), "ts")
    for _ in _arrive(changes, path("in"), "ts"):
        source = event_log.read_file_stream(spark, path("in"), schemas.STATUS_EVENT)
        _run(sinks.apply_status_stream(source, path("status"), path("cp"), every=None))
    expected = keyed.apply_status_events(views.status_events(spark, SF))
    assert _rows(sinks.read_schedule(spark, path("status"))) == _rows(expected)
    sinks.compact_status(spark, path("status"), path("compact"), 1)
    assert _rows(sinks.read_schedule(spark, path("status"), path("compact"), 1)) == _rows(expected)


def test_batch_dedup_stream_over_restarts(spark, path):
    slim = views.batches(spark, SF).drop("events")
    replays = views.replayed(slim)
    blanks = slim.limit(5).withColumn("batch_id", F.lit(""))
    whole = replays.unionByName(blanks).unionByName(blanks)
    whole.write.parquet(path("all"))
    whole = spark.read.parquet(path("all"))
    for _ in _arrive(_timed(whole, "received_at"), path("in"), "received_at"):
        source = event_log.read_file_stream(spark, path("in"), whole.schema)
        writer = streams.dedup_batches_stream(source).writeStream.format("parquet").option("path", path("out"))
        _run(writer.option("checkpointLocation", path("cp")).trigger(availableNow=True).start())
    out = spark.read.parquet(path("out"))
    assert out.filter("batch_id = ''").count() == 10
    kept = out.filter("batch_id <> ''")
    assert _rows(kept, "client_id", "batch_id") == _rows(slim.select("client_id", "batch_id").distinct())


@pytest.mark.parametrize("file_format", ["json", "parquet"])
def test_admission_end_to_end(spark, path, file_format):
    sent = views.replayed(views.batches(spark, SF))
    sent.write.parquet(path("in"))
    base = raw_files.raw_base(path("lake"), file_format)
    for query in ingest_streams.admit_batches(
        lambda: event_log.read_file_stream(spark, path("in"), sent.schema), base, path("quarantine"), path("cp"), file_format, None
    ):
        _run(query)
    good = views.batch_events(spark, SF).filter("event_id div 100 % 13 <> 0")
    landed = raw_files._read(spark, base, file_format, None, None)
    assert landed.count() == good.count()
    columns = (*rollups.KEYS, "count")
    assert _rows(rollups.heatmap_hourly(landed), *columns) == _rows(rollups.heatmap_hourly(good), *columns)
    rejected = spark.read.parquet(path("quarantine"))
    assert {r.reason for r in rejected.select("reason").distinct().collect()} == {"invalid_normalized_coords"}
    at_hour = landed.filter(F.date_trunc("hour", F.col("event_time").cast("timestamp")) != F.make_timestamp(
        F.year("dt"), F.month("dt"), F.dayofmonth("dt"), F.col("hour"), F.lit(0), F.lit(0)))
    assert at_hour.isEmpty()


def test_landing_by_client_and_small_files(spark, path):
    rows = spark.range(12_000).selectExpr(
        "'c' AS client_id", "'s' AS screen_id", "'b' AS batch_id", "'2024-01-01T05:00:00Z' AS event_time",
        "0.1D AS x_norm", "0.2D AS y_norm", "'mousemove' AS event_type", "cast(null AS string) AS received_at",
    )
    rows.coalesce(1).write.parquet(path("in"))
    source = event_log.read_file_stream(spark, path("in"), schemas.RAW_EVENT)
    _run(sinks.land_events(source, path("out"), path("cp"), "parquet", None, by_client=True))
    files = spark.read.parquet(path("out")).inputFiles()
    assert len(files) >= 3 and all("client_id=c/dt=2024-01-01/hour=05" in f for f in files)


def test_thinning_goes_on_across_micro_batches(spark, path, few_tasks):
    fast = F.timestamp_micros(F.expr("unix_micros(event_time) div 36000")).alias("event_time")
    moves = views.raw_events(spark, SF).select("client_id", "screen_id", fast, "event_id")
    for _ in _arrive(_timed(moves, "event_time"), path("in"), "event_time", parts=5):
        source = event_log.read_file_stream(spark, path("in"), moves.schema)
        _run(sinks.thin_events_stream(source, path("out"), path("cp"), rate=2, order=("event_id",), every=None))
    expected = spacing.thin_events(moves, rate=2, order=("event_id",))
    assert 0 < expected.count() < moves.count()
    assert _rows(sinks.read_thinned(spark, path("out"), moves.schema)) == _rows(expected)


def test_thinning_takes_late_events_in(spark, path, few_tasks):
    """Files out of time order, ties and a far time: the same rows as from all events at once."""
    at = datetime(2024, 1, 10)
    schema = "client_id string, screen_id string, event_time timestamp, event_id long"
    row = lambda screen, seconds, n: (None if screen == "b" else "c", screen, at + timedelta(seconds=seconds), n)
    parts = [
        [row("a", 100, 1), row("b", 400 * 86400, 2), row("a", 103, 3)],
        [row("a", 10, 4), row("a", 99.5, 5), row("b", 0, 6), row("b", 0.5, 7), row("b", 70, 8)],
        [row("a", 100.2, 9), row("a", 103, 0), row("n", 1, 10), ("c", "a", None, 11)],
        [row("a", 104.5, 12), row("b", 0.2, 13), row("n", 5, 14)],  # a in time, b late
    ]
    _in_turn(
        spark, parts, path("in"), schema,
        lambda s: sinks.thin_events_stream(s, path("out"), path("cp"), rate=1, order=("event_id",), every=None),
    )
    everything = spark.createDataFrame([r for part in parts for r in part], schema)
    expected = spacing.thin_events(everything, rate=1, order=("event_id",))
    assert sorted(r.event_id for r in expected.collect()) == [0, 2, 4, 5, 6, 8, 10, 12, 14]
    assert _rows(sinks.read_thinned(spark, path("out"), everything.schema)) == _rows(expected)


def test_bloom_counters_across_micro_batches(spark, path, few_tasks):
    rows = _timed(views.listens_replayed(spark, SF), "listened_at")
    # every file arrives twice, so the second copy has to be caught by the stored filter
    for n, _ in enumerate(_arrive(rows, path("in"), "listened_at")):
        spark.read.schema(schemas.LISTEN_EVENT).parquet(path("in")).write.parquet(path(f"copy{n}"))
    for n in range(3):
        spark.read.schema(schemas.LISTEN_EVENT).parquet(path(f"copy{n}")).coalesce(1).write.mode("append").parquet(path("replay"))
        source = event_log.read_file_stream(spark, path("replay"), schemas.LISTEN_EVENT)
        _run(sinks.count_with_bloom(source, path("counters"), path("cp"), shares=4, every=None))
    expected = listens.daily_song_counts(views.listens_replayed(spark, SF))
    stored = sinks.read_counters(spark, path("counters")).select(expected.columns)
    assert _rows(stored) == _rows(expected)


def test_bloom_counters_grow_with_their_day(spark, path, few_tasks):
    """Forty times a first layer's ids in one day, each sent twice: never too many, hardly too few."""
    first, shares, n = 64, 2, 5120
    for part in range(4):
        rows = spark.range(n).filter(f"id % 2 = {part % 2}").selectExpr(
            "concat('e', id) AS event_id", "'u' AS user_id", "concat('s', id % 7) AS song_id", "'p' AS provider", "1704067200L + id % 1000 AS listened_at"
        )
        rows.coalesce(1).write.mode("append").parquet(path("in"))
        source = event_log.read_file_stream(spark, path("in"), schemas.LISTEN_EVENT)
        _run(sinks.count_with_bloom(source, path("counters"), path("cp"), first, shares, every=None))
    counted = sinks.read_counters(spark, path("counters")).agg(F.sum("listen_count")).first()[0]
    assert n * (1 - 2 * bloom.ERROR_RATE) <= counted <= n


def test_layers_keep_their_error_as_they_grow():
    rng = np.random.default_rng(4)
    ids = rng.integers(0, 1 << 63, 20 * 1000, dtype=np.uint64)
    layers, left = [], ids
    while len(left):
        layers.append(bloom_state.Layer(len(layers), 1000))
        layers[-1].add(left[: layers[-1].capacity])
        left = left[layers[-1].capacity :]
    held = lambda x: np.logical_or.reduce([layer.holds(x) for layer in layers])
    assert len(layers) == 5 and held(ids).all()
    assert held(rng.integers(0, 1 << 63, 200_000, dtype=np.uint64)).mean() <= bloom.ERROR_RATE


def test_bloom_counters_forget_an_idle_day(spark, path, few_tasks):
    _in_turn(
        spark, [PARTS[0], PARTS[0]], path("in"), schemas.LISTEN_EVENT,
        lambda s: sinks.count_with_bloom(s, path("counters"), path("cp"), shares=1, keep_days=1e-9, every=None),
    )
    assert sum(r.listen_count for r in sinks.read_counters(spark, path("counters")).collect()) in (5, 10)


def test_crash_after_the_write_does_not_count_twice(spark, path, monkeypatch):
    """The first attempt dies after its delta is on disk and before the batch is committed."""
    views.listens(spark, SF).coalesce(1).write.parquet(path("in"))
    source = lambda: streams.dedup_events_stream(event_log.read_file_stream(spark, path("in"), schemas.LISTEN_EVENT))

    def dies(*args):
        tables.append_delta(*args)
        raise RuntimeError("executor lost")

    monkeypatch.setattr(sinks, "append_delta", dies)
    with pytest.raises(Exception, match="executor lost"):
        _run(sinks.increment_counters(source(), path("counters"), path("cp"), every=None))
    monkeypatch.undo()
    _run(sinks.increment_counters(source(), path("counters"), path("cp"), every=None))
    expected = listens.daily_song_counts(views.listens(spark, SF))
    columns = ("user_id", "day", "song_id", "listen_count")
    assert _rows(sinks.read_counters(spark, path("counters")), *columns) == _rows(expected, *columns)


def _in_turn(spark, parts, folder, schema, run):
    """Each part arrives as one more file; the stream is restarted for it."""
    for rows in parts:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
        _run(run(event_log.read_file_stream(spark, folder, schema)))


@pytest.fixture
def few_tasks(spark):
    """State operators start Python workers in every task of every micro-batch."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


def _in_batches(spark, parts, folder, schema, run):
    """Each part is a micro-batch of one run."""
    for rows in parts:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)
    _run(run(event_log.read_file_stream(spark, folder, schema, files_per_batch=1)))


def _listen(number, day, song="s"):
    return (f"e{number}", "u", song, "p", int((datetime(2024, 1, day) - datetime(1970, 1, 1)).total_seconds()))


FAR = ("far", "u", "s", "p", 1_900_000_000)
PARTS = [
    [_listen(n, 20 + n) for n in range(5)],
    [FAR, _listen(5, 28)],
    [_listen(n, n - 5) for n in range(6, 10)],  # weeks older
    [_listen(0, 20), _listen(6, 1), FAR],  # replays of all three kinds
    [_listen(10, 30)],
    [_listen(10, 30), _listen(11, 2)],
]


def test_event_dedup_loses_and_repeats_nothing(spark, path):
    _in_turn(
        spark, PARTS, path("in"), schemas.LISTEN_EVENT,
        lambda s: sinks.increment_counters(streams.dedup_events_stream(s), path("counters"), path("cp"), every=None),
    )
    assert sum(r.listen_count for r in sinks.read_counters(spark, path("counters")).collect()) == 13


def test_bloom_counters_know_replays_of_any_day(spark, path, few_tasks):
    _in_turn(
        spark, PARTS, path("in"), schemas.LISTEN_EVENT,
        lambda s: sinks.count_with_bloom(s, path("counters"), path("cp"), shares=2, every=None),
    )
    assert sum(r.listen_count for r in sinks.read_counters(spark, path("counters")).collect()) == 13


def test_batch_dedup_keeps_batches_of_any_time(spark, path):
    at = datetime(2024, 1, 10)
    schema = "client_id string, screen_id string, batch_id string, received_at timestamp"
    parts = [[("c", "s", "b1", at)], [("c", "s", "b2", at + timedelta(days=400)), ("c", "s", "", at)], [("c", "s", "b3", at - timedelta(days=90)), ("c", "s", "b1", at), ("c", "s", "", at)]]

    def run(source):
        writer = streams.dedup_batches_stream(source).writeStream.format("parquet").option("path", path("out"))
        return writer.option("checkpointLocation", path("cp")).trigger(availableNow=True).start()

    _in_turn(spark, parts, path("in"), schema, run)
    assert sorted(r.batch_id for r in spark.read.parquet(path("out")).collect()) == ["", "", "b1", "b2", "b3"]


def test_thinning_with_idle_new_and_odd_keys(spark, path, few_tasks):
    at = datetime(2024, 1, 10)
    schema = "client_id string, screen_id string, event_time timestamp, event_id long"
    row = lambda screen, seconds, n: ("c", screen, at + timedelta(seconds=seconds), n)
    parts = [
        [row("a", 0, 1), row("a", 0.4, 2), row("b", 0, 3)],
        [row("a", 0.9, 4), row("a", 1.2, 5)],  # b is idle
        [row("n", 0, 6), row("b", 400 * 86400, 7)],  # a new key; a far time
        [row("a", 1.5, 8), row("a", 2.2, 9), row("b", 0.5, 10)],
    ]
    _in_turn(
        spark, parts, path("in"), schema,
        lambda s: sinks.thin_events_stream(s, path("out"), path("cp"), rate=1, order=("event_id",), every=None),
    )
    out = sinks.read_thinned(spark, path("out"), spark.createDataFrame([], schema).schema)
    assert sorted(r.event_id for r in out.collect()) == [1, 3, 5, 6, 7, 9]


def test_the_later_of_two_versions_in_one_micro_batch_wins(spark, path):
    for name, rows in (("up", ["a", "z"]), ("down", ["z", "a"])):
        events = spark.createDataFrame([("e", "u", song, "p", 1_700_000_000) for song in rows], schemas.LISTEN_EVENT)
        events.coalesce(1).write.parquet(path(f"in-{name}"))
        source = event_log.read_file_stream(spark, path(f"in-{name}"), schemas.LISTEN_EVENT)
        _run(sinks.upsert_history(source, path(name), path(f"cp-{name}"), every=None))
        assert [r.song_id for r in sinks.read_history(spark, path(name)).collect()] == [rows[-1]]


@pytest.mark.parametrize("leaf", [4, 4096])
def test_thinning_equals_brute_force_whatever_the_order_of_arrival(spark, path, few_tasks, monkeypatch, leaf):
    """Dense and sparse keys, ties, late events and times before 1970, in leaves of any size."""
    monkeypatch.setattr(spacing_state, "LEAF_EVENTS", leaf)
    rng = random.Random(leaf)
    base = datetime(1970, 1, 1)
    schema = "client_id string, screen_id string, event_time timestamp, event_id long, note double"
    rows = [
        ("c" if rng.random() < 0.8 else None, rng.choice(["a", "a", "b"]), base + timedelta(milliseconds=100 * rng.randint(-300, 300)), n, rng.choice([None, 0.1, 1e300]))
        for n in range(400)
    ]
    expected = []
    for key in {r[:2] for r in rows}:
        last = None
        for r in sorted((r for r in rows if r[:2] == key), key=lambda r: (r[2], r[3])):
            if last is None or r[2] - last >= timedelta(seconds=1):
                expected.append(r[3])
                last = r[2]
    parts = [rows[k::5] for k in range(5)] + [[("c", "a", None, 999, None)]]
    _in_batches(
        spark, parts, path("in"), schema,
        lambda s: sinks.thin_events_stream(s, path("out"), path("cp"), rate=1, order=("event_id",), every=None),
    )
    out = sinks.read_thinned(spark, path("out"), spark.createDataFrame([], schema).schema).collect()
    assert sorted(r.event_id for r in out) == sorted(expected)
    by_id = {r[3]: r for r in rows}
    assert all(tuple(r) == by_id[r.event_id] for r in out)


def test_spacing_from_every_last_kept_time():
    rng = random.Random(1)
    for _ in range(300):
        at = sorted(rng.randint(0, 60) for _ in range(rng.randint(0, 25)))
        for last in range(-12, 70):
            kept, leave = spacing_state.spaced(at, 10, last)
            plain, here = [], last
            for k, t in enumerate(at):
                if t >= here + 10:
                    plain.append(k)
                    here = t
            assert np.flatnonzero(kept).tolist() == plain and leave == here


def test_a_forgotten_key_keeps_its_last_kept_time(spark, path, few_tasks):
    at = datetime(2024, 1, 10)
    schema = "client_id string, screen_id string, event_time timestamp, event_id long"
    row = lambda seconds, n: ("c", "a", at + timedelta(seconds=seconds), n)
    _in_turn(
        spark, [[row(0, 1), row(5, 2)], [("c", "z", at, 3)], [row(5.5, 4), row(6, 5), row(2, 6)]], path("in"), schema,
        lambda s: sinks.thin_events_stream(s, path("out"), path("cp"), rate=1, order=("event_id",), forget_ms=1, every=None),
    )
    out = sinks.read_thinned(spark, path("out"), spark.createDataFrame([], schema).schema)
    assert {1, 2, 3, 5} <= {r.event_id for r in out.collect()} <= {1, 2, 3, 5, 6}


def _files(folder, below=""):
    return [str(f) for f in Path(folder).glob(f"{below}**/*.parquet")]


@pytest.mark.parametrize("counted", ["bloom", "exact"])
def test_counters_of_a_stateful_stream_write_a_day_once(spark, path, few_tasks, counted):
    """Two tasks hold events of each of three days: a file a day and micro-batch, not one a task."""
    rows = spark.range(600).selectExpr(
        "concat('e', id) AS event_id", "concat('u', id) AS user_id", "'s' AS song_id", "'p' AS provider",
        "1704067200L + 86400 * (id % 3) AS listened_at",
    )
    rows.coalesce(1).write.parquet(path("in"))
    source = event_log.read_file_stream(spark, path("in"), schemas.LISTEN_EVENT)
    if counted == "bloom":
        _run(sinks.count_with_bloom(source, path("counters"), path("cp"), shares=8, every=None))
    else:
        _run(sinks.increment_counters(streams.dedup_events_stream(source), path("counters"), path("cp"), every=None))
    assert len(_files(path("counters"), "batch=0/")) == 3
    assert sinks.read_counters(spark, path("counters")).agg(F.sum("listen_count")).first()[0] == 600


def test_landing_gathers_an_hour_of_several_splits(spark, path):
    """Four files of one micro-batch hold the same three hours: the tasks that read them do not each write all."""
    rows = spark.range(400).selectExpr(
        "'c' AS client_id", "'s' AS screen_id", "'b' AS batch_id", "concat('2024-01-01T0', id % 3, ':00:00Z') AS event_time",
        "0.1D AS x_norm", "0.2D AS y_norm", "'mousemove' AS event_type", "cast(null AS string) AS received_at",
    )
    rows.repartition(4).write.parquet(path("in"))
    source = event_log.read_file_stream(spark, path("in"), schemas.RAW_EVENT)
    _run(sinks.land_events(source, path("out"), path("cp"), "parquet", None))
    assert len(spark.read.parquet(path("out")).inputFiles()) == 3
    assert spark.read.parquet(path("out")).count() == 400
