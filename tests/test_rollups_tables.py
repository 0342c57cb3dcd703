import os
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gridtally import schemas
from gridtally.operators import heatmap_queries, rollups
from gridtally.plans import heatmap_jobs
from gridtally.sources import raw_files, tables
from workload import views

SF = "/root/testdata/sf0.001"


def _key(df):
    return sorted(tuple(r) for r in df.select(*rollups.KEYS, "count").collect())


@pytest.fixture(scope="module")
def hourly(spark):
    return rollups.heatmap_hourly(views.raw_events(spark, SF)).cache()


def test_tiers_hold_the_same_events(spark, hourly):
    daily = rollups.heatmap_daily(hourly)
    weekly = rollups.heatmap_weekly(daily)
    totals = [
        sorted(tuple(r) for r in t.groupBy("client_id", "screen_id").agg(F.sum("count")).collect())
        for t in (hourly, daily, weekly)
    ]
    assert totals[0] == totals[1] == totals[2]
    assert weekly.filter("date_format(bucket_start, 'E') <> 'Mon'").isEmpty()


def test_null_coordinates_are_their_own_cell(spark):
    rows = spark.createDataFrame(
        [("c", "s", "2024-01-01T00:00:00Z", None, 0.5, "mousemove")] * 2,
        "client_id string, screen_id string, event_time string, x_norm double, y_norm double, event_type string",
    )
    only = rollups.heatmap_hourly(rows).collect()
    assert [(r.cell_x, r.cell_y, r["count"]) for r in only] == [(None, 100, 2)]


def test_backfill_equals_the_full_run(spark, hourly):
    raw = views.raw_events(spark, SF)
    part = rollups.backfill_range(raw, "2024-01-10 05:00:00", "2024-01-12 00:00:00")
    expected = hourly.filter("bucket_start >= '2024-01-10 05:00:00' AND bucket_start < '2024-01-12'")
    assert _key(part) == _key(expected) and part.count() > 0


def test_retention_edges(spark):
    rows = spark.sql("SELECT explode(array(TIMESTAMP '2024-01-01 00:00:00', TIMESTAMP '2024-01-01 00:00:01')) AS t")
    kept = rollups.expire_rows(rows, "t", "2024-03-31 00:00:00", 90).collect()
    assert [r.t for r in kept] == [datetime(2024, 1, 1, 0, 0, 1)]
    days = spark.sql("SELECT explode(sequence(DATE '2024-01-01', DATE '2024-01-10')) AS day")
    assert rollups.expire_rows(days, "day", "2024-01-12 10:00:00", 8).count() == 7


def test_compaction_of_nothing(spark):
    empty = spark.createDataFrame([], schemas.TIER_ROW)
    assert [(r.tier, r.rows, r.shrink) for r in rollups.rollup_compaction(empty).collect()] == [
        ("hourly", 0, None), ("daily", 0, None), ("weekly", 0, None)
    ]


def _tier(spark, rows):
    return spark.createDataFrame(
        [("acme", "home", datetime.fromisoformat(t), x, 0, n) for t, x, n in rows], schemas.TIER_ROW
    )


def test_replace_bucket_reruns_and_empties(spark, path):
    table = path("hourly")
    ten, eleven = "2024-01-01 10:00:00", "2024-01-01 11:00:00"
    both = _tier(spark, [(ten, 1, 5), (ten, 2, 6), (eleven, 1, 7)])
    tables.replace_buckets(both, table, "hourly", [ten, eleven])
    for _ in range(2):
        tables.replace_buckets(both, table, "hourly", [ten])
        assert _key(tables.read_tier(spark, table, "hourly")) == _key(both)
    fewer = _tier(spark, [(ten, 2, 9)])
    tables.replace_buckets(fewer, table, "hourly", [ten])
    assert _key(tables.read_tier(spark, table, "hourly")) == _key(_tier(spark, [(ten, 2, 9), (eleven, 1, 7)]))
    tables.replace_buckets(_tier(spark, []), table, "hourly", [ten])
    assert _key(tables.read_tier(spark, table, "hourly")) == _key(_tier(spark, [(eleven, 1, 7)]))


def test_replace_bucket_ignores_rows_of_other_buckets_and_may_read_its_own_table(spark, path):
    table = path("hourly")
    ten, eleven = "2024-01-01 10:00:00", "2024-01-01 11:00:00"
    tables.replace_buckets(_tier(spark, [(ten, 1, 5), (eleven, 1, 7)]), table, "hourly", [ten, eleven])
    doubled = tables.read_tier(spark, table, "hourly").withColumn("count", F.col("count") * 2)
    tables.replace_buckets(doubled, table, "hourly", [ten])
    assert _key(tables.read_tier(spark, table, "hourly")) == _key(_tier(spark, [(ten, 1, 10), (eleven, 1, 7)]))


def test_failed_rewrite_leaves_the_bucket(spark, path):
    table, ten = path("hourly"), "2024-01-01 10:00:00"
    tables.replace_buckets(_tier(spark, [(ten, 1, 5)]), table, "hourly", [ten])
    broken = _tier(spark, [(ten, 1, 5)]).withColumn("count", F.raise_error(F.lit("lost")).cast("bigint"))
    with pytest.raises(Exception, match="lost"):
        tables.replace_buckets(broken, table, "hourly", [ten])
    assert _key(tables.read_tier(spark, table, "hourly")) == _key(_tier(spark, [(ten, 1, 5)]))


def test_queries_on_one_screen(spark, path):
    ten = "2024-01-01 10:00:00"
    rows = _tier(spark, [(ten, 1, 5), (ten, 1, 2), (ten, 3, 1), ("2024-01-02 10:00:00", 1, 1)])
    tables.write_tier(rows, path("t"), "hourly")
    stored = tables.read_tier(spark, path("t"), "hourly")
    for tier in (rows, stored):
        cells = heatmap_queries.query_heatmap_hourly(tier, " acme ", "home", "2024-01-01", "10")
        assert sorted(tuple(r) for r in cells.collect()) == [(1, 0, 7), (3, 0, 1)]
        newest = heatmap_queries.recent_buckets_of(tier, "hourly", "acme", "home", "1").collect()
        assert [(str(r.bucket_start), r.events) for r in newest] == [("2024-01-02 10:00:00", 1)]
    plan = heatmap_queries.query_heatmap_hourly(stored, "acme", "home", "2024-01-01", 10)
    assert len(plan.inputFiles()) >= 1
    with pytest.raises(ValueError, match="invalid_client_id"):
        heatmap_queries.query_heatmap_hourly(rows, "a b", "home", "2024-01-01", 10)
    with pytest.raises(ValueError, match="invalid_ids"):
        heatmap_queries.recent_buckets_of(rows, "hourly", "acme", "a/b")
    weekly = rollups.heatmap_weekly(rows)
    assert heatmap_queries.query_heatmap_weekly(weekly, "acme", "home", "2024-01-02").isEmpty()
    assert not heatmap_queries.query_heatmap_weekly(weekly, "acme", "home", "2024-01-01").isEmpty()
    daily = rollups.heatmap_daily(rows)
    assert heatmap_queries.query_heatmap_daily(daily, "acme", "home", "2024-01-02").first()["count"] == 1


def test_payload_of_requests(spark):
    ten = "2024-01-01 10:00:00"
    cells = _tier(spark, [(ten, 3, 1), (ten, 1, 2), (ten, None, 9)])
    asked = _tier(spark, [(ten, 0, 0), ("2024-01-01 11:00:00", 0, 0)])
    rows = {r.bucket_start.hour: r for r in heatmap_queries.heatmap_payload(cells, requests=asked).collect()}
    assert [tuple(c) for c in rows[10].cells] == [(1, 0, 2), (3, 0, 1)] and rows[11].cells == []
    assert (rows[10].grid_w, rows[10].grid_h) == (100, 200)
    only = heatmap_queries.heatmap_payload(_tier(spark, [(ten, None, 9)]))
    body = heatmap_queries.as_json(only).first().body
    assert body == (
        '{"grid_w":100,"grid_h":200,"client_id":"acme","screen_id":"home",'
        '"bucket_start":"2024-01-01 10:00:00","cells":[]}'
    )


def _physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_reads_are_pruned(spark, path):
    raw = spark.createDataFrame(
        [("c", "s", "b", f"2024-01-0{d}T0{h}:30:00Z", 0.1, 0.2, "mousemove", None) for d in (1, 2) for h in (1, 2)],
        schemas.RAW_EVENT,
    )
    raw_files.land_batch(raw, path("raw"), "parquet")
    one = raw_files.read_bucket_partition(spark, path("raw"), "2024-01-02", "01", "parquet")
    assert [r.event_time for r in one.collect()] == ["2024-01-02T01:30:00Z"]
    plan = _physical(rollups.heatmap_hourly(one))
    assert "PartitionFilters: [isnotnull(dt" in plan and "EqualTo(event_type,mousemove)" in plan
    assert "batch_id" not in plan.split("ReadSchema")[1]


def test_raw_base_swaps_only_the_default_folder():
    assert raw_files.raw_base("s3a://b/", "json") == "s3a://b/topics/heatmap.events.raw"
    assert raw_files.raw_base("s3a://b", "parquet", "/topics/") == "s3a://b/topics-parquet/heatmap.events.raw"
    assert raw_files.raw_base("s3a://b", "parquet", "mine", "t") == "s3a://b/mine/t"


def _raw_text(spark):
    text = lambda c: F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias(c)
    rows = views.raw_events(spark, SF).filter("event_time < '2024-01-10'")
    return rows.select("client_id", "screen_id", "batch_id", text("event_time"), "x_norm", "y_norm", "event_type", text("received_at"))


@pytest.mark.parametrize("file_format", ["json", "parquet"])
def test_jobs_from_landing_to_weeks(spark, path, file_format):
    raw = _raw_text(spark)
    base = raw_files.raw_base(path("lake"), file_format)
    raw_files.land_batch(raw, base, file_format)
    places = (path("h"), path("d"), path("w"))
    heatmap_jobs.hourly_job(spark, base, places[0], "2024-01-03", "05", file_format)
    expected = rollups.heatmap_hourly(raw)
    hour = expected.filter("bucket_start = '2024-01-03 05:00:00'")
    assert _key(tables.read_tier(spark, places[0], "hourly")) == _key(hour)

    heatmap_jobs.backfill_job(spark, base, *places, "2024-01-01", "2024-01-09", file_format)
    daily = rollups.heatmap_daily(expected)
    assert _key(tables.read_tier(spark, places[0], "hourly")) == _key(expected)
    assert _key(tables.read_tier(spark, places[1], "daily")) == _key(daily)
    assert _key(tables.read_tier(spark, places[2], "weekly")) == _key(rollups.heatmap_weekly(daily))

    heatmap_jobs.daily_job(spark, places[0], places[1], "2024-01-04")
    heatmap_jobs.weekly_job(spark, places[1], places[2], "2024-01-01")
    assert _key(tables.read_tier(spark, places[2], "weekly")) == _key(rollups.heatmap_weekly(daily))
    with pytest.raises(ValueError, match="week_start_not_monday"):
        heatmap_jobs.weekly_job(spark, places[1], places[2], "2024-01-02")


def _files_of(spark, table, day):
    return {f for f in spark.read.parquet(table).inputFiles() if f"dt={day}" in f}


def test_late_job_touches_only_what_it_must(spark, path):
    raw = _raw_text(spark)
    base = path("raw")
    run = ("2024-01-05 06:00:00", "2024-01-05 18:00:00")
    arrived = F.col("received_at").cast("timestamp")
    late = arrived >= F.date_trunc("hour", F.col("event_time").cast("timestamp")) + F.expr("INTERVAL 1 HOUR")
    in_run = (arrived >= F.lit(run[0]).cast("timestamp")) & (arrived < F.lit(run[1]).cast("timestamp"))
    raw_files.land_batch(raw.filter(~(late & in_run)), base)
    places = (path("h"), path("d"), path("w"))
    heatmap_jobs.backfill_job(spark, base, *places, "2024-01-01", "2024-01-09")
    untouched = _files_of(spark, places[0], "2024-01-02")
    raw_files.land_batch(raw.filter(late & in_run), base)
    hours = heatmap_jobs.late_job(spark, base, *places, *run)
    assert hours and all(run[0][:10] == h[:10] for h in hours)
    whole = rollups.heatmap_hourly(raw)
    assert _key(tables.read_tier(spark, places[0], "hourly")) == _key(whole)
    assert _key(tables.read_tier(spark, places[2], "weekly")) == _key(rollups.heatmap_weekly(whole))
    assert untouched and _files_of(spark, places[0], "2024-01-02") == untouched
    assert heatmap_jobs.late_job(spark, base, *places, "2024-03-01 00:00:00", "2024-03-02 00:00:00") == []


def test_reprocess_late_prunes_landed_folders(spark, path):
    raw_files.land_batch(_raw_text(spark), path("raw"), "parquet")
    landed = raw_files.read_raw_parquet(spark, path("raw"))
    run = ("2024-01-05 06:00:00", "2024-01-05 18:00:00")
    by_folder = rollups.reprocess_late(landed, rollups.heatmap_hourly(landed), *run)
    by_time = rollups.reprocess_late(landed.drop("dt", "hour"), rollups.heatmap_hourly(landed), *run)
    for tier in ("hourly", "daily", "weekly"):
        assert _key(by_folder[tier]) == _key(by_time[tier]) and by_folder[tier].count()
    assert "dynamicpruning" in _physical(by_folder["hourly"])


def test_work_folder_comes_from_the_session(spark):
    from gridtally.session import saved, work_path

    assert work_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    frame = spark.range(3)
    assert saved(frame, "x").dtypes == frame.dtypes and saved(frame, "x").count() == 3


def test_replacing_buckets_takes_as_many_jobs_for_two_as_for_hundreds(spark, path):
    rows = spark.createDataFrame([("c", "s", datetime(2024, 1, 1, 5), 0, 0, 3)], schemas.TIER_ROW)

    def jobs(count, name):
        hours = [datetime(2024, 1, 1) + timedelta(hours=n) for n in range(count)]
        tracker = spark.sparkContext.statusTracker()
        spark.sparkContext.setJobGroup(name, name)
        try:
            tables.replace_buckets(rows, path(name), "hourly", hours)
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        return len(tracker.getJobIdsForGroup(name))

    assert jobs(300, "many") <= jobs(6, "few") + 1
    assert tables.read_tier(spark, path("many"), "hourly").count() == 1
    tables.replace_buckets(rows.limit(0), path("many"), "hourly", [datetime(2024, 1, 1, 5)])
    assert not os.path.exists(path("many") + "/dt=2024-01-01/hour=5")


def test_readers_list_only_the_folders_asked_for(spark, path):
    schema = "client_id string, screen_id string, event_time string"
    rows = [("c", "s", f"2024-01-{d:02d}T{h:02d}:30:00Z") for d in (1, 2, 3) for h in range(24)]
    raw = spark.createDataFrame(rows, schema)
    for name in ("batch_id", "event_type", "received_at"):
        raw = raw.withColumn(name, F.lit("x"))
    raw = raw.withColumns({"x_norm": F.lit(0.5), "y_norm": F.lit(0.5)})
    raw_files.land_batch(raw, path("raw"))
    hour = raw_files.read_bucket_partition(spark, path("raw"), "2024-01-02", 7)
    assert hour.count() == 1 and len(hour._jdf.queryExecution().analyzed().collectLeaves().head().relation().location().inputFiles()) == 1
    days = raw_files.read_bucket_range(spark, path("raw"), "2024-01-02", "2024-02-20")
    assert days.count() == 48
    assert raw_files.read_bucket_partition(spark, path("raw"), "2025-01-02", 7).count() == 0


def test_the_hourly_job_counts_every_row_of_its_folder(spark, path):
    rows = [("c", "s", "b", t, 0.5, 0.5, "mousemove", t) for t in ("2024-01-02T07:10:00Z", "not a time")]
    names = ["client_id", "screen_id", "batch_id", "event_time", "x_norm", "y_norm", "event_type", "received_at"]
    spark.createDataFrame(rows, names).coalesce(1).write.json(path("raw") + "/dt=2024-01-02/hour=07")
    heatmap_jobs.hourly_job(spark, path("raw"), path("tier"), "2024-01-02", "07")
    assert [(str(r.bucket_start), r["count"]) for r in tables.read_tier(spark, path("tier"), "hourly").collect()] == [("2024-01-02 07:00:00", 2)]


def test_hourly_late_and_backfill_jobs_count_the_same(spark, path):
    """Events whose time does not parse, or is of another hour, count for their folder in each of the jobs."""
    times = ("2024-01-02T07:10:00Z", "not a time", None, "2024-01-05T01:00:00Z")
    rows = [("c", "s", "b", t, 0.5, 0.5, "mousemove", "2024-01-02T09:30:00Z") for t in times]
    spark.createDataFrame(rows, schemas.RAW_EVENT).coalesce(1).write.json(path("raw") + "/dt=2024-01-02/hour=07")
    counted = lambda name: [(str(r.bucket_start), r["count"]) for r in tables.read_tier(spark, path(name), "hourly").collect()]
    heatmap_jobs.hourly_job(spark, path("raw"), path("h1"), "2024-01-02", "07")
    heatmap_jobs.backfill_job(spark, path("raw"), path("h2"), path("d2"), path("w2"), "2024-01-01", "2024-01-03")
    tables.write_tier(spark.createDataFrame([], schemas.TIER_ROW), path("h3"), "hourly")
    tables.write_tier(spark.createDataFrame([], schemas.TIER_ROW), path("d3"), "daily")
    touched = heatmap_jobs.late_job(
        spark, path("raw"), path("h3"), path("d3"), path("w3"), "2024-01-02 09:00:00", "2024-01-02 10:00:00"
    )
    assert touched == ["2024-01-02 07:00:00"]
    assert counted("h1") == counted("h2") == counted("h3") == [("2024-01-02 07:00:00", 4)]


def test_late_job_opens_only_files_of_its_window(spark, path):
    """An old file that cannot be read is no matter, however old the hour is that a late event reaches."""
    event = lambda t, r: ("c", "s", "b", t, 0.5, 0.5, "mousemove", r)
    raw_files.land_batch(
        spark.createDataFrame([event("2020-06-01T05:10:00Z", "2024-01-02T09:30:00Z")], schemas.RAW_EVENT), path("raw"), "parquet"
    )
    os.makedirs(path("raw") + "/dt=2024-01-01/hour=03")
    broken = path("raw") + "/dt=2024-01-01/hour=03/part-0.parquet"
    with open(broken, "w") as file:
        file.write("not parquet")
    os.utime(broken, (1_704_000_000, 1_704_000_000))  # 2023-12-31
    for name, tier in (("h", "hourly"), ("d", "daily")):
        tables.write_tier(spark.createDataFrame([], schemas.TIER_ROW), path(name), tier)
    run = ("2024-01-02 09:00:00", "2024-01-02 10:00:00")
    hours = heatmap_jobs.late_job(spark, path("raw"), path("h"), path("d"), path("w"), *run, "parquet")
    assert hours == ["2020-06-01 05:00:00"]
    assert tables.read_tier(spark, path("w"), "weekly").first()["count"] == 1


def test_expired_folders_are_deleted(spark, path):
    """Folders past their retention go, those at its limit stay; a second run finds nothing."""
    paths = {name: path(name) for name in rollups.RETENTION_DAYS}
    as_of = datetime(2024, 6, 30)
    for name, keep in rollups.RETENTION_DAYS.items():
        for age in (0, keep, keep + 1, keep + 400):
            day = (as_of - timedelta(days=age)).date()
            if name in tables.TIER_FOLDERS:
                row = ("c", "s", datetime(day.year, day.month, day.day), 0, 0, 1)
                tables.write_tier(spark.createDataFrame([row], schemas.TIER_ROW), paths[name], name)
            else:
                rows = spark.createDataFrame([("u", day)], "user_id string, day date")
                tables.append_delta(rows, paths[name], age, ["day"])
    removed = heatmap_jobs.expire_job(spark, paths, as_of)
    assert {name: len(folders) for name, folders in removed.items()} == dict.fromkeys(paths, 2)
    assert tables.read_tier(spark, paths["hourly"], "hourly").count() == 2
    assert tables.read_deltas(spark, paths["history"], spark.createDataFrame([], "user_id string, day date").schema).count() == 2
    assert not any(heatmap_jobs.expire_job(spark, paths, "2024-06-30").values())


def test_cells_of_part_of_the_buckets(spark, path):
    from gridtally.operators import heatmap_queries

    rows = [("c", s, datetime(2024, 1, 1, h), x, 0, n + 1) for n, (s, h, x) in enumerate((s, h, x) for s in "ab" for h in (1, 2) for x in (0, 1))]
    tier = spark.createDataFrame(rows, schemas.TIER_ROW)
    asked = spark.createDataFrame(
        [("c", "a", datetime(2024, 1, 1, 2)), ("c", "b", datetime(2024, 1, 1, 3)), ("d", "a", datetime(2024, 1, 1, 1))],
        "client_id string, screen_id string, bucket_start timestamp",
    )
    assert sorted(r["count"] for r in heatmap_queries.cells_for(tier, asked).collect()) == [3, 4]
