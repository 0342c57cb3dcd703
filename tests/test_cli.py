"""The jobs through their command line."""

import pytest

from gridtally import __main__ as cli
from gridtally import schemas
from gridtally.sources import raw_files, tables
from gridtally.streaming import sinks

RAW = [("acme", "home", "b", f"2024-01-0{d}T05:10:00Z", 0.25, 0.2, "mousemove", f"2024-01-0{d}T07:00:00Z") for d in (1, 2, 2)]


def test_heatmap_jobs(spark, path):
    raw = spark.createDataFrame(RAW, schemas.RAW_EVENT)
    bucket = path("bucket")
    raw_files.land_batch(raw, raw_files.raw_base(bucket, "parquet"), "parquet")
    tiers = ["--hourly-table", path("h"), "--daily-table", path("d"), "--weekly-table", path("w")]
    for day in ("2024-01-01", "2024-01-02"):
        cli.main(["hourly", "--bucket", bucket, "--format", "parquet", "--dt", day, "--hour", "05", "--hourly-table", path("h")])
        cli.main(["daily", "--dt", day, *tiers[:4]])
    cli.main(["weekly", "--week-start", "2024-01-01", *tiers[2:]])
    week = tables.read_tier(spark, path("w"), "weekly").collect()
    assert [(r.cell_x, r.cell_y, r["count"]) for r in week] == [(25, 40, 3)]

    extra = spark.createDataFrame(RAW[:1], schemas.RAW_EVENT)
    raw_files.land_batch(extra, raw_files.raw_base(bucket, "parquet"), "parquet")
    cli.main(["late", "--bucket", bucket, "--format", "parquet", "--run-start", "2024-01-01 06:30:00", "--run-end", "2024-01-01 08:00:00", *tiers])
    assert tables.read_tier(spark, path("w"), "weekly").first()["count"] == 4
    cli.main(["backfill", "--bucket", bucket, "--format", "parquet", "--first", "2024-01-02", "--last", "2024-01-02", *tiers])
    assert tables.read_tier(spark, path("w"), "weekly").first()["count"] == 4


def test_topk_job(spark, path):
    from datetime import date

    rows = spark.createDataFrame([("u", "a", 2, date(2024, 1, 30)), ("u", "b", 3, date(2024, 1, 29))], sinks.COUNTER_DELTA)
    tables.append_delta(rows, path("counters"), 0, ["day"])
    cli.main(["topk", "--counters", path("counters"), "--as-of", "2024-01-30", "--days", "2", "--k", "1", "--output", path("out")])
    assert [(r.song_id, r.rank) for r in spark.read.parquet(path("out")).collect()] == [("b", 1)]


def test_unknown_job():
    with pytest.raises(SystemExit):
        cli.main(["yearly"])
