"""The periodic heatmap jobs: each rebuilds whole buckets and may be rerun at any time."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtally.operators import params, rollups
from gridtally.session import saved
from gridtally.sources import files, jdbc, raw_files, tables


def hourly_job(spark: SparkSession, raw_base: str, hourly_path: str, dt, hour, file_format: str = "json") -> None:
    """One hour folder of raw events into the hourly table.

    The folder says which hour its rows count for, so a row whose own time does not parse counts too.
    """
    day, hh = params.day(dt), params.hour(hour)
    bucket = f"{day} {hh:02d}:00:00"
    raw = raw_files.at_folder_hour(raw_files.read_bucket_partition(spark, raw_base, day, hh, file_format))
    tables.replace_buckets(rollups.heatmap_hourly(raw), hourly_path, "hourly", [bucket])


def daily_job(spark: SparkSession, hourly_path: str, daily_path: str, dt) -> None:
    """One day of the hourly table into the daily table."""
    day = params.day(dt)
    hourly = tables.read_tier(spark, hourly_path, "hourly").filter(F.col("dt") == F.lit(day))
    tables.replace_buckets(rollups.heatmap_daily(hourly), daily_path, "daily", [f"{day} 00:00:00"])


def weekly_job(spark: SparkSession, daily_path: str, weekly_path: str, week_start) -> None:
    """Seven days of the daily table, Monday to Sunday, into the weekly table."""
    start = params.monday(week_start)
    in_week = F.col("dt").between(F.lit(start), F.lit(start + timedelta(days=6)))
    daily = tables.read_tier(spark, daily_path, "daily").filter(in_week)
    tables.replace_buckets(rollups.heatmap_weekly(daily), weekly_path, "weekly", [f"{start} 00:00:00"])


def backfill_job(
    spark: SparkSession, raw_base: str, hourly_path: str, daily_path: str, weekly_path: str, first, last,
    file_format: str = "json",
) -> None:
    """All hours of the days ``first`` to ``last`` in one pass, then their days and weeks."""
    low, high = params.day(first), params.day(last)
    raw = raw_files.at_folder_hour(raw_files.read_bucket_range(spark, raw_base, low, high, file_format))
    days = [low + timedelta(days=n) for n in range((high - low).days + 1)]
    hours = [f"{day} {hh:02d}:00:00" for day in days for hh in range(24)]
    tables.replace_buckets(rollups.heatmap_hourly(raw), hourly_path, "hourly", hours)
    _refresh_coarser(spark, hourly_path, daily_path, weekly_path, days)


def late_job(
    spark: SparkSession, raw_base: str, hourly_path: str, daily_path: str, weekly_path: str, run_start, run_end,
    file_format: str = "json",
) -> list[str]:
    """Recompute the hours that late events reached during the run window, and their days and weeks.

    Late events of any age are found: only files written since the window began are searched for them, in
    whatever folder. Then the folders of the touched hours, and no other, are read again.
    """
    recent = raw_files.at_folder_hour(raw_files.read_files_since(spark, raw_base, run_start, file_format))
    touched = saved(rollups.late_buckets(recent, run_start, run_end), "late-hours")
    # At most one row per hour of the data.
    hours = [row[0] for row in touched.select(F.date_format("bucket_start", "yyyy-MM-dd HH:mm:ss")).collect()]
    if not hours:
        return []
    days = [h[:10] for h in hours]
    raw = raw_files.at_folder_hour(raw_files.read_bucket_range(spark, raw_base, min(days), max(days), file_format))
    fixed = rollups.heatmap_hourly(rollups.in_folders_of(raw, touched, run_end))
    tables.replace_buckets(fixed, hourly_path, "hourly", hours)
    _refresh_coarser(spark, hourly_path, daily_path, weekly_path, sorted({_as_day(h) for h in hours}))
    return sorted(hours)


def _refresh_coarser(spark, hourly_path: str, daily_path: str, weekly_path: str, days: list[date]) -> None:
    hourly = _of_days(tables.read_tier(spark, hourly_path, "hourly"), days)
    tables.replace_buckets(rollups.heatmap_daily(hourly), daily_path, "daily", [f"{d} 00:00:00" for d in days])
    weeks = sorted({d - timedelta(days=d.weekday()) for d in days})
    owned = [w + timedelta(days=n) for w in weeks for n in range(7)]
    daily = _of_days(tables.read_tier(spark, daily_path, "daily"), owned)
    tables.replace_buckets(rollups.heatmap_weekly(daily), weekly_path, "weekly", [f"{w} 00:00:00" for w in weeks])


def _of_days(tier: DataFrame, days: list[date]) -> DataFrame:
    """Rows of the given days. They are a table, not a list in the plan, so years of them are no matter."""
    wanted = tier.sparkSession.createDataFrame([(d,) for d in days], "dt date")
    return tier.filter(F.col("dt").between(F.lit(min(days)), F.lit(max(days)))).join(wanted, "dt", "left_semi")


def expire_job(spark: SparkSession, paths: dict[str, str], as_of) -> dict[str, list[str]]:
    """Delete the folders of each table that are past its retention, and say which.

    ``paths`` are tables by their name in RETENTION_DAYS. Tiers have a folder per day (``dt``), history and
    counters one per micro-batch and day (``day``). Run again, it finds nothing more to delete.
    """
    removed = {}
    for name, path in paths.items():
        column = "dt" if name in tables.TIER_FOLDERS else "day"
        limit = _as_day(as_of) - timedelta(days=rollups.RETENTION_DAYS[name])
        removed[name] = files.older_folders(spark, path, column, str(limit))
        files.remove_folders(spark, path, removed[name])
    return removed


def daily_from_database(spark: SparkSession, options: dict[str, str], table: str, dt) -> DataFrame:
    """Daily rows computed from an hourly table kept in an external database."""
    return rollups.heatmap_daily(jdbc.read_day(spark, options, table, dt))


def weekly_from_database(spark: SparkSession, options: dict[str, str], table: str, week_start) -> DataFrame:
    return rollups.heatmap_weekly(jdbc.read_week(spark, options, table, week_start))


def _as_day(moment) -> date:
    if isinstance(moment, datetime):
        return moment.date()
    return moment if isinstance(moment, date) else params.day(str(moment)[:10])
