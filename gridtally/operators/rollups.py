"""Hourly, daily and weekly cell counts, and the repairs made on them.

Every tier is one hash aggregate. Partial counts are merged before the shuffle, so a screen that
holds a third of all events sends at most grid_w × grid_h rows per bucket from each map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridtally.functions import as_instant
from gridtally.operators.grid import GRID_H, GRID_W, assign_bucket, filter_event_type, grid_cell
from gridtally.session import saved

KEYS = ["client_id", "screen_id", "bucket_start", "cell_x", "cell_y"]

# How long each table keeps its rows, in days.
RETENTION_DAYS = {"hourly": 90, "daily": 730, "weekly": 1825, "history": 7, "counters": 8}


def heatmap_hourly(raw: DataFrame, grid_w: int = GRID_W, grid_h: int = GRID_H) -> DataFrame:
    """Raw events to counts per cell and hour, for however many hours ``raw`` holds."""
    cells = assign_bucket(grid_cell(filter_event_type(raw), grid_w, grid_h), "hour")
    return cells.groupBy(*KEYS).agg(F.count(F.lit(1)).alias("count"))


def roll_up(finer: DataFrame, unit: str) -> DataFrame:
    """Re-aggregate a finer tier into ``day`` or ``week`` buckets."""
    return (
        assign_bucket(finer, unit, "bucket_start")
        .groupBy(*KEYS)
        .agg(F.sum("count").cast("bigint").alias("count"))
    )


def heatmap_daily(hourly: DataFrame) -> DataFrame:
    return roll_up(hourly, "day")


def heatmap_weekly(daily: DataFrame) -> DataFrame:
    """Monday weeks."""
    return roll_up(daily, "week")


def event_range(raw: DataFrame, start, end) -> DataFrame:
    """Raw events with start ≤ event time < end; prunes dt= folders when ``raw`` has them."""
    low, high = F.lit(str(start)).cast("timestamp"), F.lit(str(end)).cast("timestamp")
    instant = as_instant(F.col("event_time"), raw.schema["event_time"].dataType.simpleString())
    kept = raw.filter((instant >= low) & (instant < high))
    if "dt" in raw.columns:
        kept = kept.filter((F.col("dt") >= F.to_date(low)) & (F.col("dt") <= F.to_date(high)))
    return kept


def backfill_range(raw: DataFrame, start, end) -> DataFrame:
    """Hourly counts of any range of buckets, recomputed from raw events in one pass."""
    return heatmap_hourly(event_range(raw, start, end))


def late_buckets(raw: DataFrame, run_start, run_end) -> DataFrame:
    """Event hours that got events during the run window after the hour itself had closed."""
    low, high = F.lit(str(run_start)).cast("timestamp"), F.lit(str(run_end)).cast("timestamp")
    received = as_instant(F.col("received_at"), raw.schema["received_at"].dataType.simpleString())
    arrived = filter_event_type(raw).filter((received >= low) & (received < high))
    hours = assign_bucket(arrived.withColumn("_received", received), "hour")
    late = hours.filter(F.col("_received") >= F.col("bucket_start") + F.expr("INTERVAL 1 HOUR"))
    return late.select("bucket_start").distinct()


def in_folders_of(raw: DataFrame, hours: DataFrame, before) -> DataFrame:
    """Raw events of the given hours, by folder; all of these hours start before ``before``.

    Stating that bound makes Spark prune folders at run time with the broadcast list of hours.
    """
    known = hours.filter(F.col("bucket_start") < F.lit(str(before)).cast("timestamp"))
    folders = known.select(F.to_date("bucket_start").alias("dt"), F.hour("bucket_start").alias("hour"))
    return raw.join(folders, ["dt", "hour"], "left_semi")


def reprocess_late(raw: DataFrame, hourly: DataFrame, run_start, run_end) -> dict[str, DataFrame]:
    """Corrected rows of just the hours, days and weeks touched by late arrivals.

    Only touched hours go back to raw events; days and weeks are re-added from the hourly tier with
    those hours swapped in. The list of touched hours is evaluated and saved first: it has at most
    one row per hour of the data, so the planner sees that it is small and raw events are never
    shuffled for it. Where raw events carry their dt= and hour= folders, only those are opened.
    """
    hours = saved(late_buckets(raw, run_start, run_end), "late-hours")
    if {"dt", "hour"} <= set(raw.columns):
        events = in_folders_of(raw, hours, run_end)
    else:
        events = assign_bucket(raw, "hour").join(hours, "bucket_start", "left_semi").drop("bucket_start")
    fixed = heatmap_hourly(events)
    current = hourly.select(*KEYS, "count").join(hours, "bucket_start", "left_anti").unionByName(fixed)

    def owning(unit: str) -> DataFrame:
        touched = hours.select(F.date_trunc(unit, "bucket_start").alias("_owner")).distinct()
        owned = current.withColumn("_owner", F.date_trunc(unit, "bucket_start"))
        return roll_up(owned.join(touched, "_owner", "left_semi").drop("_owner"), unit)

    return {"hourly": fixed, "daily": owning("day"), "weekly": owning("week")}


def rollup_compaction(hourly: DataFrame) -> DataFrame:
    """Rows per tier and the shrink factor from the tier below, in one chain of aggregates."""
    place = ["client_id", "screen_id", "cell_x", "cell_y"]
    days = (
        assign_bucket(hourly.select(*KEYS), "day", "bucket_start")
        .groupBy("bucket_start", *place)
        .agg(F.count(F.lit(1)).alias("hours"))
    )
    weeks = (
        assign_bucket(days, "week", "bucket_start")
        .groupBy("bucket_start", *place)
        .agg(F.count(F.lit(1)).alias("days"), F.sum("hours").alias("hours"))
    )
    total = weeks.agg(
        F.coalesce(F.sum("hours"), F.lit(0)).alias("h"),
        F.coalesce(F.sum("days"), F.lit(0)).alias("d"),
        F.count(F.lit(1)).alias("w"),
    )
    ratio = lambda a, b: F.when(F.col(b) > 0, F.col(a).cast("double") / F.col(b))
    tiers = F.array(
        F.struct(F.lit("hourly").alias("tier"), F.col("h").alias("rows"), F.lit(None).cast("double").alias("shrink")),
        F.struct(F.lit("daily").alias("tier"), F.col("d").alias("rows"), ratio("h", "d").alias("shrink")),
        F.struct(F.lit("weekly").alias("tier"), F.col("w").alias("rows"), ratio("d", "w").alias("shrink")),
    )
    return total.select(F.inline(tiers))


def expire_rows(df: DataFrame, time: str, as_of, keep_days: int) -> DataFrame:
    """Rows still within ``keep_days`` of ``as_of``. On a partition column this drops whole folders."""
    limit = F.lit(str(as_of)).cast("timestamp") - F.make_interval(days=F.lit(keep_days))
    kind = df.schema[time].dataType.simpleString()
    if kind == "date":
        return df.filter(F.col(time) >= F.to_date(limit))
    return df.filter(F.col(time) > limit)
