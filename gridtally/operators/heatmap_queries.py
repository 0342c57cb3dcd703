"""Reads on the tiers: cells of a bucket, newest buckets, response rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridtally.operators import params
from gridtally.operators.grid import GRID_H, GRID_W

REQUEST = ["client_id", "screen_id", "bucket_start"]


def cells_for(tier: DataFrame, requests: DataFrame) -> DataFrame:
    """Cells of many requests at once; several rows of one cell are added up.

    Only rows of the requests are summed. A stored tier is joined on its folder columns too, so that
    folders nobody asked for are not read.
    """
    made = {"dt": F.to_date("bucket_start"), "hour": F.hour("bucket_start")}
    folders = [name for name in made if name in tier.columns]
    wanted = requests.select(*REQUEST).distinct().withColumns({name: made[name] for name in folders})
    asked = tier.join(wanted, [*REQUEST, *folders], "left_semi")
    return asked.groupBy(*REQUEST, "cell_x", "cell_y").agg(F.sum("count").cast("bigint").alias("count"))


def _one(tier: DataFrame, client_id: str, screen_id: str, bucket: str) -> DataFrame:
    wanted = (
        (F.col("client_id") == params.safe_id(client_id, "client_id"))
        & (F.col("screen_id") == params.safe_id(screen_id, "screen_id"))
        & (F.col("bucket_start") == F.lit(bucket).cast("timestamp"))
    )
    return tier.filter(wanted).groupBy("cell_x", "cell_y").agg(F.sum("count").cast("bigint").alias("count"))


def query_heatmap_hourly(tier: DataFrame, client_id: str, screen_id: str, dt, hour) -> DataFrame:
    day, hh = params.day(dt), params.hour(hour)
    rows = tier
    if "dt" in tier.columns:
        rows = tier.filter((F.col("dt") == F.lit(day)) & (F.col("hour") == hh))
    return _one(rows, client_id, screen_id, f"{day} {hh:02d}:00:00")


def query_heatmap_daily(tier: DataFrame, client_id: str, screen_id: str, dt) -> DataFrame:
    day = params.day(dt)
    rows = tier.filter(F.col("dt") == F.lit(day)) if "dt" in tier.columns else tier
    return _one(rows, client_id, screen_id, f"{day} 00:00:00")


def query_heatmap_weekly(tier: DataFrame, client_id: str, screen_id: str, week_start) -> DataFrame:
    """A day that is not a Monday is a valid request with no cells."""
    day = params.day(week_start, "week_start")
    rows = tier.filter(F.col("dt") == F.lit(day)) if "dt" in tier.columns else tier
    return _one(rows, client_id, screen_id, f"{day} 00:00:00")


def recent_buckets(tier: DataFrame, tier_name: str, limit=None) -> DataFrame:
    """Newest buckets with their event totals, ``limit`` for every (client, screen).

    Bucket totals are summed before ranking and Spark cuts each map task to ``limit`` rows per
    screen (WindowGroupLimit) before the ranking shuffle.
    """
    rows = params.bucket_limit(limit, tier_name)
    totals = tier.groupBy(*REQUEST).agg(F.sum("count").cast("bigint").alias("events"))
    newest = Window.partitionBy("client_id", "screen_id").orderBy(F.desc("bucket_start"))
    return totals.withColumn("_n", F.row_number().over(newest)).filter(F.col("_n") <= rows).drop("_n")


def recent_buckets_of(tier: DataFrame, tier_name: str, client_id: str, screen_id: str, limit=None) -> DataFrame:
    """The single-screen form: newest first."""
    wanted = (F.col("client_id") == params.safe_id(client_id, "ids")) & (
        F.col("screen_id") == params.safe_id(screen_id, "ids")
    )
    rows = tier.filter(wanted)
    totals = rows.groupBy("bucket_start").agg(F.sum("count").cast("bigint").alias("events"))
    return totals.orderBy(F.desc("bucket_start")).limit(params.bucket_limit(limit, tier_name))


def heatmap_payload(
    cells: DataFrame, grid_w: int = GRID_W, grid_h: int = GRID_H, requests: DataFrame | None = None
) -> DataFrame:
    """One nested row per (client, screen, bucket); empty cells and cells without a place are absent.

    With ``requests`` there is one row for each of them, with an empty list where nothing was
    counted. The list is bounded by the grid because ``cells`` has one row per cell.
    """
    placed = F.col("cell_x").isNotNull() & F.col("cell_y").isNotNull()
    # collect_list leaves out NULLs
    entry = F.when(placed, F.struct("cell_x", "cell_y", "count"))
    rows = cells.groupBy(*REQUEST).agg(F.array_sort(F.collect_list(entry)).alias("cells"))
    if requests is not None:
        asked = requests.select(*REQUEST).distinct().join(rows, REQUEST, "left")
        nothing = F.array().cast("array<struct<cell_x:int,cell_y:int,count:bigint>>")
        rows = asked.withColumn("cells", F.coalesce("cells", nothing))
    return rows.select(F.lit(grid_w).alias("grid_w"), F.lit(grid_h).alias("grid_h"), *REQUEST, "cells")


def as_json(payload: DataFrame, *order: str) -> DataFrame:
    """The response body as text, fields in the given order."""
    names = list(order) or payload.columns
    body = [
        F.date_format(n, "yyyy-MM-dd HH:mm:ss").alias(n) if n == "bucket_start" else F.col(n) for n in names
    ]
    return payload.withColumn("body", F.to_json(F.struct(*body), {"ignoreNullFields": "false"}))
