"""Binning pointer events into the grid, and cells back into pixels."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridtally.functions import as_instant, cell_index, cell_to_pixel, day_of, normalized

# The default grid and the one event type that is counted.
GRID_W, GRID_H = 100, 200
COUNTED_TYPE = "mousemove"


def normalize_coords(
    df: DataFrame, width: float, height: float, left: float = 0.0, top: float = 0.0,
    x: str = "x_px", y: str = "y_px",
) -> DataFrame:
    """Add x_norm and y_norm for pixel positions on a ``width`` × ``height`` surface."""
    return df.withColumns(
        {"x_norm": normalized(F.col(x), left, width), "y_norm": normalized(F.col(y), top, height)}
    )


def filter_event_type(df: DataFrame, event_type: str = COUNTED_TYPE) -> DataFrame:
    return df.filter(F.col("event_type") == event_type)


def grid_cell(df: DataFrame, grid_w: int = GRID_W, grid_h: int = GRID_H) -> DataFrame:
    """Add cell_x and cell_y; a NULL coordinate gives a NULL cell."""
    return df.withColumns(
        {"cell_x": cell_index(F.col("x_norm"), grid_w), "cell_y": cell_index(F.col("y_norm"), grid_h)}
    )


def assign_bucket(df: DataFrame, unit: str, time: str = "event_time") -> DataFrame:
    """Add bucket_start, the start of the hour, day or Monday week of ``time``."""
    if unit not in ("hour", "day", "week"):
        raise ValueError("invalid_bucket_unit")
    instant = as_instant(F.col(time), df.schema[time].dataType.simpleString())
    return df.withColumn("bucket_start", F.date_trunc(unit, instant))


def listen_day(df: DataFrame) -> DataFrame:
    """Unix seconds to the UTC day and a timestamp, both added next to the original."""
    return df.withColumns(
        {"day": day_of(F.col("listened_at")), "listened_ts": F.timestamp_seconds("listened_at")}
    )


def cells_to_pixels(
    cells: DataFrame, width: float, height: float, grid_w: int = GRID_W, grid_h: int = GRID_H
) -> DataFrame:
    """Add the pixel of each cell's centre."""
    return cells.withColumns(
        {
            "x": cell_to_pixel(F.col("cell_x"), grid_w, width),
            "y": cell_to_pixel(F.col("cell_y"), grid_h, height),
        }
    )


def intensity_scale(
    cells: DataFrame, keys: tuple[str, ...] = ("client_id", "screen_id", "bucket_start")
) -> DataFrame:
    """Add max_count, never below 1, and intensity = count / max_count per response.

    One window partition is one response, which the grid bounds to grid_w × grid_h cells.
    """
    peak = F.max("count").over(Window.partitionBy(*keys))
    return cells.withColumn(
        "max_count", F.when(peak > 1, peak).otherwise(F.lit(1)).cast("bigint")
    ).withColumn("intensity", F.col("count").cast("double") / F.col("max_count"))
