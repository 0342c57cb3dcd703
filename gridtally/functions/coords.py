"""Grid arithmetic on columns."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def clamp(value: Column, low, high) -> Column:
    """Limit to [low, high]; NULL stays NULL (``greatest``/``least`` would skip it)."""
    return F.when(value < F.lit(low), F.lit(low)).when(value > F.lit(high), F.lit(high)).otherwise(value)


def cell_index(norm: Column, size: int) -> Column:
    """Grid cell of a normalized coordinate; 1.0 belongs to the last cell.

    Clamped as a long before the cast, so a wild coordinate cannot overflow the int.
    """
    return clamp(F.floor(norm.cast("double") * F.lit(size)), 0, size - 1).cast("int")


def normalized(pixel: Column, origin, extent) -> Column:
    """Pixel position to [0, 1] within ``extent`` pixels starting at ``origin``."""
    return clamp((pixel.cast("double") - origin) / F.lit(extent).cast("double"), 0.0, 1.0)


def cell_to_pixel(cell: Column, size: int, extent) -> Column:
    """Pixel of a cell's centre on a surface ``extent`` pixels wide."""
    centre = (cell.cast("double") + F.lit(0.5)) / F.lit(size).cast("double")
    return F.floor(centre * F.lit(extent).cast("double")).cast("int")
