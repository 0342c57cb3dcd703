"""Text rules: blanks and whole numbers."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_blanks(text: Column) -> Column:
    """Trim Unicode white space, not only the ASCII space."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+\z", "")


def is_blank(text: Column) -> Column:
    """Missing, empty, or nothing but white space."""
    return F.coalesce(~text.rlike(r"(?U)\S"), F.lit(True))


def whole_number(value: Column, source_type: str, target_type: str) -> Column:
    """Number or whole-number text as ``target_type``; NULL when it is neither or does not fit."""
    if source_type != "string":
        # Fractions are cut, as for a JSON number that arrives as a double.
        return value.try_cast(target_type)
    return F.when(value.rlike(r"^[+-]?[0-9]+\z"), value.try_cast("bigint")).try_cast(target_type)
