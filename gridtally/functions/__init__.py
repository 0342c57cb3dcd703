"""Column expressions shared by the operators; all built-in functions, no Python workers."""

from gridtally.functions.coords import cell_index, cell_to_pixel, clamp, normalized
from gridtally.functions.texts import is_blank, strip_blanks, whole_number
from gridtally.functions.times import as_instant, day_of, is_rfc3339, parse_rfc3339, utc_text

__all__ = [
    "as_instant", "cell_index", "cell_to_pixel", "clamp", "day_of", "is_blank", "is_rfc3339", "normalized",
    "parse_rfc3339", "strip_blanks", "utc_text", "whole_number",
]
