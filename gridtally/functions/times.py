"""Time rules. The session zone is UTC (see ``gridtally.session``)."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted time shape, and the text form times are written in.
RFC3339_SHAPE = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}([.,]\d+)?(Z|[+-]([01]\d|2[0-4]):[0-5]\d)\z"
UTC_TEXT_PATTERN = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def _local_time(text: Column) -> Column:
    return F.substring(text, 1, 19).try_cast("timestamp")


def is_rfc3339(text: Column) -> Column:
    """Whether ``parse_rfc3339`` gives a time; cheaper, as it takes nothing apart."""
    return F.coalesce(text.rlike(RFC3339_SHAPE) & _local_time(text).isNotNull(), F.lit(False))


def parse_rfc3339(text: Column) -> Column:
    """Strict RFC 3339 text to a timestamp, NULL when the shape or the date is wrong.

    A plain cast would also take a bare date or a time without a zone.
    """
    local = _local_time(text)
    digits = F.rpad(F.regexp_extract(text, r"[.,](\d+)", 1), 6, "0").try_cast("bigint")
    sign = F.when(F.regexp_extract(text, r"([+-])\d{2}:\d{2}\z", 1) == "-", -1).otherwise(1)
    part = lambda i: F.coalesce(
        F.regexp_extract(text, r"[+-](\d{2}):(\d{2})\z", i).try_cast("bigint"), F.lit(0)
    )
    offset = sign * (part(1) * 60 + part(2)) * F.lit(60_000_000)
    return F.when(text.rlike(RFC3339_SHAPE), F.timestamp_micros(F.unix_micros(local) + digits - offset))


def as_instant(column: Column, source_type: str) -> Column:
    """An event time as a timestamp; text from landed files takes the cheap cast first."""
    if source_type == "string":
        return F.coalesce(column.try_cast("timestamp"), parse_rfc3339(column))
    return column.cast("timestamp")


def day_of(seconds: Column) -> Column:
    """UTC day of a unix time in seconds."""
    return F.to_date(F.timestamp_seconds(seconds))


def utc_text(ts: Column) -> Column:
    return F.date_format(ts, UTC_TEXT_PATTERN)
