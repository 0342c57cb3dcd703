"""Request parameter rules. Broken ones raise ``ValueError`` with the published code."""

from __future__ import annotations

import re
from datetime import date, datetime

from gridtally.operators.ingest import SAFE_ID

# Defaults and bounds of the request parameters.
BUCKET_LIMITS = {"hourly": 24, "daily": 30, "weekly": 12}
MAX_BUCKET_LIMIT = 500
DEFAULT_DAYS, MAX_DAYS = 7, 30
DEFAULT_K, MAX_K = 10, 100


def safe_id(value: str, name: str) -> str:
    value = (value or "").strip()
    if not re.fullmatch(SAFE_ID, value):
        raise ValueError(f"invalid_{name}")
    return value


def day(value: str | date, name: str = "dt") -> date:
    if isinstance(value, date):
        return value
    try:
        if not re.fullmatch(r"\d{4}-\d{2}-\d{2}", value.strip()):
            raise ValueError
        return datetime.strptime(value.strip(), "%Y-%m-%d").date()
    except ValueError:
        raise ValueError(f"invalid_{name}") from None


def hour(value: str | int) -> int:
    number = _integer(value)
    if number is None or not 0 <= number <= 23:
        raise ValueError("invalid_hour")
    return number


def monday(value: str | date) -> date:
    """The weekly job insists on a Monday; the weekly query does not."""
    start = day(value, "week_start")
    if start.weekday() != 0:
        raise ValueError("week_start_not_monday")
    return start


def bucket_limit(value: str | int | None, tier: str) -> int:
    """1..500; anything else silently means the tier's default."""
    number = _integer(value)
    return number if number is not None and 1 <= number <= MAX_BUCKET_LIMIT else BUCKET_LIMITS[tier]


def window_days(value: str | int | None = None) -> int:
    return _bounded(value, DEFAULT_DAYS, MAX_DAYS, "days must be 1-30")


def top_k(value: str | int | None = None) -> int:
    return _bounded(value, DEFAULT_K, MAX_K, "k must be 1-100")


def _bounded(value, default: int, most: int, message: str) -> int:
    # Unlike the other parameters these two are not trimmed: a blank around the digits is no number.
    text = str(value if value is not None else "")
    number = _integer(text) if text == text.strip() else None
    number = default if number is None else number
    if not 1 <= number <= most:
        raise ValueError(message)
    return number


def _integer(value) -> int | None:
    text = str(value if value is not None else "").strip()
    number = int(text) if re.fullmatch(r"[+-]?[0-9]+", text) else None
    return number if number is not None and -(2**63) <= number < 2**63 else None
