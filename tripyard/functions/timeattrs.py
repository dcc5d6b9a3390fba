"""Calendar attributes of a UTC wall-clock timestamp."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def minutes_between(start: Column, end: Column) -> Column:
    """Whole minutes from start to end, truncated (TIMESTAMP_DIFF MINUTE)."""
    return F.timestamp_diff("MINUTE", start, end)


def seconds_between(start: Column, end: Column) -> Column:
    return F.timestamp_diff("SECOND", start, end)


def day_name(ts: Column) -> Column:
    """English day name, e.g. 'Saturday'."""
    return F.date_format(ts, "EEEE")


def is_weekend(ts: Column) -> Column:
    """Day-of-week 1 (Sunday) or 7 (Saturday)."""
    return F.dayofweek(ts).isin(1, 7)
