"""Time arithmetic that does not depend on the session time zone."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

_EPOCH = "timestamp_ntz'1970-01-01 00:00:00'"


def _since_epoch(unit: str, ts: Column) -> Column:
    return F.timestamp_diff(unit, F.expr(_EPOCH), ts)


def epoch_micros(ts: Column) -> Column:
    return _since_epoch("MICROSECOND", ts)


def epoch_seconds(ts: Column) -> Column:
    return _since_epoch("SECOND", ts)


def minutes_between(start: Column, end: Column) -> Column:
    """Whole elapsed minutes: 50 s to 70 s is 0, not 1."""
    return F.timestamp_diff("MINUTE", start, end)


def epoch_to_date(value: Column, unit: str = "seconds") -> Column:
    """Date of an epoch number. The unit is explicit: millis read as seconds are silently wrong."""
    per_day = {"seconds": 86_400, "millis": 86_400_000}[unit]
    return F.date_add(F.lit("1970-01-01").cast("date"), F.floor(value / per_day).cast("int"))
