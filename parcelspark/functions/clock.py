"""Clock rules shared by all reports.

Event times arrive as epoch seconds and are used as local wall-clock values. They are
TIMESTAMP_NTZ throughout, so no result depends on the session time zone.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, functions as F

EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def _hours(n: int) -> Column:
    return F.expr(f"INTERVAL {int(n)} HOURS")


def event_ts(ctime: Column | str, offset_seconds: int) -> Column:
    """Local wall-clock time of an epoch-seconds column."""
    seconds = (F.col(ctime) if isinstance(ctime, str) else ctime) + F.lit(offset_seconds)
    return F.timestamp_add("SECOND", seconds, F.expr(EPOCH))


def epoch_of(day: date, offset_seconds: int, hours: int = 0) -> int:
    """Epoch seconds at which local `day` + `hours` begins: lets a date window reach the
    scan as a plain comparison on the stored column."""
    midnight = datetime(day.year, day.month, day.day, tzinfo=timezone.utc)
    return int(midnight.timestamp()) + hours * 3600 - offset_seconds


def day_lit(day: date) -> Column:
    return F.lit(date(day.year, day.month, day.day))


def moment(at: datetime) -> Column:
    """A wall-clock literal. Given as text: a Python datetime would pass through a time zone."""
    return F.lit(at.replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp_ntz")


def days_before(as_of: date, n: int) -> date:
    return date(as_of.year, as_of.month, as_of.day) - timedelta(days=n)


def midnight(day: Column) -> Column:
    return day.cast("timestamp_ntz")


def business_day(ts: Column, shift_hours: int) -> Column:
    """The day that began at `shift_hours` o'clock."""
    return (ts - _hours(shift_hours)).cast("date")


def deadline(day: Column, days: int, hours: int) -> Column:
    return midnight(day) + _hours(24 * days + hours)


def on_time(ts: Column, day: Column, days: int, hours: int) -> Column:
    """'ontime' up to and including the deadline; NULL after it or without a time."""
    return F.when(ts <= deadline(day, days, hours), "ontime")


def late(ts: Column, day: Column, days: int, hours: int, label: str = "late") -> Column:
    return F.when(ts > deadline(day, days, hours), label)


def aging_days(ts: Column, as_of: date) -> Column:
    """Calendar days from the event up to `as_of`, both ends counted."""
    return F.datediff(day_lit(as_of), ts.cast("date")) + 1


def elapsed(unit: str, start: Column, end: Column) -> Column:
    """Whole elapsed units, cut toward zero."""
    return F.timestamp_diff(unit, start, end)


def next_iso_week(ts: Column) -> Column:
    return F.weekofyear(ts) + 1


def zero_as_missing(ctime: Column) -> Column:
    return F.when(ctime != 0, ctime)


def iso_timestamp(text: Column) -> Column:
    """ISO-8601 text to its wall-clock value; the zone is dropped, not applied."""
    return text.cast("timestamp_ntz")
