"""Calendar arithmetic on DATE columns, free of time zones."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def date_key(d: Column) -> Column:
    """``20240131`` for 31 January 2024."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.day(d)).cast("int")


def week_start(d: Column) -> Column:
    """The Monday of the ISO week."""
    return F.trunc(d, "week")


def week_in_month(d: Column) -> Column:
    """1 for the first seven days of the month, 2 for the next seven, …"""
    return (F.floor((F.day(d) - 1) / 7) + 1).cast("int")


def day_of_week(d: Column) -> Column:
    """Monday is 1, Sunday is 7."""
    return (F.weekday(d) + 1).cast("int")


def is_weekend(d: Column) -> Column:
    return F.weekday(d) >= 5


def is_weekday(d: Column) -> Column:
    return F.weekday(d) < 5


def days_between(first: Column, last: Column) -> Column:
    """One array entry per day, null (so no rows once exploded) if there is none."""
    return F.when(first <= last, F.sequence(first, last))


def coverage_end(last_visit: Column, last_snapshot: Column) -> Column:
    """The last visit, but not past the month of the newest capacity snapshot."""
    return F.least(last_visit, F.last_day(last_snapshot))


def occupancy_rate(attendance: Column, deskcount: Column) -> Column:
    """Attendance per desk; no rate without a positive desk count."""
    return F.when(deskcount > 0, attendance.cast("double") / deskcount.cast("double"))
