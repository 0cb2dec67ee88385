"""Calendar rules of the source dialect."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def add_months(day: Column, months: int) -> Column:
    """Month arithmetic in which a month end stays a month end."""
    moved = F.add_months(day, months)
    return F.when(day == F.last_day(day), F.last_day(moved)).otherwise(moved)


def months_between(later: Column, earlier: Column) -> Column:
    """Months apart, with a 31-day fraction unless both days agree or end a month."""
    return F.months_between(later, earlier)


def days_between(later: Column, earlier: Column) -> Column:
    """Whole days between two dates."""
    return F.datediff(later, earlier)


def seconds_of(moment: Column) -> Column:
    """Seconds since 1970 of a date or a moment without time zone, whatever the session's zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("SECOND", epoch, moment.cast("timestamp_ntz"))


def moment_of(seconds: Column) -> Column:
    return F.timestamp_add("SECOND", seconds, F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))


def exact_days_between(later: Column, earlier: Column) -> Column:
    """Days between two moments, with the part of a day."""
    return (seconds_of(later) - seconds_of(earlier)) / F.lit(86_400)
