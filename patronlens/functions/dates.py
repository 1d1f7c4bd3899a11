"""Run dates and day arithmetic. The run date is always an argument, never the clock."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_run_date(value: str | date | datetime) -> date:
    """Accept a date, a datetime or an ISO ``YYYY-MM-DD`` string."""
    match value:
        case datetime():
            return value.date()
        case date():
            return value
        case str():
            return date.fromisoformat(value)
    raise TypeError(f"a run date is a date, datetime or ISO string, not {type(value).__name__}")


def days_before(run_date: date, days: int) -> Column:
    return F.lit(run_date - timedelta(days=days))


def whole_days_until(run_date: date, day: Column) -> Column:
    """``run_date - day`` in days; negative when the day lies after the run date."""
    return F.datediff(F.lit(run_date), day)


def micros_between(start: Column, end: Column) -> Column:
    """Elapsed microseconds as a decimal, ready for exact division."""
    elapsed = F.unix_micros(end.cast("timestamp")) - F.unix_micros(start.cast("timestamp"))
    return elapsed.cast("decimal(18,0)")
