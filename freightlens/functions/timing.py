"""Elapsed time and calendar helpers (F-1 … F-10).

Differences are taken as intervals. That needs no time zone, so wall-clock
timestamps give the same hours in every session, also across a clock change.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hours_sql(start: str, end: str) -> str:
    """Whole hours from start to end, truncated toward zero, negative if end is earlier."""
    gap = f"({end} - {start})"
    return f"(24 * CAST(extract(DAY FROM {gap}) AS BIGINT) + extract(HOUR FROM {gap}))"


def whole_days_sql(start: str, end: str) -> str:
    return f"extract(DAY FROM ({end} - {start}))"


def days_between(start: str, end: str) -> Column:
    """Whole hours from start to end, as fractional days."""
    return F.expr(f"{hours_sql(start, end)} / 24D")


def month_of(ts: str) -> Column:
    """First day of the month of a timestamp, as a date."""
    return F.expr(f"trunc(CAST({ts} AS DATE), 'MM')")
