"""Delivery outcome (F-12, P-7)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from freightlens.functions.timing import whole_days_sql

# The outcomes in business order, with their display labels.
STATUS_LABELS = {
    "early": "Early",
    "on_time": "On time",
    "late_1_3_days": "1–3 days late",
    "late_4_7_days": "4–7 days late",
    "late_8_plus_days": "8+ days late",
    "not_delivered": "Not delivered",
}

# A prefix test, so that a new late class is late as well.
LATE = "startswith(delivery_status, 'late')"
ON_TIME = "delivery_status IN ('early', 'on_time')"
NOT_DELIVERED = "delivery_status = 'not_delivered'"


def delivery_status(arrived: str, due: str) -> Column:
    """Outcome of one order from its delivery and promise timestamps.

    ``slack`` counts whole days and is truncated toward zero, so two hours late
    is zero days late, which is still late. A missing promise compares as
    unknown everywhere and ends in the last class.
    """
    slack = whole_days_sql(arrived, due)
    return F.expr(
        f"""CASE
            WHEN {arrived} IS NULL THEN 'not_delivered'
            WHEN {slack} >= 1 THEN 'early'
            WHEN {arrived} <= {due} THEN 'on_time'
            WHEN {slack} >= -3 THEN 'late_1_3_days'
            WHEN {slack} >= -7 THEN 'late_4_7_days'
            ELSE 'late_8_plus_days' END"""
    )
