"""Read-back of marts for display: filter, top-k, pivot, label, order (V-1 … V-13).

The inputs are marts, that is, small aggregates. A ``position`` column carries the
display order. It is numbered only after a limit or over a fixed vocabulary.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from freightlens.functions.aggregates import (
    amount_sql,
    exact_sql,
    measures,
    money_sum,
    ratio,
    ratio_sql,
    exact_sum_sql,
)
from freightlens.functions.labels import rank_of, relabel
from freightlens.functions.status import STATUS_LABELS
from freightlens.plans.explore import labelled_status
from freightlens.plans.intermediate import BANDS, SHAPES
from freightlens.plans.marts import SIZES, ZONES

# Names of stages, shapes, bands and reasons, and how they are shown.
STAGE_LABELS = {
    "approval": "Approval",
    "seller_handling": "Seller handling",
    "transit": "Transit",
}
BAND_LABELS = {
    "1. same_city": "Same city",
    "2. same_state": "Same state",
    "3. cross_state": "Cross-state",
    "4. unknown": "Unknown (no seller)",
}
SHAPE_LABELS = {
    "single_seller_normal_handoff": "Single seller (normal handoff)",
    "single_seller_slow_handoff": "Single seller (slow handoff)",
    "multi_seller": "Multi-seller",
    "unclassified": "Unclassified",
}
REASON_LABELS = {
    "no_items_on_order": "No items on order",
    "never_approved_or_shipped": "Never approved or shipped",
    "approval_timestamp_missing": "Approval timestamp missing",
    "never_handed_to_carrier": "Never handed to carrier",
}


def percent(c: str, digits: int | None = None) -> Column:
    """A share as a percentage, rounded half to even for display (F-30)."""
    return F.expr(f"{c} * 100" if digits is None else f"bround({c} * 100, {digits})")


def top(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first n rows with their position. Only n rows reach the numbering window."""
    return df.orderBy(*order).limit(n).withColumn(
        "position", F.row_number().over(Window.partitionBy().orderBy(*order))
    )


def monthly_trend(sales: DataFrame, before: str, months: int = 30) -> DataFrame:
    """The first months of sales, up to a cut-off (V-1)."""
    shown = top(sales.select("order_month", "order_count", "total_revenue"), months, F.asc("order_month"))
    return shown.filter(f"order_month < DATE '{before}'")


def change_between(trend: DataFrame, peak: str, latest: str) -> DataFrame:
    """Percentage drop from a peak month to a later one; no row if either is absent (V-2, F-29)."""
    months = {"peak": peak, "latest": latest}
    found = {
        f"{name}_{short}": f"max({c}) FILTER (WHERE order_month = DATE '{month}')"
        for name, month in months.items()
        for short, c in (("orders", "order_count"), ("revenue", "total_revenue"))
    }
    both = trend.agg(*measures(found)).dropna(subset=["peak_orders", "latest_orders"])
    drops = {
        "order_drop_pct": ratio_sql("peak_orders - latest_orders", "peak_orders"),
        "revenue_drop_pct": ratio_sql("peak_revenue - latest_revenue", "peak_revenue"),
    }
    return both.selectExpr("*", *[f"{share} * 100 AS {name}" for name, share in drops.items()])


def revenue_risk_table(risk: DataFrame, n: int = 10) -> DataFrame:
    """The states with the highest revenue, rounded for display (V-3)."""
    return top(risk, n, F.desc("total_revenue"), F.asc("customer_state")).select(
        "position",
        "customer_state",
        F.bround("total_revenue", 0).alias("total_revenue"),
        "total_orders",
        "late_orders",
        F.bround("late_revenue", 0).alias("late_revenue"),
        percent("late_delivery_pct", 1).alias("late_delivery_pct"),
        percent("late_revenue_pct", 1).alias("late_revenue_pct"),
    )


def revenue_by_outcome(sunburst: DataFrame) -> DataFrame:
    """Two levels, state and outcome, with the share of the level above (V-4)."""
    by_outcome = (
        labelled_status(sunburst)
        .groupBy("customer_state", "delivery_outcome")
        .agg(money_sum("revenue").alias("revenue"))
    )
    whole = exact_sum_sql(exact_sql("revenue"), over="OVER (PARTITION BY customer_state)")
    with_state = by_outcome.selectExpr("*", f"{amount_sql(whole)} AS state_revenue")
    return with_state.select("*", ratio("revenue", "state_revenue").alias("share_of_state"))


def satisfaction_table(satisfaction: DataFrame) -> DataFrame:
    """Review scores by outcome in business order (V-5)."""
    return (
        labelled_status(satisfaction)
        .select(
            rank_of("delivery_status", list(STATUS_LABELS)).alias("position"),
            "delivery_outcome",
            "order_count",
            F.bround("avg_review_score", 2).alias("avg_review_score"),
            F.bround("avg_delivery_days", 1).alias("avg_delivery_days"),
        )
        .orderBy("position")
    )


def leading_sellers(performance: DataFrame, min_orders: int = 20, n: int = 100) -> DataFrame:
    """The sellers with the highest revenue among those with enough orders (P-10, O-4)."""
    return (
        performance.filter(f"order_count >= {min_orders}")
        .select(
            "seller_id",
            "order_count",
            "item_count",
            "total_revenue",
            "late_shipping_pct",
            "late_delivery_pct",
            "avg_delivery_days",
        )
        .orderBy(F.desc("total_revenue"), F.asc("seller_id"))
        .limit(n)
    )


def _seller_label() -> Column:
    return F.expr("concat('Seller ', left(CAST(seller_id AS STRING), 8))")


def top_sellers(leading: DataFrame, n: int = 10) -> DataFrame:
    """Highest revenue (V-6)."""
    return top(leading, n, F.desc("total_revenue"), F.asc("seller_id")).withColumn(
        "seller_label", _seller_label()
    )


def worst_shippers(leading: DataFrame, n: int = 10) -> DataFrame:
    """Highest late-shipping share among the leading sellers (V-7, P-15)."""
    known = leading.dropna(subset=["late_shipping_pct"])
    return (
        top(known, n, F.desc("late_shipping_pct"), F.desc("total_revenue"), F.asc("seller_id"))
        .withColumn("seller_label", _seller_label())
        .withColumn("late_shipping_display", percent("late_shipping_pct"))
    )


def stage_table(stages: DataFrame) -> DataFrame:
    """Share of each stage in the delay, labelled and ordered (V-8)."""
    return stages.select(
        rank_of("stage", list(STAGE_LABELS)).alias("position"),
        "stage",
        relabel("stage", STAGE_LABELS).alias("stage_label"),
        "total_days",
        percent("pct_of_delay").alias("pct_display"),
    ).orderBy("position")


def zone_size_matrix(
    mart: DataFrame, zones: Sequence[str] = tuple(ZONES), sizes: Sequence[str] = tuple(SIZES)
) -> DataFrame:
    """Late percentage with zones as rows and the chosen sizes as columns (V-9, P-13)."""
    chosen = mart.filter(F.col("distance_bucket").isin(*zones) & F.col("size_bucket").isin(*sizes))
    return (
        chosen.groupBy("distance_bucket")
        .pivot("size_bucket", list(sizes))
        .agg(F.first(percent("late_pct")))
        .withColumn("position", rank_of("distance_bucket", ZONES))
        .orderBy("position")
    )


def transit_segments(drivers: DataFrame) -> DataFrame:
    """Transit by band and shape without the unknown and the unclassified (V-10, P-16)."""
    return (
        drivers.filter(
            (F.col("distance_band") != BANDS[-1]) & (F.col("order_shape") != SHAPES[-1])
        )
        .select(
            rank_of("distance_band", BANDS).alias("band_position"),
            rank_of("order_shape", SHAPES).alias("shape_position"),
            relabel("distance_band", BAND_LABELS).alias("distance_band_label"),
            relabel("order_shape", SHAPE_LABELS).alias("order_shape_label"),
            "order_count",
            percent("pct_of_orders").alias("pct_of_orders_display"),
            "avg_transit_days",
            "avg_seller_handling_days",
            percent("late_pct").alias("late_pct_display"),
        )
        .orderBy("band_position", "shape_position")
    )


def unclassified_totals(unclassified: DataFrame) -> DataFrame:
    """All unclassified orders, and how many of them have a transit time (V-11, A-22)."""
    return unclassified.agg(
        F.sum("order_count").alias("total_unclassified"),
        F.sum("delivered_order_count").alias("total_delivered"),
    )


def unclassified_by_reason(unclassified: DataFrame) -> DataFrame:
    """Unclassified orders per reason, most frequent first (V-11, A-21)."""
    return (
        unclassified.groupBy("unclassified_reason")
        .agg(
            F.sum("order_count").alias("order_count"),
            F.sum("delivered_order_count").alias("delivered_order_count"),
        )
        .select(
            relabel("unclassified_reason", REASON_LABELS, otherwise="null").alias("reason"),
            "order_count",
            "delivered_order_count",
        )
        .orderBy(F.desc("order_count"))
    )


def unclassified_detail(unclassified: DataFrame) -> DataFrame:
    """The unclassified mart with labels and rounded durations (V-11)."""
    return unclassified.select(
        relabel("distance_band", BAND_LABELS, otherwise="null").alias("distance_band"),
        relabel("unclassified_reason", REASON_LABELS, otherwise="null").alias("reason"),
        "order_status",
        "order_count",
        "delivered_order_count",
        F.bround("avg_transit_days", 1).alias("avg_transit_days"),
    )


def category_size_matrix(mart: DataFrame, sizes: Sequence[str] = tuple(SIZES[:4])) -> DataFrame:
    """Late percentage by category and deliverable size (V-12)."""
    return (
        mart.groupBy("product_category_buckets")
        .pivot("product_size_buckets", list(sizes))
        .agg(F.first(percent("late_item_pct")))
    )


def freight_vs_late(
    mart: DataFrame,
    freight: tuple[float, float] = (0, 100),
    late_percent: tuple[float, float] = (0, 20),
) -> DataFrame:
    """Mean freight against late percentage, inside a display window (V-13)."""
    return (
        mart.withColumn("late_pct_display", percent("late_item_pct"))
        .filter(
            F.col("avg_freight_per_item").between(*freight)
            & F.col("late_pct_display").between(*late_percent)
        )
        .select(
            "product_category_buckets",
            "product_size_buckets",
            "product_item_count",
            "avg_freight_per_item",
            "late_pct_display",
        )
    )

