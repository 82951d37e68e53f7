"""Reporting marts (D-18 … D-29).

Marts about orders read the order-grain facts; marts about items read the items
joined to the order's stages. Ratios are NULL where their denominator is zero.
Results that have an order are sorted after their aggregation, when they are small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlens.functions.aggregates import (
    amount_sql,
    exact_sql,
    exact_sum,
    exact_sum_sql,
    exact_quantile,
    mean_days,
    measures,
    money_sum,
    ratio,
    ratio_sql,
    total_days,
)
from freightlens.functions.labels import rank_of, text_sql
from freightlens.functions.status import LATE, NOT_DELIVERED, ON_TIME
from freightlens.functions.timing import month_of
from freightlens.plans.intermediate import seller_shares, with_distance

SIZES = ["S", "M", "L", "XL", "Too Large or Too Heavy for Delivery"]
ZONES = ["Zone 1", "Zone 2", "Zone 3", "Zone 4"]

# Upper limits of the size and zone classes, inclusive.
SIDE_SUM_LIMITS_CM = [80, 120, 200, 300]
WEIGHT_LIMITS_G = [5_000, 10_000, 20_000, 30_000]
ZONE_LIMITS_KM = [100, 500, 1_500]


def _place_sql(value: str, limits: list[int], beyond: int | None = None) -> str:
    """0 up to the first limit, 1 up to the second, and so on.

    ``beyond`` is the place of what no limit holds, by default the next one;
    that includes a null.
    """
    arms = " ".join(f"WHEN {value} <= {limit} THEN {i}" for i, limit in enumerate(limits))
    return f"CASE {arms} ELSE {len(limits) if beyond is None else beyond} END"


def _name_at_sql(place: str, names: list[str]) -> str:
    return f"get(array({', '.join(text_sql(n) for n in names)}), {place})"


def size_class_sql(side_sum: str = "product_dimension", weight: str = "product_weight_g") -> str:
    """The larger of the size and the weight class of a product that has both.

    A weight above the last limit is taken for a data error and counts as the
    lightest class, so that the size decides.
    """
    by_size = _place_sql(side_sum, SIDE_SUM_LIMITS_CM)
    by_weight = _place_sql(weight, WEIGHT_LIMITS_G, beyond=0)
    return _name_at_sql(f"greatest({by_size}, {by_weight})", SIZES)


def zone_sql(distance_meters: str = "distance_meters") -> str:
    return _name_at_sql(_place_sql(f"{distance_meters} / 1000", ZONE_LIMITS_KM), ZONES)


def mart_delivery_kpis(orders: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders, lateness and durations by purchase month and customer state (D-18)."""
    return (
        orders.join(customers.select("customer_id", "customer_state"), "customer_id")
        .groupBy(month_of("order_purchase_at").alias("order_month"), "customer_state")
        .agg(
            *measures(
                {
                    "order_count": "count(*)",
                    "not_delivered_count": f"count_if({NOT_DELIVERED})",
                    "on_time_count": f"count_if({ON_TIME})",
                    "late_count": f"count_if({LATE})",
                    "late_pct": ratio(f"count_if({LATE})", "count(*)"),
                    "avg_delivery_days": mean_days("total_delivery_days"),
                    "avg_seller_handling_days": mean_days("seller_handling_days"),
                    "avg_transit_days": mean_days("transit_days"),
                    "total_revenue": money_sum("order_revenue"),
                }
            )
        )
    )


def mart_monthly_sales(orders: DataFrame) -> DataFrame:
    """Orders, revenue, freight and mean order value by purchase month (D-19).

    The input has one row per order, so counting rows counts distinct orders.
    """
    totals = orders.groupBy(month_of("order_purchase_at").alias("order_month")).agg(
        *measures(
            {
                "order_count": "count(*)",
                "total_revenue": money_sum("order_revenue"),
                "total_freight": money_sum("order_freight"),
            }
        )
    )
    value = ratio("total_revenue", "order_count").alias("avg_order_value")
    return totals.select("*", value).orderBy("order_month")


def mart_satisfaction_by_delivery(orders: DataFrame) -> DataFrame:
    """Mean of the orders' mean review scores by outcome, reviewed orders only (D-20)."""
    return (
        orders.filter("avg_review_score IS NOT NULL")
        .groupBy("delivery_status")
        .agg(
            *measures(
                {
                    "order_count": "count(*)",
                    "avg_review_score": "avg(avg_review_score)",
                    "avg_delivery_days": mean_days("total_delivery_days"),
                    "avg_delivery_delay_days": mean_days("delivery_delay_days"),
                }
            )
        )
    )


def mart_delivery_delay_stages(orders: DataFrame) -> DataFrame:
    """Days that late orders spent in each stage, and its share of all of them (D-21).

    One aggregate row is turned into three; nothing is scanned three times. Late
    orders are chosen inside the sums: as a filter the derived outcome would be
    pushed down and computed a second time for every order.
    """
    stage_of = {
        "approval": "approval_delay_days",
        "seller_handling": "seller_handling_days",
        "transit": "transit_days",
    }
    totals = orders.agg(*measures({s: total_days(c, LATE) for s, c in stage_of.items()}))
    return (
        totals.selectExpr("*", f"{' + '.join(stage_of)} AS overall")
        .unpivot(["overall"], list(stage_of), "stage", "total_days")
        .select("stage", "total_days", ratio("total_days", "overall").alias("pct_of_delay"))
    )


def mart_pdt_delivery(items: DataFrame, products: DataFrame) -> DataFrame:
    """Lateness and money by category bucket and parcel size, item grain (D-22)."""
    measured = products.dropna(
        subset=[
            "product_weight_g",
            "product_length_cm",
            "product_height_cm",
            "product_width_cm",
        ]
    ).selectExpr(
        "product_id", "product_category_buckets", f"{size_class_sql()} AS product_size_buckets"
    )
    totals = (
        items.join(measured, "product_id")
        .groupBy("product_category_buckets", "product_size_buckets")
        .agg(
            *measures(
                {
                    "product_item_count": "count(*)",
                    "avg_delivery_days": mean_days("total_delivery_days"),
                    "not_delivered_item_count": f"count_if({NOT_DELIVERED})",
                    "on_time_item_count": f"count_if({ON_TIME})",
                    "late_item_count": f"count_if({LATE})",
                    "total_revenue": money_sum("item_price"),
                    "total_freight": money_sum("item_freight"),
                }
            )
        )
    )
    return totals.select(
        "*",
        ratio("late_item_count", "product_item_count").alias("late_item_pct"),
        ratio("total_revenue", "product_item_count").alias("avg_revenue_per_item"),
        ratio("total_freight", "product_item_count").alias("avg_freight_per_item"),
    ).orderBy("product_category_buckets", rank_of("product_size_buckets", SIZES))


def mart_delay_pdt_vs_dist(
    items: DataFrame,
    products: DataFrame,
    orders: DataFrame,
    sellers: DataFrame,
    customers: DataFrame,
    geo: DataFrame,
    grain: str = "order_pairs",
) -> DataFrame:
    """Item count and late share by distance zone and parcel size (D-23, J-12).

    With ``order_pairs`` each item counts once for every item of its order, as if
    items were joined to the fact on order_id alone: an order of n items counts
    n². The pairs are never made; each item simply weighs as much as its order
    has items. ``item`` counts each item once.
    """
    if grain not in ("order_pairs", "item"):
        raise ValueError(f"unknown grain {grain!r}")
    weight = "item_count" if grain == "order_pairs" else "1L"
    wanted = ["delivery_status"] + (["item_count"] if grain == "order_pairs" else [])
    sized = products.dropna(subset=["product_weight_g", "product_dimension"]).selectExpr(
        "product_id", f"{size_class_sql()} AS size_bucket"
    )
    counted = with_distance(
        items.select("order_id", "seller_id", "product_id").join(sized, "product_id"),
        orders,
        sellers,
        customers,
        geo,
        wanted,
    ).filter("delivery_status IS NOT NULL AND distance_meters IS NOT NULL")
    totals = counted.groupBy(F.expr(zone_sql()).alias("distance_bucket"), "size_bucket").agg(
        *measures(
            {"order_item_count": f"sum({weight})", "late_count": f"sum(if({LATE}, {weight}, 0L))"}
        )
    )
    return totals.select(
        "distance_bucket",
        "size_bucket",
        "order_item_count",
        ratio("late_count", "order_item_count").alias("late_pct"),
    ).orderBy("distance_bucket", rank_of("size_bucket", SIZES))


def mart_seller_perf(items: DataFrame, stages: DataFrame, sellers: DataFrame) -> DataFrame:
    """Items, orders, late share and revenue by seller (D-24).

    Items collapse to (order, seller) first. Each such row is one order of the
    seller, so counting rows replaces a distinct count, and the seller's city is
    looked up once per seller.
    """
    shares = seller_shares(items).join(stages.select("order_id", "delivery_status"), "order_id")
    per_seller = shares.groupBy("seller_id").agg(
        *measures(
            {
                "seller_item_count": "sum(items)",
                "seller_order_count": "count(*)",
                "not_delivered_item_count": f"sum(if({NOT_DELIVERED}, items, 0L))",
                "on_time_item_count": f"sum(if({ON_TIME}, items, 0L))",
                "late_item_count": f"sum(if({LATE}, items, 0L))",
                "seller_total_revenue": exact_sum("revenue"),
            }
        )
    )
    places = sellers.select("seller_id", "seller_city", "seller_state")
    return per_seller.join(places, "seller_id").select(
        "*", ratio("late_item_count", "seller_item_count").alias("late_item_pct")
    )


def mart_seller_performance(items: DataFrame, stages: DataFrame) -> DataFrame:
    """Shipping discipline per item and delivery outcome per order, by seller (D-25).

    Three steps: items with equal (order, seller, deadline) collapse, then the
    deadlines of a pair are judged against the order's handoff, then the orders
    of a seller are added up. ``delivered_order_count`` counts every order with
    a known outcome, undelivered ones included.
    """
    grouped = items.groupBy("order_id", "seller_id", "shipping_limit_date").agg(
        *measures(
            {
                "n": "count(*)",
                "revenue": exact_sum_sql(exact_sql("price")),
                "freight": exact_sum_sql(exact_sql("freight_value")),
            }
        )
    )
    handoff, limit = "order_delivered_carrier_at", "shipping_limit_date"
    outcome = ["delivery_status", "total_delivery_days"]
    per_order = (
        grouped.join(stages.select("order_id", handoff, *outcome), "order_id", "left")
        .groupBy("seller_id", "order_id", *outcome)
        .agg(
            *measures(
                {
                    "n": "sum(n)",
                    "revenue": exact_sum_sql("revenue"),
                    "freight": exact_sum_sql("freight"),
                    "shipped": f"sum(if({handoff} IS NULL OR {limit} IS NULL, 0L, n))",
                    "shipped_late": f"sum(if({handoff} > {limit}, n, 0L))",
                }
            )
        )
    )
    per_seller = per_order.groupBy("seller_id").agg(
        *measures(
            {
                "order_count": "count(order_id)",
                "item_count": "sum(n)",
                "total_revenue": exact_sum("revenue"),
                "total_freight": exact_sum("freight"),
                "shipping_item_count": "sum(shipped)",
                "late_shipping_item_count": "sum(shipped_late)",
                "late_delivery_order_count": f"count(order_id) FILTER (WHERE {LATE})",
                "delivered_order_count": """count(order_id)
                    FILTER (WHERE delivery_status IS NOT NULL)""",
                "avg_delivery_days": mean_days("total_delivery_days", weight="n"),
            }
        )
    )
    return per_seller.select(
        "*",
        ratio("late_shipping_item_count", "shipping_item_count").alias("late_shipping_pct"),
        ratio("late_delivery_order_count", "delivered_order_count").alias("late_delivery_pct"),
    )


def _outcome_totals(
    orders: DataFrame, customers: DataFrame, how: str, order_grain: bool
) -> DataFrame:
    """Rows and exact revenue by customer state and outcome.

    By default an order weighs as many rows as it has in the item-grain fact, at
    least one, and so does its revenue; at order grain it weighs one. Weighted
    revenue stays exact.
    """
    states = customers.select("customer_id", "customer_state")
    rows = "1L" if order_grain else "greatest(item_count, 1L)"
    weighted = exact_sum_sql(exact_sql("order_revenue", weight=rows))
    return (
        orders.join(states, "customer_id", how)
        .groupBy("customer_state", "delivery_status")
        .agg(*measures({"order_count": f"sum({rows})", "revenue": weighted}))
    )


def mart_delivery_revenue_risk(
    orders: DataFrame, customers: DataFrame, order_grain: bool = False
) -> DataFrame:
    """Revenue and the part of it in late orders, by customer state (D-26, J-5)."""
    known = customers.filter("customer_state IS NOT NULL")
    per_state = (
        _outcome_totals(orders, known, "inner", order_grain)
        .groupBy("customer_state")
        .agg(
            *measures(
                {
                    "total_orders": "sum(order_count)",
                    "total_revenue": exact_sum("revenue"),
                    "late_orders": f"sum(if({LATE}, order_count, 0L))",
                    "late_revenue": exact_sum("revenue", LATE),
                }
            )
        )
    )
    return per_state.select(
        "*",
        ratio("late_orders", "total_orders").alias("late_delivery_pct"),
        ratio("late_revenue", "total_revenue").alias("late_revenue_pct"),
    ).orderBy(F.desc("total_revenue"), "customer_state")


def mart_delivery_sunburst(
    orders: DataFrame, customers: DataFrame, order_grain: bool = False, top: int = 10
) -> DataFrame:
    """Orders and revenue by outcome in the states with the highest revenue (D-27, J-10).

    The states are ranked on the small (state, outcome) totals. Equal revenue is
    decided by the row count, then by name. Orders of unknown state take part in
    the ranking, but are not shown.

    The join back is null-safe and not a semi join: those would be pushed below
    the aggregation, and the totals would be computed twice instead of reused.
    """
    totals = _outcome_totals(orders, customers, "left", order_grain)
    leading = (
        totals.groupBy("customer_state")
        .agg(
            F.expr(exact_sum_sql("revenue")).alias("exact"),
            F.sum("order_count").alias("order_count"),
        )
        .orderBy(F.desc("exact"), F.desc("order_count"), "customer_state")
        .limit(top)
        .filter("customer_state IS NOT NULL")
        .selectExpr("customer_state AS leading_state")
    )
    # At most ``top`` rows are broadcast.
    return totals.join(
        F.broadcast(leading), F.expr("customer_state <=> leading_state")
    ).selectExpr(
        "customer_state", "delivery_status", "order_count", f"{amount_sql('revenue')} AS revenue"
    )


def mart_transit_drivers(shapes: DataFrame) -> DataFrame:
    """Transit time by order shape and distance band (D-28).

    The share of all orders is a window over the few result rows, after the
    aggregation. The late share leaves undelivered orders out of its denominator.
    """
    segments = shapes.groupBy("order_shape", "distance_band").agg(
        *measures(
            {
                "order_count": "count(*)",
                "delivered_order_count": "count(transit_days)",
                "avg_transit_days": mean_days("transit_days"),
                "median_transit_days": exact_quantile("transit_days", 0.5),
                "p90_transit_days": exact_quantile("transit_days", 0.9),
                "avg_seller_handling_days": mean_days("seller_handling_days"),
                "avg_total_delivery_days": mean_days("total_delivery_days"),
                "avg_delivery_delay_days": mean_days("delivery_delay_days"),
                "avg_carrier_handoff_vs_limit_days": mean_days("carrier_handoff_vs_limit_days"),
                "late_pct": ratio(f"count_if({LATE})", f"count_if(NOT {NOT_DELIVERED})"),
            }
        )
    )
    share = ratio_sql("order_count", "sum(order_count) OVER ()")
    return segments.selectExpr("*", f"{share} AS pct_of_orders").orderBy(
        "order_shape", "distance_band"
    )


def mart_transit_unclassified(shapes: DataFrame) -> DataFrame:
    """Why orders have no shape, by band, reason and order status (D-29)."""
    return (
        shapes.filter("order_shape = 'unclassified'")
        .groupBy("distance_band", "unclassified_reason", "order_status")
        .agg(
            *measures(
                {
                    "order_count": "count(*)",
                    "delivered_order_count": "count(transit_days)",
                    "avg_transit_days": mean_days("transit_days"),
                }
            )
        )
        .orderBy("distance_band", "unclassified_reason", F.desc("order_count"))
    )
