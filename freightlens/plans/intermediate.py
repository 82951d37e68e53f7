"""Intermediate models: delivery stages, order shape, distances (D-9 … D-11)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlens.functions.aggregates import (
    exact_sql,
    exact_sum,
    exact_sum_sql,
    measures,
    money_sum,
)
from freightlens.functions.geo import great_circle_metres
from freightlens.functions.status import delivery_status
from freightlens.functions.timing import days_between

SHAPES = [
    "single_seller_normal_handoff",
    "single_seller_slow_handoff",
    "multi_seller",
    "unclassified",
]
BANDS = ["1. same_city", "2. same_state", "3. cross_state", "4. unknown"]


def order_delivery_stages(orders: DataFrame) -> DataFrame:
    """Durations between the milestones of each order, and its outcome (D-9)."""
    milestones = {
        "approval_delay_days": ("order_purchase_at", "order_approved_at"),
        "seller_handling_days": ("order_approved_at", "order_delivered_carrier_at"),
        "transit_days": ("order_delivered_carrier_at", "order_delivered_customer_at"),
        "total_delivery_days": ("order_purchase_at", "order_delivered_customer_at"),
        "delivery_delay_days": ("order_estimated_delivery_at", "order_delivered_customer_at"),
    }
    return orders.select(
        "*",
        *[days_between(start, end).alias(name) for name, (start, end) in milestones.items()],
        delivery_status("order_delivered_customer_at", "order_estimated_delivery_at").alias(
            "delivery_status"
        ),
    )


def _if_has(df: DataFrame, column: str, **named: str) -> dict[str, str]:
    return named if column in df.columns else {}


def order_totals(items: DataFrame) -> DataFrame:
    """Items and money per order, for what does not care who sold them.

    One step: map-side sums shrink a huge order before the shuffle.
    """
    return items.groupBy("order_id").agg(
        *measures(
            {
                "item_count": "count(*)",
                "order_revenue": money_sum("price"),
                "order_freight": money_sum("freight_value"),
            }
        )
    )


def seller_shares(items: DataFrame) -> DataFrame:
    """One row per (order, seller): items, exact amounts, latest deadline, first item.

    The first of two steps to measures that depend on the sellers of an order or
    the orders of a seller. It shuffles on the pair, so neither a huge order nor
    a huge seller lands in one task.
    """
    named = {
        "items": "count(*)",
        "revenue": exact_sum_sql(exact_sql("price")),
        "freight": exact_sum_sql(exact_sql("freight_value")),
        **_if_has(items, "shipping_limit_date", last_limit="max(shipping_limit_date)"),
        **_if_has(
            items,
            "order_item_id",
            first_item="min(order_item_id)",
            unnumbered="count_if(order_item_id IS NULL)",
        ),
    }
    return items.groupBy("order_id", "seller_id").agg(*measures(named))


def order_rollup(items: DataFrame) -> DataFrame:
    """One row per order that has items, with its sellers (A-4, A-8, W-1, W-3).

    The seller with the highest revenue stands for the order, the lowest id
    among equals. It is found as a minimum, which Spark merges map-side, rather
    than by ranking the sellers of an order in a window.
    """
    shares = seller_shares(items)
    falling = "revenue.units IS NULL, -revenue.units, -revenue.parts"
    top = f"min(struct({falling}, seller_id)) FILTER (WHERE seller_id IS NOT NULL)"
    latest = "max(if(seller_id IS NULL, NULL, last_limit))"
    named = {
        "item_count": "sum(items)",
        "distinct_seller_count": "count(seller_id)",
        "order_revenue": exact_sum("revenue"),
        "order_freight": exact_sum("freight"),
        "main_seller_id": f"({top}).seller_id",
        **_if_has(shares, "last_limit", last_shipping_limit_at=latest),
        **_if_has(
            shares,
            "first_item",
            first_item_id="if(sum(unnumbered) > 0, NULL, min(first_item))",
        ),
    }
    return shares.groupBy("order_id").agg(*measures(named))


def order_transit_shape(
    order_facts: DataFrame,
    sellers: DataFrame,
    customers: DataFrame,
    slow_handoff_days: float = 5,
    sla_breach_days: float = 0,
) -> DataFrame:
    """Shape, distance band and reason of each order (D-10, P-17).

    ``order_facts`` is at order grain. Both lookups are from the many side to a
    unique key, so a hot seller or customer can be split by AQE. A comparison
    with something missing is neither slow nor near.
    """
    seller_places = sellers.selectExpr(
        "seller_id AS main_seller_id", "seller_city", "seller_state"
    )
    customer_places = customers.select("customer_id", "customer_city", "customer_state")
    unapproved, unhanded = "order_approved_at IS NULL", "order_delivered_carrier_at IS NULL"
    return (
        order_facts.join(seller_places, "main_seller_id", "left")
        .join(customer_places, "customer_id", "left")
        .select(
            "*",
            days_between("last_shipping_limit_at", "order_delivered_carrier_at").alias(
                "carrier_handoff_vs_limit_days"
            ),
            F.expr(
                f"""CASE
                    WHEN distinct_seller_count = 0 THEN 'no_items_on_order'
                    WHEN {unapproved} THEN
                        if({unhanded}, 'never_approved_or_shipped', 'approval_timestamp_missing')
                    WHEN {unhanded} THEN 'never_handed_to_carrier' END"""
            ).alias("unclassified_reason"),
            F.expr("seller_state = customer_state").alias("same_state"),
            F.expr("lower(seller_city) = lower(customer_city)").alias("same_city"),
        )
        .selectExpr(
            "order_id",
            "order_status",
            "delivery_status",
            "transit_days",
            "total_delivery_days",
            "delivery_delay_days",
            "seller_handling_days",
            "carrier_handoff_vs_limit_days",
            "unclassified_reason",
            f"""CASE
                WHEN unclassified_reason IS NOT NULL THEN 'unclassified'
                WHEN distinct_seller_count >= 2 THEN 'multi_seller'
                WHEN seller_handling_days > {slow_handoff_days}
                    AND carrier_handoff_vs_limit_days > {sla_breach_days}
                    THEN 'single_seller_slow_handoff'
                ELSE 'single_seller_normal_handoff' END AS order_shape""",
            """CASE
                WHEN same_state IS NULL THEN '4. unknown'
                WHEN NOT same_state THEN '3. cross_state'
                WHEN same_city THEN '1. same_city'
                ELSE '2. same_state' END AS distance_band""",
        )
    )


def _located(df: DataFrame, role: str, geo: DataFrame) -> DataFrame:
    """Sellers or customers with the centroid of their zip code; zips without one drop out."""
    points = geo.selectExpr(
        f"zip_code_prefix AS {role}_zip_code_prefix",
        f"centroid_lat AS {role}_lat",
        f"centroid_lng AS {role}_lng",
    )
    return df.join(points, f"{role}_zip_code_prefix").select(
        f"{role}_id", f"{role}_lat", f"{role}_lng"
    )


def place_distances(
    orders: DataFrame, items: DataFrame, sellers: DataFrame, customers: DataFrame, geo: DataFrame
) -> DataFrame:
    """(seller zip, customer zip, distance) of the places between which anything was sold (D-11).

    The haversine is evaluated once for each pair of places. There are far fewer of them
    than orders, and written as a table they serve every later use (``with_known_distance``).
    """
    seller_zip, customer_zip = "seller_zip_code_prefix", "customer_zip_code_prefix"
    pairs = (
        items.select("order_id", "seller_id")
        .join(sellers.select("seller_id", seller_zip), "seller_id")
        .join(orders.select("order_id", "customer_id"), "order_id")
        .join(customers.select("customer_id", customer_zip), "customer_id")
        .select(seller_zip, customer_zip)
        .distinct()
    )
    for role in ("seller", "customer"):
        points = geo.selectExpr(
            f"zip_code_prefix AS {role}_zip_code_prefix",
            f"centroid_lat AS {role}_lat",
            f"centroid_lng AS {role}_lng",
        )
        pairs = pairs.join(points, f"{role}_zip_code_prefix")
    distance = great_circle_metres("seller_lng", "seller_lat", "customer_lng", "customer_lat")
    return pairs.select(seller_zip, customer_zip, distance.alias("distance_meters"))


def with_known_distance(
    rows: DataFrame, orders: DataFrame, sellers: DataFrame, customers: DataFrame, places: DataFrame
) -> DataFrame:
    """Rows that carry order_id and seller_id, with the distance of their two places (J-6).

    Rows without one drop out. Nothing is computed here: the zip codes of both ends look it up.
    """
    ends = orders.select("order_id", "customer_id").join(
        customers.select("customer_id", "customer_zip_code_prefix"), "customer_id"
    )
    return (
        rows.join(sellers.select("seller_id", "seller_zip_code_prefix"), "seller_id")
        .join(ends.drop("customer_id"), "order_id")
        .join(places, ["seller_zip_code_prefix", "customer_zip_code_prefix"])
    )


def with_distance(
    rows: DataFrame,
    orders: DataFrame,
    sellers: DataFrame,
    customers: DataFrame,
    geo: DataFrame,
    order_columns: Sequence[str] = (),
) -> DataFrame:
    """Add both end points and the distance to rows that carry order_id and seller_id.

    The geography dimension is joined twice, once per role, on the small seller
    and customer tables; the rows themselves meet only unique keys (J-6).
    """
    ends = (
        orders.select("order_id", "customer_id", *order_columns)
        .join(_located(customers, "customer", geo), "customer_id")
        .drop("customer_id")
    )
    distance = great_circle_metres("seller_lng", "seller_lat", "customer_lng", "customer_lat")
    return (
        rows.join(_located(sellers, "seller", geo), "seller_id")
        .join(ends, "order_id")
        .select("*", distance.alias("distance_meters"))
    )


def seller_customer_distance(
    items: DataFrame, orders: DataFrame, sellers: DataFrame, customers: DataFrame, geo: DataFrame
) -> DataFrame:
    """Distance per (order, seller) whose zip codes are both known (D-11).

    The pairs are made distinct before the lookups, not after them.
    """
    pairs = items.select("order_id", "seller_id").distinct()
    return with_distance(pairs, orders, sellers, customers, geo).select(
        "order_id",
        "seller_id",
        "seller_lat",
        "seller_lng",
        "customer_lat",
        "customer_lng",
        "distance_meters",
    )


def items_with_distance(items: DataFrame, distances: DataFrame) -> DataFrame:
    """Items with the distance of their (order, seller); unknown distances stay null (J-9)."""
    return items.join(
        distances.select("order_id", "seller_id", "distance_meters"),
        ["order_id", "seller_id"],
        "left",
    )
