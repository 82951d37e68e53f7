"""Exploration queries over the raw tables, the fact and the marts (N-1 … N-9)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlens.functions.aggregates import (
    amount_sql,
    exact_sql,
    exact_sum_sql,
    mean_days,
    measures,
    ratio_sql,
)
from freightlens.functions.labels import rank_of, relabel
from freightlens.functions.status import STATUS_LABELS
from freightlens.functions.timing import hours_sql

PROFILED = [
    "order_purchase_at",
    "order_approved_at",
    "order_delivered_carrier_at",
    "order_delivered_customer_at",
    "order_estimated_delivery_at",
    "avg_review_score",
    "delivery_status",
]


def row_counts(layers: Mapping[str, Mapping[str, DataFrame]]) -> DataFrame:
    """Rows per table, by schema (N-1)."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(
            F.lit(schema).alias("dataset"), F.lit(name).alias("table"), "row_count"
        )
        for schema, tables in layers.items()
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionAll, counts)


def null_profile(df: DataFrame, columns: Sequence[str] = tuple(PROFILED)) -> DataFrame:
    """Rows in total and nulls per column, with their percentage (N-2).

    One pass; the single result row is then turned into one row per measure.
    """
    nulls = {f"null_{c}": f"count_if({c} IS NULL)" for c in columns}
    wide = df.agg(*measures({"total_rows": "count(*)", **nulls})).selectExpr(
        "*", "total_rows AS all_rows"
    )
    long = wide.unpivot(["all_rows"], wide.columns[:-1], "measure", "count")
    share = ratio_sql("count", "all_rows")
    return long.selectExpr("measure", "count", f"bround({share} * 100, 1) AS pct_of_total")


def date_coverage(orders: DataFrame) -> DataFrame:
    """First and last purchase and delivery (N-3)."""
    return orders.agg(
        F.min("order_purchase_at").alias("earliest_order"),
        F.max("order_purchase_at").alias("latest_order"),
        F.min("order_delivered_customer_at").alias("earliest_delivery"),
        F.max("order_delivered_customer_at").alias("latest_delivery"),
    )


def satisfaction_in_order(mart: DataFrame) -> DataFrame:
    """The satisfaction mart in business order, with the place of each outcome (N-4)."""
    place = rank_of("delivery_status", list(STATUS_LABELS)).alias("position")
    return mart.select("*", place).orderBy("position")


def _median_sql(column: str) -> str:
    """Median of whole hours, as days with two decimals."""
    return f"round(percentile_disc(0.5) WITHIN GROUP (ORDER BY {column}), 2)"


_BY_SELLERS = "if(n_sellers > 1, 'multi-seller', 'single-seller')"
_MEAN_ITEMS = f"round({ratio_sql('sum(n_items)', 'count(*)')}, 2)"


def deadline_spread(items: DataFrame) -> DataFrame:
    """Spread of shipping deadlines and freight per item, orders of two or more items (N-6)."""
    pairs = items.groupBy("order_id", "seller_id").agg(
        *measures(
            {
                "n": "count(*)",
                "first_limit": "min(shipping_limit_date)",
                "last_limit": "max(shipping_limit_date)",
                "freight": exact_sum_sql(exact_sql("freight_value")),
                "charged": "count(freight_value)",
            }
        )
    )
    baskets = pairs.groupBy("order_id").agg(
        *measures(
            {
                "n_items": "sum(n)",
                "n_sellers": "count(seller_id)",
                "spread": f"{hours_sql('min(first_limit)', 'max(last_limit)')} / 24D",
                "freight_per_item": ratio_sql(amount_sql(exact_sum_sql("freight")), "sum(charged)"),
            }
        )
    )
    return (
        baskets.filter("n_items >= 2")
        .groupBy(F.expr(_BY_SELLERS).alias("grp"))
        .agg(
            *measures(
                {
                    "orders": "count(*)",
                    "avg_items": _MEAN_ITEMS,
                    "median_limit_spread_days": _median_sql("spread"),
                    "pct_orders_limits_over_1_day": "round(avg(if(spread > 1, 1, 0)) * 100, 1)",
                    "mean_freight_per_item": "round(avg(freight_per_item), 2)",
                }
            )
        )
        .orderBy("grp")
    )


def seller_states(items: DataFrame, sellers: DataFrame) -> DataFrame:
    """How many multi-seller orders span several states (N-7, J-11)."""
    pairs = items.select("order_id", "seller_id").distinct()
    baskets = (
        pairs.join(sellers.select("seller_id", "seller_state"), "seller_id")
        .groupBy("order_id")
        .agg(
            *measures(
                {
                    "n_sellers": "count(seller_id)",
                    "several_states": "min(seller_state) <> max(seller_state)",
                }
            )
        )
        .filter("n_sellers > 1")
    )
    share = ratio_sql("count_if(several_states)", "count(*)")
    return baskets.agg(
        *measures(
            {
                "multi_seller_orders": "count(*)",
                "sellers_in_different_states": "count_if(several_states)",
                "pct_different_states": f"round({share} * 100, 1)",
            }
        )
    )


def controlled_transit(
    items: DataFrame, sellers: DataFrame, orders: DataFrame, customers: DataFrame
) -> DataFrame:
    """Transit by distance and seller count for orders of two or more items (N-8).

    An order whose sellers are not all known to be in one state counts as
    crossing; against an unknown customer state it does not.
    """
    pairs = items.groupBy("order_id", "seller_id").agg(F.count("*").alias("n"))
    baskets = (
        pairs.join(sellers.select("seller_id", "seller_state"), "seller_id")
        .groupBy("order_id")
        .agg(
            *measures(
                {
                    "n_items": "sum(n)",
                    "n_sellers": "count(seller_id)",
                    "home": "if(min(seller_state) = max(seller_state), min(seller_state), NULL)",
                }
            )
        )
        .filter("n_items >= 2")
    )
    transit = hours_sql("order_delivered_carrier_at", "order_delivered_customer_at")
    delivered = orders.selectExpr(
        "order_id", "customer_id", f"{transit} / 24D AS transit_days"
    ).filter("transit_days IS NOT NULL")
    crossing = "home IS NULL OR coalesce(home <> customer_state, false)"
    return (
        baskets.join(delivered, "order_id")
        .join(customers.select("customer_id", "customer_state"), "customer_id")
        .groupBy(
            F.expr(f"if({crossing}, 'cross-state', 'same-state')").alias("distance_band"),
            F.expr(_BY_SELLERS).alias("grp"),
        )
        .agg(
            *measures(
                {
                    "orders": "count(*)",
                    "avg_items": _MEAN_ITEMS,
                    "median_transit_days": _median_sql("transit_days"),
                    "mean_transit_days": F.round(mean_days("transit_days"), 2),
                }
            )
        )
        .orderBy("distance_band", "grp")
    )


def review_spread(items: DataFrame, reviews: DataFrame) -> DataFrame:
    """Orders with several reviews, and how far apart these are (N-9)."""
    pairs = items.groupBy("order_id", "seller_id").agg(F.count("*").alias("n"))
    baskets = pairs.groupBy("order_id").agg(
        *measures({"n_items": "sum(n)", "n_sellers": "count(seller_id)"})
    )
    gap = hours_sql("min(review_creation_date)", "max(review_creation_date)")
    surveys = reviews.groupBy("order_id").agg(
        F.expr(f"if(count(*) > 1, {gap} / 24D, NULL)").alias("spread"),
        F.count("*").alias("n_reviews"),
    )
    group = """CASE WHEN n_sellers > 1 THEN 'multi-seller'
        WHEN n_items >= 2 THEN 'single-seller 2+ items' ELSE 'single-seller 1 item' END"""

    def percent(count: str) -> str:
        return f"round({ratio_sql(count, 'count(*)')} * 100, 2)"

    return (
        baskets.join(surveys, "order_id")
        .groupBy(F.expr(group).alias("grp"))
        .agg(
            *measures(
                {
                    "orders": "count(*)",
                    "pct_orders_with_multiple_reviews": percent("count_if(n_reviews > 1)"),
                    "pct_reviews_over_1d_apart": percent("count_if(spread > 1)"),
                    "median_spread_when_multiple": _median_sql("spread"),
                }
            )
        )
        .orderBy("grp")
    )


def labelled_status(df: DataFrame) -> DataFrame:
    """Add the display label of the outcome; unknown outcomes keep their name."""
    return df.select("*", relabel("delivery_status", STATUS_LABELS).alias("delivery_outcome"))
