"""The star schema: one item-grain fact and five dimensions (D-12 … D-17)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freightlens.functions.geo import direction_lat, direction_lng, unit_vector
from freightlens.plans.intermediate import order_rollup, order_totals

STAGE_COLUMNS = [
    "approval_delay_days",
    "seller_handling_days",
    "transit_days",
    "total_delivery_days",
    "delivery_delay_days",
    "delivery_status",
]
ORDER_COLUMNS = [
    "order_status",
    "order_purchase_at",
    "order_approved_at",
    "order_delivered_carrier_at",
    "order_delivered_customer_at",
    "order_estimated_delivery_at",
]
ROLLUP_COLUMNS = [
    "item_count",
    "distinct_seller_count",
    "order_revenue",
    "order_freight",
    "avg_review_score",
    "review_count",
]


def order_facts(
    stages: DataFrame, items: DataFrame, reviews: DataFrame, with_sellers: bool = True
) -> DataFrame:
    """Everything that is a fact of the order, one row per order (J-2).

    Items and reviews are rolled up before they are joined, so nothing fans out
    and every join is between unique keys. The order-level marts read this
    instead of collapsing the item-grain fact again. Most of them need no seller
    columns and save a shuffle without them.
    """
    rollup = order_rollup(items) if with_sellers else order_totals(items)
    scores = reviews.groupBy("order_id").agg(
        F.avg("review_score").alias("avg_review_score"),
        F.count("*").alias("review_count"),
    )
    counted = [
        c
        for c in ("item_count", "distinct_seller_count", "order_revenue", "order_freight")
        if c in rollup.columns
    ]
    joined = stages.join(rollup, "order_id", "left").join(scores, "order_id", "left")
    return joined.fillna(0, counted)


def item_facts(items: DataFrame, stages: DataFrame) -> DataFrame:
    """Items of known orders with the order's stages: the fact without its rollups.

    Item-grain marts need no more than this. Items are the left side, which AQE
    can split when one order is very large.
    """
    return items.selectExpr(
        "order_id",
        "seller_id",
        "product_id",
        "price AS item_price",
        "freight_value AS item_freight",
    ).join(stages, "order_id")


def fact_orders(orders: DataFrame, items: DataFrame) -> DataFrame:
    """One row per (order, item); an order without items keeps one row (D-12, J-1).

    ``orders`` comes from ``order_facts`` over the same items. Instead of a left
    join from orders, whose large side cannot be split when one order is huge,
    every order contributes one empty line to the items, and the empty lines of
    orders with items fall away. The header row is one row with the order's
    lowest item id, a null id before all others; the rollup already knows the
    id, and of rows that repeat it the first by their other columns is taken.
    That window is over (order_id, order_item_id), so a huge order is spread.
    The empty lines are dealt out by order like the items, which the join therefore need not
    shuffle again.
    """
    repeats = """row_number() OVER (PARTITION BY order_id, order_item_id
        ORDER BY product_id, seller_id, shipping_limit_date, price, freight_value) AS _repeat"""
    lines = items.selectExpr(
        "order_id",
        "order_item_id",
        "seller_id",
        "product_id",
        "shipping_limit_date AS item_shipping_limit_at",
        "price AS item_price",
        "freight_value AS item_freight",
        "false AS _empty",
        repeats,
    )
    empty = orders.selectExpr("order_id", "true AS _empty", "1 AS _repeat").repartition("order_id")
    return (
        lines.unionByName(empty, allowMissingColumns=True)
        .join(orders, "order_id")
        .filter("NOT _empty OR item_count = 0")
        .selectExpr(
            "order_id",
            "order_item_id",
            "customer_id",
            "seller_id",
            "product_id",
            "_repeat = 1 AND order_item_id <=> first_item_id AS is_order_header_row",
            *ORDER_COLUMNS,
            "item_shipping_limit_at",
            "item_price",
            "item_freight",
            *STAGE_COLUMNS,
            *ROLLUP_COLUMNS,
        )
    )


def header_rows(fact: DataFrame) -> DataFrame:
    """The fact at order grain, for a fact that was read back from a table (P-6)."""
    return fact.filter("is_order_header_row")


def dim_customer(customers: DataFrame) -> DataFrame:
    return customers.select(
        "customer_id",
        "customer_unique_id",
        "customer_zip_code_prefix",
        "customer_city",
        "customer_state",
    )


def dim_seller(sellers: DataFrame) -> DataFrame:
    return sellers.select("seller_id", "seller_zip_code_prefix", "seller_city", "seller_state")


def dim_products(products: DataFrame) -> DataFrame:
    """Products with the sum and the product of their three sides, as bigint (P-4)."""
    sides = [f"CAST(product_{side}_cm AS BIGINT)" for side in ("length", "height", "width")]
    return products.selectExpr(
        "*", f"{' + '.join(sides)} AS product_dimension", f"{' * '.join(sides)} AS product_volume"
    )


def fixed_span(spark: SparkSession, start: str = "2016-01-01", end: str = "2019-01-01") -> DataFrame:
    """One row (start, end) of dates."""
    return spark.range(1).selectExpr(f"DATE '{start}' AS start", f"DATE '{end}' AS end")


def order_span(orders: DataFrame) -> DataFrame:
    """One row (start, end) that covers the calendar years of all purchases."""
    return orders.agg(
        F.expr("trunc(CAST(min(order_purchase_at) AS DATE), 'YEAR')").alias("start"),
        F.expr("trunc(add_months(CAST(max(order_purchase_at) AS DATE), 12), 'YEAR')").alias("end"),
    )


def dim_date(span: DataFrame) -> DataFrame:
    """One row per day from start to the day before end (D-16, F-5 … F-8)."""
    return span.selectExpr("explode(sequence(start, date_sub(end, 1))) AS date_key").selectExpr(
        "date_key",
        "year(date_key) AS year",
        "month(date_key) AS month",
        "date_format(date_key, 'yyyy-MM') AS year_month",
        "date_format(date_key, 'MMMM') AS month_name",
        "dayofmonth(date_key) AS day_of_month",
        "dayofweek(date_key) AS day_of_week",
        "dayofweek(date_key) IN (1, 7) AS is_weekend",
    )


def dim_geolocation(geolocation: DataFrame) -> DataFrame:
    """Most frequent (city, state) and centroid per zip code (D-17, A-16, A-17).

    Both halves are plain two-step aggregates: a zip with a third of all rows
    shrinks to its distinct names and points before the second shuffle. Equal
    counts are decided by city and state. A point counts once however often it
    is recorded; the centroid is the direction of the sum of its unit vectors.
    """
    zip_code = "zip_code_prefix"
    names = geolocation.groupBy(zip_code, "city", "state").agg(F.count("*").alias("n"))
    usual = names.groupBy(zip_code).agg(F.expr("min(struct(-n, city, state))").alias("name"))
    return usual.join(zip_centroids(geolocation), zip_code, "left").select(
        zip_code, "name.city", "name.state", "centroid_lng", "centroid_lat"
    )


def zip_centroids(geolocation: DataFrame) -> DataFrame:
    """The centroid of every zip code that has a point; all that distances need."""
    zip_code = "zip_code_prefix"
    points = (
        geolocation.filter("longitude IS NOT NULL AND latitude IS NOT NULL")
        .select(zip_code, "longitude", "latitude")
        .distinct()
    )
    vector = unit_vector("longitude", "latitude")
    middle = points.groupBy(zip_code).agg(
        *[F.expr(f"avg({part})").alias(axis) for axis, part in zip("xyz", vector)]
    )
    return middle.select(
        zip_code,
        direction_lng("x", "y").alias("centroid_lng"),
        direction_lat("x", "y", "z").alias("centroid_lat"),
    )
