"""The given order/part/supplier tables reshaped into the raw delivery tables.

The given tables have no delivery timestamps, zip codes, reviews or nulls, so
these are derived from the keys by integer arithmetic. Every table is a lazy
projection of the given Parquet files, so a query scans only what it uses.
"""

from __future__ import annotations

from functools import cache, cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from freightlens.functions.labels import text_sql
from freightlens.operators.numbering import number_rows

# English names of the categories cat_1, cat_2, … in this order.
# The spelling is that of the source, and the categories after the last one have
# no translation.
CATEGORY_NAMES = [
    "audio",
    "computers",
    "telephony",
    "bed_bath_table",
    "home_confort",
    "housewares",
    "fashio_female_clothing",
    "fashion_shoes",
    "watches_gifts",
    "baby",
    "health_beauty",
    "perfumery",
    "costruction_tools_garden",
    "garden_tools",
    "pet_shop",
    "art",
    "books_technical",
    "toys",
    "drinks",
    "food_drink",
    "auto",
    "market_place",
    "not_in_any_bucket",
]


def _plus(ts: str, unit: str, amount: str) -> str:
    return f"timestampadd({unit}, CAST({amount} AS INT), {ts})"


_PURCHASE = _plus("o_orderdate", "HOUR", "7 * o_orderkey % 24")


def _zip(nation: str, key: str) -> str:
    return f"CAST(CAST({nation} * 100 + {key} % 20 AS BIGINT) AS STRING)"


def _city(key: str) -> str:
    return f"if({key} % 5 = 0, upper(n_name), lower(n_name))"


class GivenTables:
    """Raw delivery tables over a folder of given Parquet tables."""

    def __init__(self, spark: SparkSession, folder: str) -> None:
        self.spark = spark
        self.given = cache(lambda name: spark.read.parquet(f"{folder}/{name}.parquet"))

    def file_bytes(self, *names: str) -> int:
        """The size of given tables as files."""
        plans = [self.given(name)._jdf.queryExecution().optimizedPlan() for name in names]
        return sum(int(str(p.stats().sizeInBytes())) for p in plans)

    @cached_property
    def orders(self) -> DataFrame:
        canceled, unhanded, lost = "o_orderkey % 31 = 0", "o_orderkey % 41 = 0", "o_orderkey % 43 = 0"
        approved = _plus("purchase", "MINUTE", "13 * o_orderkey % 72 * 60 + 17 * o_orderkey % 60")
        handed = _plus("coalesce(approved, purchase)", "HOUR", "11 * o_orderkey % 240")
        delivered = _plus("handed", "MINUTE", "19 * o_orderkey % 600 * 60 + 23 * o_orderkey % 60")
        return (
            self.given("orders")
            .selectExpr("o_orderkey", "o_custkey", "o_orderdate", f"{_PURCHASE} AS purchase")
            .selectExpr("*", f"if({canceled} OR o_orderkey % 37 = 0, NULL, {approved}) AS approved")
            .selectExpr("*", f"if({canceled} OR {unhanded}, NULL, {handed}) AS handed")
            .selectExpr(
                "o_orderkey AS order_id",
                "o_custkey AS customer_id",
                f"""CASE WHEN {canceled} THEN 'canceled' WHEN {unhanded} THEN 'processing'
                    WHEN {lost} THEN 'shipped' ELSE 'delivered' END AS order_status""",
                "purchase AS order_purchase_timestamp",
                "approved AS order_approved_at",
                "handed AS order_delivered_carrier_date",
                f"if({lost}, NULL, {delivered}) AS order_delivered_customer_date",
                _plus("o_orderdate", "DAY", "12 + o_orderkey % 16")
                + " AS order_estimated_delivery_date",
            )
        )

    @cached_property
    def _lines(self) -> DataFrame:
        return self.given("lineitem").select(
            "l_orderkey",
            "l_partkey",
            "l_suppkey",
            "l_linenumber",
            "l_quantity",
            "l_extendedprice",
            "l_tax",
            "l_shipdate",
        )

    @cached_property
    def _numbered_lines(self) -> DataFrame:
        return number_rows(
            self._lines,
            key="l_orderkey",
            order_by=[
                "l_linenumber",
                "l_partkey",
                "l_suppkey",
                "l_extendedprice",
                "l_quantity",
                "l_shipdate",
            ],
            name="order_item_id",
        )

    def items(
        self, ids: bool = False, limits: bool = False, orders: DataFrame | None = None
    ) -> DataFrame:
        """Order items, with the two costly columns on demand.

        ``ids`` adds ``order_item_id``, the place of a line within its order, and
        ``limits`` adds ``shipping_limit_date``, which needs the order's date.
        Without both this is a projection of the lines and shuffles nothing.
        Numbering runs at once, on first use, and returns what it has written.
        ``orders`` keeps the items whose order_id it has; they keep their places.
        """
        lines = self._numbered_lines if ids else self._lines
        if orders is not None:
            kept = orders.select(F.col("order_id").alias("l_orderkey"))
            lines = lines.join(kept, "l_orderkey", "left_semi")
        if limits:
            dates = self.given("orders").selectExpr(
                "o_orderkey AS l_orderkey", f"{_PURCHASE} AS purchase"
            )
            lines = lines.join(dates, "l_orderkey", "left")
        suppliers = self.given("supplier").agg(F.count("*")).scalar()
        by_order = F.expr("7 * l_orderkey") % suppliers
        seller = F.when(F.expr("l_orderkey % 3 = 0"), F.col("l_suppkey")).otherwise(by_order)
        columns = {
            "order_id": F.col("l_orderkey"),
            "order_item_id": F.col("order_item_id").cast("int"),
            "product_id": F.col("l_partkey"),
            "seller_id": seller,
            "shipping_limit_date": F.expr(_plus("purchase", "DAY", "3 + l_linenumber")),
            "price": F.col("l_extendedprice"),
            "freight_value": F.expr("rint(l_quantity * (1 + 100 * l_tax) * 100) / 100"),
        }
        if not ids:
            del columns["order_item_id"]
        if not limits:
            del columns["shipping_limit_date"]
        return lines.select(*[c.alias(name) for name, c in columns.items()])

    @cached_property
    def order_items(self) -> DataFrame:
        return self.items(ids=True, limits=True)

    @cached_property
    def order_reviews(self) -> DataFrame:
        reviews = "array_compact(array(if(order_id % 20 = 0, NULL, 0), if(order_id % 50 = 1, 1, NULL)))"
        ended = "coalesce(order_delivered_customer_date, order_estimated_delivery_date)"
        created = _plus(f"CAST(CAST({ended} AS DATE) AS TIMESTAMP_NTZ)", "DAY", "2 * j")
        return (
            self.orders.selectExpr("*", f"explode({reviews}) AS j")
            .selectExpr("order_id", "j", f"{created} AS review_creation_date")
            .selectExpr(
                "2 * order_id + j AS review_id",
                "order_id",
                "CAST(1 + (7 * order_id + 3 * j) % 5 AS INT) AS review_score",
                "review_creation_date",
                _plus("review_creation_date", "HOUR", "order_id % 72") + " AS review_answer_timestamp",
            )
        )

    @cached_property
    def _places(self) -> DataFrame:
        nation = self.given("nation").withColumnRenamed("n_regionkey", "r_regionkey")
        return nation.join(self.given("region"), "r_regionkey").select(
            "n_nationkey", "n_name", "r_name"
        )

    def _placed(self, table: str, nation_key: str) -> DataFrame:
        rows = self.given(table).withColumnRenamed(nation_key, "n_nationkey")
        return rows.join(self._places, "n_nationkey")

    @cached_property
    def customers(self) -> DataFrame:
        return self._placed("customer", "c_nationkey").selectExpr(
            "c_custkey AS customer_id",
            "c_custkey AS customer_unique_id",
            f"{_zip('n_nationkey', 'c_custkey')} AS customer_zip_code_prefix",
            f"{_city('c_custkey')} AS customer_city",
            "if(c_custkey % 211 = 0, NULL, r_name) AS customer_state",
        )

    @cached_property
    def sellers(self) -> DataFrame:
        return self._placed("supplier", "s_nationkey").selectExpr(
            "s_suppkey AS seller_id",
            f"{_zip('n_nationkey', 's_suppkey')} AS seller_zip_code_prefix",
            "n_name AS seller_city",
            "r_name AS seller_state",
        )

    @cached_property
    def geolocation(self) -> DataFrame:
        customers = self._placed("customer", "c_nationkey").selectExpr(
            "c_custkey AS key", "n_nationkey AS nation", f"{_city('c_custkey')} AS city", "r_name"
        )
        suppliers = self._placed("supplier", "s_nationkey").selectExpr(
            "s_suppkey AS key", "n_nationkey AS nation", "n_name AS city", "r_name"
        )
        return (
            customers.unionByName(suppliers)
            .filter("key % 20 != 19")
            .selectExpr(
                f"{_zip('nation', 'key')} AS geolocation_zip_code_prefix",
                "-30D + 1.2D * (nation % 5) + 0.01D * (key % 7) AS geolocation_lat",
                "-65D + 4.5D * (nation div 5) + 0.01D * (key % 4) AS geolocation_lng",
                "city AS geolocation_city",
                "r_name AS geolocation_state",
            )
        )

    @cached_property
    def products(self) -> DataFrame:
        return self.given("part").selectExpr(
            "p_partkey AS product_id",
            """if(p_partkey % 50 = 0, NULL, concat('cat_', substring_index(p_brand, '#', -1)))
                AS product_category_name""",
            "length(p_name) AS product_name_lenght",
            "10 * p_size AS product_description_lenght",
            "CAST(1 + p_partkey % 6 AS INT) AS product_photos_qty",
            "if(p_partkey % 97 = 0, NULL, 800 * p_size) AS product_weight_g",
            "16 + 2 * p_size AS product_length_cm",
            "CAST(2 + p_partkey % 100 AS INT) AS product_height_cm",
            "CAST(11 + p_partkey % 110 AS INT) AS product_width_cm",
        )

    @cached_property
    def product_category_name_translation(self) -> DataFrame:
        """The categories that occur among the products and have an English name."""
        names = f"array({', '.join(text_sql(n) for n in CATEGORY_NAMES)})"
        number = "CAST(substring_index(product_category_name, '_', -1) AS INT)"
        return (
            self.products.select("product_category_name")
            .distinct()
            .selectExpr(
                "product_category_name",
                f"get({names}, {number} - 1) AS product_category_name_english",
            )
            .filter("product_category_name_english IS NOT NULL")
        )

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)
