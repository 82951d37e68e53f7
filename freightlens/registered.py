"""Every model and operator as a named query over a folder of given tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freightlens.functions.aggregates import distinct_rows
from freightlens.functions.keys import KEY_SEP, NULL_SENTINEL, canonical_key
from freightlens.functions.status import LATE, STATUS_LABELS
from freightlens.operators import quality, reconcile
from freightlens.operators.distinct import (
    dense_ids,
    distinct_cells,
    distinct_counts,
    with_dense_ids,
)
from freightlens.operators.quantiles import exact_quantiles
from freightlens.plans import core, explore, intermediate, views
from freightlens.plans.layers import Layers
from freightlens.plans.marts import SIZES
from freightlens.session import fine_session, new_run_dir, written
from freightlens.sources import incremental, landing
from freightlens.sources.catalog import footer_profile, time_columns
from freightlens.sources.csv_scan import scan_folder
from freightlens.sources.given import GivenTables
from freightlens.sources.registry import REGISTRY
from freightlens.streaming.landing_stream import (
    file_stream,
    land_stream,
    land_stream_keyed,
    land_stream_within,
    state_session,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

# Parameters of the read-back queries; the given orders run from 1995 to 2001.
CUTOFF, PEAK, LATEST = "1997-01-01", "1995-11-01", "1996-08-01"
EVENTS_SINCE, EVENTS_UNTIL = "2024-01-10 00:00:00", "2024-01-25 00:00:00"


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded for comparison with another engine."""
    return df.selectExpr(
        *[
            f"round(`{f.name}`, {digits}) AS `{f.name}`"
            if isinstance(f.dataType, T.DoubleType)
            else f"`{f.name}`"
            for f in df.schema
        ]
    )


def layers(spark: SparkSession, folder: str, ids: bool = False, limits: bool = False) -> Layers:
    """The models, over items that carry only the costly columns a query needs, in small tasks."""
    read = GivenTables(spark, folder).file_bytes("orders", "lineitem")
    given = GivenTables(fine_session(spark, read), folder)
    return Layers(given, given.items(ids=ids, limits=limits))


# Staging and star schema


@query
def stg_orders(spark: SparkSession, folder: str) -> DataFrame:
    return layers(spark, folder).stg_orders


@query
def stg_order_items(spark: SparkSession, folder: str) -> DataFrame:
    return layers(spark, folder, ids=True, limits=True).stg_order_items


@query
def stg_order_reviews(spark: SparkSession, folder: str) -> DataFrame:
    return layers(spark, folder).stg_order_reviews


@query
def stg_geolocation(spark: SparkSession, folder: str) -> DataFrame:
    return layers(spark, folder).stg_geolocation


@query
def product_buckets(spark: SparkSession, folder: str) -> DataFrame:
    return layers(spark, folder).stg_product_cat_buckets


@query
def order_delivery_stages(spark: SparkSession, folder: str) -> DataFrame:
    return layers(spark, folder).stages


@query
def order_transit_shape(spark: SparkSession, folder: str) -> DataFrame:
    return layers(spark, folder, limits=True).shapes()


@query
def order_transit_shape_strict(spark: SparkSession, folder: str) -> DataFrame:
    """Other limits for a slow handoff (P-17)."""
    return layers(spark, folder, limits=True).shapes(slow_handoff_days=2, sla_breach_days=1)


@query
def seller_customer_distance(spark: SparkSession, folder: str) -> DataFrame:
    found = layers(spark, folder).distances
    points = [f"round({c}, 6) AS {c}" for c in found.columns[2:-1]]
    points.append("round(distance_meters, 3) AS distance_meters")
    return found.selectExpr("order_id", "seller_id", *points)


@query
def place_distances(spark: SparkSession, folder: str) -> DataFrame:
    """Distances by pair of zip codes."""
    return rounded(layers(spark, folder).place_distances, 3)


@query
def distance_by_place(spark: SparkSession, folder: str) -> DataFrame:
    """The distance of each (order, seller), looked up by the zip codes of both ends."""
    m = layers(spark, folder)
    pairs = m.stg_order_items.select("order_id", "seller_id").distinct()
    found = intermediate.with_known_distance(
        pairs, m.stg_orders, m.dim_seller, m.dim_customer, m.place_distances
    )
    return rounded(found.select("order_id", "seller_id", "distance_meters"), 3)


@query
def items_with_distance(spark: SparkSession, folder: str) -> DataFrame:
    m = layers(spark, folder)
    joined = intermediate.items_with_distance(m.stg_order_items, m.distances)
    return rounded(
        joined.groupBy("seller_id").agg(
            F.count("*").alias("items"),
            F.count("distance_meters").alias("located_items"),
            F.max("distance_meters").alias("farthest_meters"),
        ),
        3,
    )


@query
def fact_orders(spark: SparkSession, folder: str) -> DataFrame:
    return layers(spark, folder, ids=True, limits=True).fact_orders


@query
def dim_customer(spark: SparkSession, folder: str) -> DataFrame:
    return layers(spark, folder).dim_customer


@query
def dim_seller(spark: SparkSession, folder: str) -> DataFrame:
    return layers(spark, folder).dim_seller


@query
def dim_products(spark: SparkSession, folder: str) -> DataFrame:
    return layers(spark, folder).dim_products


@query
def dim_date(spark: SparkSession, folder: str) -> DataFrame:
    return layers(spark, folder).dim_date


@query
def dim_geolocation(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(layers(spark, folder).dim_geolocation)


# Marts


@query
def mart_delivery_kpis(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(layers(spark, folder).mart_delivery_kpis)


@query
def mart_monthly_sales(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(layers(spark, folder).mart_monthly_sales)


@query
def mart_satisfaction_by_delivery(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(layers(spark, folder).mart_satisfaction_by_delivery)


@query
def mart_delivery_delay_stages(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(layers(spark, folder).mart_delivery_delay_stages)


@query
def mart_pdt_delivery(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(layers(spark, folder).mart_pdt_delivery)


@query
def mart_delay_pdt_vs_dist(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(layers(spark, folder).mart_delay_pdt_vs_dist())


@query
def mart_delay_pdt_vs_dist_item_grain(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(layers(spark, folder).mart_delay_pdt_vs_dist("item"))


@query
def mart_seller_perf(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(layers(spark, folder).mart_seller_perf)


@query
def mart_seller_performance(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(layers(spark, folder, limits=True).mart_seller_performance)


@query
def mart_delivery_revenue_risk(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(layers(spark, folder).mart_delivery_revenue_risk())


@query
def mart_delivery_revenue_risk_order_grain(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(layers(spark, folder).mart_delivery_revenue_risk(order_grain=True))


@query
def mart_delivery_sunburst(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(layers(spark, folder).mart_delivery_sunburst())


@query
def mart_delivery_sunburst_order_grain(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(layers(spark, folder).mart_delivery_sunburst(order_grain=True))


@query
def mart_transit_drivers(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(layers(spark, folder, limits=True).mart_transit_drivers())


@query
def mart_transit_unclassified(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(layers(spark, folder, limits=True).mart_transit_unclassified())


# Data quality


def written_fact(spark: SparkSession, folder: str) -> DataFrame:
    """The fact as a table, so that several checks read it without building it again."""
    return written(layers(spark, folder, ids=True, limits=True).fact_orders, "fact_orders")


@query
def dq_unique(spark: SparkSession, folder: str) -> DataFrame:
    m = layers(spark, folder)
    return quality.failures(
        {
            "dim_customer.customer_id": quality.unique(m.dim_customer, "customer_id"),
            "dim_date.date_key": quality.unique(m.dim_date, "date_key"),
            "dim_products.product_id": quality.unique(m.dim_products, "product_id"),
            "dim_seller.seller_id": quality.unique(m.dim_seller, "seller_id"),
            "dim_geolocation.zip_code_prefix": quality.unique(
                m.dim_geolocation, "zip_code_prefix"
            ),
            "mart_seller_perf.seller_id": quality.unique(m.mart_seller_perf, "seller_id"),
            "mart_seller_performance.seller_id": quality.unique(
                layers(spark, folder, limits=True).mart_seller_performance, "seller_id"
            ),
            "mart_delivery_delay_stages.stage": quality.unique(
                m.mart_delivery_delay_stages, "stage"
            ),
            "customers.customer_city": quality.unique(m.stg_customers, "customer_city"),
        }
    )


@query
def dq_not_null(spark: SparkSession, folder: str) -> DataFrame:
    m = layers(spark, folder, limits=True)
    return quality.null_failures(
        {
            "dim_customer": (m.dim_customer, ["customer_id", "customer_state"]),
            "dim_date": (m.dim_date, ["date_key"]),
            "dim_products": (m.dim_products, ["product_id", "product_weight_g"]),
            "dim_seller": (m.dim_seller, ["seller_id"]),
            "dim_geolocation": (m.dim_geolocation, ["zip_code_prefix"]),
            "fact_orders": (
                written_fact(spark, folder),
                ["order_id", "is_order_header_row", "customer_id", "seller_id"],
            ),
            "mart_seller_perf": (m.mart_seller_perf, ["seller_id"]),
            "mart_delivery_delay_stages": (
                m.mart_delivery_delay_stages,
                ["stage", "pct_of_delay"],
            ),
            "mart_transit_drivers": (
                m.mart_transit_drivers(),
                ["order_shape", "distance_band", "order_count"],
            ),
            "mart_transit_unclassified": (
                m.mart_transit_unclassified(),
                ["unclassified_reason", "order_count"],
            ),
            "mart_pdt_delivery": (
                m.mart_pdt_delivery,
                ["product_category_buckets", "product_size_buckets"],
            ),
            "mart_seller_performance": (
                m.mart_seller_performance,
                ["seller_id", "late_delivery_pct"],
            ),
        }
    )


@query
def dq_relationships(spark: SparkSession, folder: str) -> DataFrame:
    """Keys of the fact, as written, and of the models that refer to a dimension."""
    m = layers(spark, folder)
    fact = written_fact(spark, folder)
    return quality.orphan_rows(
        {
            "fact_orders.customer_id": quality.relationships(
                fact, "customer_id", m.dim_customer, "customer_id"
            ),
            "fact_orders.seller_id": quality.relationships(
                fact, "seller_id", m.dim_seller, "seller_id"
            ),
            "mart_seller_perf.seller_id": quality.relationships(
                m.mart_seller_perf, "seller_id", m.dim_seller, "seller_id"
            ),
            "fact_orders.product_id": quality.relationships(
                fact, "product_id", m.dim_products, "product_id"
            ),
            "dim_customer.customer_zip_code_prefix": quality.relationships(
                m.dim_customer, "customer_zip_code_prefix", m.dim_geolocation, "zip_code_prefix"
            ),
        }
    )


@query
def dq_unique_combo(spark: SparkSession, folder: str) -> DataFrame:
    m = layers(spark, folder, limits=True)
    fact = written_fact(spark, folder)
    return quality.failures(
        {
            "fact_orders": quality.unique_combination(fact, ["order_id", "order_item_id"]),
            "mart_transit_drivers": quality.unique_combination(
                m.mart_transit_drivers(), ["order_shape", "distance_band"]
            ),
            "mart_transit_unclassified": quality.unique_combination(
                m.mart_transit_unclassified(),
                ["distance_band", "unclassified_reason", "order_status"],
            ),
            "order_items by order and product": quality.unique_combination(
                m.stg_order_items, ["order_id", "product_id"]
            ),
        }
    )


@query
def dq_in_set(spark: SparkSession, folder: str) -> DataFrame:
    m = layers(spark, folder, limits=True)
    return quality.failures(
        {
            "fact_orders.delivery_status": quality.values_in_set(
                written_fact(spark, folder), "delivery_status", list(STATUS_LABELS)
            ),
            "mart_delivery_delay_stages.stage": quality.values_in_set(
                m.mart_delivery_delay_stages, "stage", list(views.STAGE_LABELS)
            ),
            "mart_transit_drivers.order_shape": quality.values_in_set(
                m.mart_transit_drivers(), "order_shape", intermediate.SHAPES
            ),
            "mart_transit_drivers.distance_band": quality.values_in_set(
                m.mart_transit_drivers(), "distance_band", intermediate.BANDS
            ),
            "mart_transit_unclassified.unclassified_reason": quality.values_in_set(
                m.mart_transit_unclassified(), "unclassified_reason", list(views.REASON_LABELS)
            ),
            "mart_pdt_delivery.product_size_buckets": quality.values_in_set(
                m.mart_pdt_delivery, "product_size_buckets", SIZES[:4]
            ),
        }
    )


@query
def dq_between(spark: SparkSession, folder: str) -> DataFrame:
    fact, present = written_fact(spark, folder), "item_freight IS NOT NULL"
    return quality.failures(
        {
            f"fact_orders.item_freight 0..{most}": quality.values_between(
                fact, "item_freight", 0, most, present
            )
            for most in (500, 250)
        }
    )


@query
def dq_pair_greater(spark: SparkSession, folder: str) -> DataFrame:
    fact = written_fact(spark, folder)
    delivered, purchased = "order_delivered_customer_at", "order_purchase_at"
    return quality.failures(
        {
            "delivered after purchase": quality.pair_greater(
                fact,
                delivered,
                purchased,
                row_condition=f"{delivered} IS NOT NULL AND {purchased} IS NOT NULL",
            ),
            "estimate not before delivery": quality.pair_greater(
                fact,
                "order_estimated_delivery_at",
                delivered,
                or_equal=True,
                row_condition=f"{delivered} IS NOT NULL",
            ),
        }
    )


@query
def dq_header_invariant(spark: SparkSession, folder: str) -> DataFrame:
    fact = written_fact(spark, folder)
    return quality.failures({"one header row per order": quality.one_header_per_order(fact)})


# Reconciliation


@query
def reconcile_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Raw orders against their landed copy, written and read back."""
    given = GivenTables(spark, folder)
    zone = new_run_dir(spark, "landing")
    landing.land({"orders": landing.normalise(given.orders)}, zone)
    copies = {"landing": lambda: spark.read.parquet(f"{zone}/orders")}
    copies["raw"] = lambda: spark.read.parquet(f"{zone}/not_there")
    keys = REGISTRY["orders"].key
    found = reconcile.reconcile("orders", given.orders, copies, keys, deep=True)
    # Why a path cannot be read is said in the engine's own words.
    said = F.when(F.col("check") != "reachable", F.col("detail"))
    return found.select("table", "check", "layer", "ok", said.alias("detail"))


@query
def reconcile_items_mutated(spark: SparkSession, folder: str) -> DataFrame:
    """Items against a copy whose prices are higher in one order of a thousand, and
    against one that lacks a column and some sellers."""
    raw = layers(spark, folder, ids=True, limits=True).stg_order_items
    items = written(raw, "order_items")
    changed = items.withColumn(
        "price", F.when(F.col("order_id") % 1000 == 7, F.col("price") + 100).otherwise(F.col("price"))
    )
    swapped = items.withColumn(
        "seller_id", F.when(F.col("order_id") % 1000 != 7, F.col("seller_id"))
    ).drop("freight_value")
    layers_of = {"prices": changed, "sellers": swapped}
    found = reconcile.reconcile(
        "order_items", items, layers_of, REGISTRY["order_items"].key, deep=True
    )
    # Totals of doubles differ in their last digits between engines; names do not.
    named = F.regexp_replace("detail", "=[^ ;]+", "=")
    return found.select("table", "check", "layer", "ok", named.alias("detail"))


@query
def reconcile_report(spark: SparkSession, folder: str) -> DataFrame:
    return reconcile.report(reconcile_items_mutated(spark, folder))


@query
def reconcile_key_digest(spark: SparkSession, folder: str) -> DataFrame:
    items = layers(spark, folder, ids=True).stg_order_items
    return reconcile.key_digest(items, REGISTRY["order_items"].key)


@query
def reconcile_key_differences(spark: SparkSession, folder: str) -> DataFrame:
    """Orders without items, and none the other way round."""
    m = layers(spark, folder)
    return reconcile.key_differences(m.stg_orders, m.stg_order_items, ("order_id",))


def _items_and_changed(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Lines as given, and a copy with one order's lines renumbered and another's left out."""
    lines = GivenTables(spark, folder).given("lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    changed = lines.filter("l_orderkey <> 1234").withColumn(
        "l_linenumber", F.expr("if(l_orderkey = 77, l_linenumber + 50, l_linenumber)")
    )
    return lines, changed


@query
def reconcile_key_buckets(spark: SparkSession, folder: str) -> DataFrame:
    """Which buckets of the key set differ, from stored digests."""
    keys = ("l_orderkey", "l_linenumber", "l_partkey")
    base = new_run_dir(spark, "key-trees")
    for i, df in enumerate(_items_and_changed(spark, folder)):
        reconcile.key_tree(df, keys, f"{base}/{i}")
    stored = (reconcile.stored_key_tree(spark, f"{base}/{i}") for i in range(2))
    return reconcile.differing_buckets(*stored)


@query
def reconcile_changed_keys(spark: SparkSession, folder: str) -> DataFrame:
    """The few keys in which two nearly equal layers differ."""
    keys = ("l_orderkey", "l_linenumber", "l_partkey")
    found = reconcile.key_differences(*_items_and_changed(spark, folder), keys)
    return found.select(F.replace("key", F.lit(KEY_SEP), F.lit("|")).alias("key"), "side")


@query
def distinct_composite_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct keys with null parts (A-20)."""
    m = layers(spark, folder)
    return m.stg_products.select("product_weight_g", "product_photos_qty").agg(
        distinct_rows("product_weight_g", "product_photos_qty").alias("n")
    )


# Exploration


@query
def n1_row_counts(spark: SparkSession, folder: str) -> DataFrame:
    m = layers(spark, folder, ids=True, limits=True)
    return explore.row_counts(
        {
            "warehouse": {
                "stg_orders": m.stg_orders,
                "stg_order_items": m.stg_order_items,
                "stg_order_reviews": m.stg_order_reviews,
                "stg_customers": m.stg_customers,
                "int_order_delivery_stages": m.stages,
                "dim_customer": m.dim_customer,
                "dim_date": m.dim_date,
                "fact_orders": m.fact_orders,
            },
            "reporting": {
                "mart_delivery_kpis": m.mart_delivery_kpis,
                "mart_satisfaction_by_delivery": m.mart_satisfaction_by_delivery,
                "mart_monthly_sales": m.mart_monthly_sales,
            },
        }
    )


@query
def n1_footer_figures(spark: SparkSession, folder: str) -> DataFrame:
    """Rows, values and extremes of the given tables, from the footers of their files."""
    found = []
    for table in ("orders", "lineitem", "customer", "part"):
        profile = footer_profile(spark, f"{folder}/{table}.parquet")
        found.append(profile.withColumn("table", F.lit(table)))
    return reduce(DataFrame.unionAll, found)


@query
def price_quantiles(spark: SparkSession, folder: str) -> DataFrame:
    """Exact quantiles of line prices by return flag, and of all lines."""
    lines = GivenTables(spark, folder).given("lineitem")
    shares = [0.01, 0.25, 0.5, 0.9, 0.99]
    of_flag = exact_quantiles(lines, "l_extendedprice", shares, ["l_returnflag"])
    of_all = exact_quantiles(lines, "l_extendedprice", shares)
    return of_flag.unionByName(of_all.withColumn("l_returnflag", F.lit("all")))


def _customer_cells(spark: SparkSession, folder: str) -> DataFrame:
    """Bitmaps of the customers of each month and state, all and late ones, as a table."""
    m = layers(spark, folder)
    orders = m.stages.join(m.dim_customer.select("customer_id", "customer_state"), "customer_id")
    month = F.date_format("order_purchase_at", "yyyy-MM").alias("order_month")
    sold = orders.select(month, "customer_state", "customer_id", "delivery_status")
    cells = distinct_cells(
        sold, "customer_id", ["order_month", "customer_state"], {"customers": "true", "late_customers": LATE}
    )
    return written(cells, "customer-cells")


@query
def monthly_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct customers by month and state."""
    return distinct_counts(_customer_cells(spark, folder), ["order_month", "customer_state"])


@query
def yearly_customers(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct customers by year, rolled up from the stored months without the orders."""
    year = F.substring("order_month", 1, 4).cast("int")
    return distinct_counts(_customer_cells(spark, folder), ["order_year"], {"order_year": year})


@query
def distinct_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct (order, line) keys by return flag, and by status, from one set of bitmaps (A-20)."""
    lines = GivenTables(spark, folder).given("lineitem")
    key = ["l_orderkey", "l_linenumber"]
    numbered = with_dense_ids(lines, dense_ids(lines, key), key)
    cells = written(distinct_cells(numbered, "dense_id", ["l_returnflag", "l_linestatus"]), "line-cells")
    by_flag = distinct_counts(cells, ["l_returnflag"]).withColumnRenamed("l_returnflag", "of")
    by_status = distinct_counts(cells, ["l_linestatus"]).withColumnRenamed("l_linestatus", "of")
    return by_flag.unionAll(by_status).unionAll(
        distinct_counts(cells.withColumn("of", F.lit("all")), ["of"])
    )


@query
def n2_null_profile(spark: SparkSession, folder: str) -> DataFrame:
    return explore.null_profile(layers(spark, folder, ids=True, limits=True).fact_orders)


@query
def n3_date_coverage(spark: SparkSession, folder: str) -> DataFrame:
    return explore.date_coverage(layers(spark, folder).stages)


@query
def n4_status_distribution(spark: SparkSession, folder: str) -> DataFrame:
    m = layers(spark, folder)
    return rounded(explore.satisfaction_in_order(m.mart_satisfaction_by_delivery))


@query
def n5_time_columns(spark: SparkSession, folder: str) -> DataFrame:
    given = GivenTables(spark, folder)
    names = [name for name in REGISTRY if name != "order_payments"]
    tables = {name: given.table(name) for name in names if name != "order_items"}
    tables["order_items"] = given.items(limits=True)
    return time_columns(tables)


@query
def n6_deadline_spread(spark: SparkSession, folder: str) -> DataFrame:
    return explore.deadline_spread(layers(spark, folder, limits=True).stg_order_items)


@query
def n7_seller_states(spark: SparkSession, folder: str) -> DataFrame:
    m = layers(spark, folder)
    return explore.seller_states(m.stg_order_items, m.stg_sellers)


@query
def n8_controlled_transit(spark: SparkSession, folder: str) -> DataFrame:
    m = layers(spark, folder)
    return explore.controlled_transit(
        m.stg_order_items, m.stg_sellers, m.stg_orders, m.stg_customers
    )


@query
def n9_review_spread(spark: SparkSession, folder: str) -> DataFrame:
    m = layers(spark, folder)
    return explore.review_spread(m.stg_order_items, m.stg_order_reviews)


# Read-back


@query
def v1_monthly_trend(spark: SparkSession, folder: str) -> DataFrame:
    m = layers(spark, folder)
    return rounded(views.monthly_trend(m.mart_monthly_sales, CUTOFF))


@query
def v2_change_between(spark: SparkSession, folder: str) -> DataFrame:
    trend = views.monthly_trend(layers(spark, folder).mart_monthly_sales, CUTOFF)
    return rounded(views.change_between(trend, PEAK, LATEST))


@query
def v3_revenue_risk(spark: SparkSession, folder: str) -> DataFrame:
    return views.revenue_risk_table(layers(spark, folder).mart_delivery_revenue_risk())


@query
def v4_revenue_by_outcome(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(views.revenue_by_outcome(layers(spark, folder).mart_delivery_sunburst()))


@query
def v5_satisfaction(spark: SparkSession, folder: str) -> DataFrame:
    return views.satisfaction_table(layers(spark, folder).mart_satisfaction_by_delivery)


def _leading_sellers(spark: SparkSession, folder: str) -> DataFrame:
    return views.leading_sellers(layers(spark, folder, limits=True).mart_seller_performance)


@query
def v6_top_sellers(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(views.top_sellers(_leading_sellers(spark, folder)))


@query
def v7_worst_shippers(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(views.worst_shippers(_leading_sellers(spark, folder)))


@query
def v8_stage_table(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(views.stage_table(layers(spark, folder).mart_delivery_delay_stages))


@query
def v9_zone_size_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(views.zone_size_matrix(layers(spark, folder).mart_delay_pdt_vs_dist()))


@query
def v9_zone_size_matrix_chosen(spark: SparkSession, folder: str) -> DataFrame:
    mart = layers(spark, folder).mart_delay_pdt_vs_dist()
    return rounded(views.zone_size_matrix(mart, ["Zone 2", "Zone 3"], ["L", "XL"]))


@query
def v10_transit_segments(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(
        views.transit_segments(layers(spark, folder, limits=True).mart_transit_drivers())
    )


@query
def v11_unclassified_totals(spark: SparkSession, folder: str) -> DataFrame:
    return views.unclassified_totals(
        layers(spark, folder, limits=True).mart_transit_unclassified()
    )


@query
def v11_unclassified_by_reason(spark: SparkSession, folder: str) -> DataFrame:
    return views.unclassified_by_reason(
        layers(spark, folder, limits=True).mart_transit_unclassified()
    )


@query
def v11_unclassified_detail(spark: SparkSession, folder: str) -> DataFrame:
    return views.unclassified_detail(
        layers(spark, folder, limits=True).mart_transit_unclassified()
    )


@query
def v12_category_size_matrix(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(views.category_size_matrix(layers(spark, folder).mart_pdt_delivery))


@query
def v13_freight_vs_late(spark: SparkSession, folder: str) -> DataFrame:
    mart = layers(spark, folder).mart_pdt_delivery
    return rounded(views.freight_vs_late(mart, (0, 150), (0, 50)))


# Ingest


@query
def csv_landing_counts(spark: SparkSession, folder: str) -> DataFrame:
    """CSV files → landing → raw for all present tables; rows per table in both zones.

    The files are written from the given tables first. One registered table,
    the payments, has no file and is skipped.
    """
    given = GivenTables(spark, folder)
    base = new_run_dir(spark, "ingest")
    written = [name for name in REGISTRY if name != "order_payments"]
    for name in written:
        given.table(name).write.option("header", True).csv(f"{base}/csv/{name}.csv")
    found = scan_folder(spark, f"{base}/csv")
    landed = landing.land(found, f"{base}/landing")
    copied = landing.copy_zone(spark, f"{base}/landing", f"{base}/raw", landed)
    zones = {"landing": landed, "raw": copied}
    rows = [(zone, name, n) for zone, counts in zones.items() for name, n in counts.items()]
    return spark.createDataFrame(rows, "zone STRING, table STRING, row_count BIGINT")


@query
def csv_roundtrip_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders written as CSV and scanned with their declared types."""
    given = GivenTables(spark, folder)
    base = new_run_dir(spark, "csv")
    given.orders.write.option("header", True).csv(f"{base}/orders.csv")
    return scan_folder(spark, base, tables=["orders"])["orders"]


@query
def csv_contents(spark: SparkSession, folder: str) -> DataFrame:
    """Every table after CSV, scan and landing: rows, and a digest of each column's values."""
    given = GivenTables(spark, folder)
    base = new_run_dir(spark, "contents")
    names = [name for name in REGISTRY if name != "order_payments"]
    for name in names:
        given.table(name).write.option("header", True).csv(f"{base}/csv/{name}.csv")
    landing.land(scan_folder(spark, f"{base}/csv"), f"{base}/landing")
    landed = landing.read_zone(spark, f"{base}/landing", names)
    return reduce(DataFrame.unionAll, [_column_digests(n, df) for n, df in landed.items()])


def _column_digests(name: str, df: DataFrame) -> DataFrame:
    """(table, column, nulls, digest); the digest adds up a part of each value's hash."""
    parts = []
    for f in df.schema:
        c = F.col(f.name)
        if isinstance(f.dataType, T.DoubleType):
            text = F.round(c * 1000).cast("long").cast("string")
        elif isinstance(f.dataType, T.TimestampNTZType):
            text = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        else:
            text = c.cast("string")
        number = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("decimal(28,0)")
        parts.append(
            F.struct(
                F.lit(name).alias("table"),
                F.lit(f.name).alias("column"),
                F.count_if(c.isNull()).alias("nulls"),
                F.coalesce(F.sum(number), F.lit(0)).cast("string").alias("digest"),
            ).alias(f.name)
        )
    return df.agg(*parts).select(F.explode(F.array(*[f"`{f.name}`" for f in df.schema])).alias("m")).select("m.*")


@query
def normalised_values(spark: SparkSession, folder: str) -> DataFrame:
    """Values of every kind that normalisation changes, from the given lines (I-7)."""
    lines = GivenTables(spark, folder).given("lineitem")
    odd = lines.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        F.expr("if(l_orderkey % 5 = 0, double('NaN'), l_tax)").alias("tax"),
        F.col("l_quantity").cast("decimal(10,2)").alias("quantity"),
        F.encode(F.col("l_returnflag"), "UTF-8").alias("flag"),
        F.expr("if(l_orderkey % 7 = 0, NULL, struct(l_quantity AS q, if(l_orderkey % 3 = 0, double('NaN'), l_tax) AS t))").alias("nested"),
        F.expr("array(l_discount, double('NaN'))").alias("listed"),
    )
    plain = landing.normalise(odd)
    return plain.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "tax",
        "quantity",
        "flag",
        F.col("nested.q").alias("nested_q"),
        F.col("nested.t").alias("nested_t"),
        F.expr("listed[0]").alias("listed_0"),
        F.expr("listed[1]").alias("listed_1"),
    )


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return GivenTables(spark, folder).given("events")


@query
def incremental_batch(spark: SparkSession, folder: str) -> DataFrame:
    """Events from a mark on, before an end, with a condition of the user's own."""
    since = F.lit(EVENTS_SINCE).cast("timestamp_ntz")
    until = F.lit(EVENTS_UNTIL).cast("timestamp_ntz")
    return incremental.load_table(
        _events(spark, folder),
        where=[("event_type", "!=", "error")],
        columns={"props": 0},
        cursor=incremental.Cursor("ts", last=since, end=until),
        key=["event_id"],
    )


@query
def incremental_backwards(spark: SparkSession, folder: str) -> DataFrame:
    """Events up to a mark that moves down, after an exclusive end."""
    mark = F.lit(EVENTS_UNTIL).cast("timestamp_ntz")
    end = F.lit(EVENTS_SINCE).cast("timestamp_ntz")
    return incremental.load_table(
        _events(spark, folder),
        columns=["ts", "value"],
        cursor=incremental.Cursor("ts", last=mark, end=end, newest=False),
        key=["event_id"],
    )


@query
def projection_limit(spark: SparkSession, folder: str) -> DataFrame:
    """The last five hundred events before a mark, newest first."""
    mark = F.lit(EVENTS_UNTIL).cast("timestamp_ntz")
    return incremental.load_table(
        _events(spark, folder),
        columns=["ts", "event_type"],
        limit=-500,
        cursor=incremental.Cursor("ts", last=mark, newest=False, row_order="desc"),
        key=["event_id"],
    )


@query
def incremental_two_loads(spark: SparkSession, folder: str) -> DataFrame:
    """Two loads with a stored mark; the second re-reads the boundary and lands it once."""
    events = _events(spark, folder)
    base = new_run_dir(spark, "incremental")
    target, state = f"{base}/events", f"{base}/state"
    until = F.lit(EVENTS_UNTIL).cast("timestamp_ntz")
    for end in (until, None):
        incremental.load_increment(events, "events", target, state, ["event_id"], "ts", end)
    return spark.read.parquet(target)


@query
def incremental_late_copies(spark: SparkSession, folder: str) -> DataFrame:
    """A second load delivers every key again, with a later time or with none."""
    events = _events(spark, folder)
    target = f"{new_run_dir(spark, 'late-copies')}/events"
    again = events.withColumn(
        "ts", F.expr("if(event_id % 2 = 0, ts + INTERVAL 30 DAYS, NULL)")
    )
    incremental.append_new(events.filter("event_id % 10 > 0"), target, ["event_id"], "ts")
    for _ in range(2):
        incremental.append_new(again, target, ["event_id"], "ts")
    return spark.read.parquet(target)


@query
def incremental_indexed(spark: SparkSession, folder: str) -> DataFrame:
    """Loads into a target with a key index: most events, three of the rest, then all of them later."""
    events = _events(spark, folder)
    target = f"{new_run_dir(spark, 'indexed')}/events"
    later = events.withColumn("ts", F.expr("ts + INTERVAL 30 DAYS"))
    few = events.filter("event_id IN (0, 10, 20)")
    for batch in (events.filter("event_id % 10 > 0"), few, later):
        incremental.append_new_indexed(batch, target, ["event_id"], "ts")
    return incremental.read_indexed(spark, target)


@query
def incremental_indexed_two_loads(spark: SparkSession, folder: str) -> DataFrame:
    """``incremental_two_loads`` into a target with a key index."""
    events = _events(spark, folder)
    base = new_run_dir(spark, "indexed-loads")
    target, state = f"{base}/events", f"{base}/state"
    for end in (F.lit(EVENTS_UNTIL).cast("timestamp_ntz"), None):
        incremental.load_increment(
            events, "events", target, state, ["event_id"], "ts", end,
            append=incremental.append_new_indexed,
        )
    return incremental.read_indexed(spark, target)


@query
def incremental_falling(spark: SparkSession, folder: str) -> DataFrame:
    """Three loads that work their way back; the rows they landed and the marks they stored."""
    events = _events(spark, folder)
    base = new_run_dir(spark, "falling")
    target, state = f"{base}/events", f"{base}/state"
    ends = [F.lit(x).cast("timestamp_ntz") for x in (EVENTS_UNTIL, EVENTS_SINCE)]
    marks = []
    for end in (*ends, None):
        marks.append(
            incremental.load_increment(
                events, "events", target, state, ["event_id"], "ts", end, newest=False
            )
        )
    # A row's load is the first whose mark does not lie above it.
    load = sum(F.when(F.col("ts") < F.lit(m), 1).otherwise(0) for m in marks) + 1
    return spark.read.parquet(target).select("event_id", "ts", load.cast("int").alias("load"))


@query
def load_dispositions(spark: SparkSession, folder: str) -> DataFrame:
    """Two loads of events, with options of the loader, in each way of writing."""
    events = _events(spark, folder)
    base = new_run_dir(spark, "loads")
    found = []
    for how in (*landing.DISPOSITIONS, landing.MERGE_INDEXED):
        for at_least in (0, 300):
            landing.load(
                events.filter(F.col("event_id") % 1000 >= at_least),
                f"{base}/{how}",
                how,
                where=[("event_type", "!=", "error")],
                columns=["user_id"],
                key=["event_id"],
            )
        landed = spark.read.parquet(f"{base}/{how}")
        found.append(
            landed.groupBy(F.lit(how).alias("disposition"), F.expr("event_id % 7").alias("part")).agg(
                F.count("*").alias("rows"), F.sum(F.expr("event_id + user_id")).alias("total")
            )
        )
    return reduce(DataFrame.unionAll, found)


@query
def filter_conflicts(spark: SparkSession, folder: str) -> DataFrame:
    """Which conditions of a user's own the cursor's leave room for, and what then passes (I-12)."""
    events = _events(spark, folder)
    mark, end = (F.lit(x).cast("timestamp_ntz") for x in (EVENTS_SINCE, EVENTS_UNTIL))
    cursors = {
        "none yet": incremental.Cursor("ts"),
        "rising": incremental.Cursor("ts", last=mark, end=end),
        "falling": incremental.Cursor("ts", last=end, newest=False),
    }
    found = []
    for name, cursor in cursors.items():
        for op in ("<", "<=", ">", ">=", "!="):
            said = F.lit(name).alias("cursor"), F.lit(op).alias("operator")
            try:
                rows = incremental.filtered(events, [("ts", op, end)], cursor)
                passed = rows.agg(F.count("*").alias("rows"))
            except ValueError:
                passed = spark.range(1).select(F.lit(None).cast("long").alias("rows"))
            found.append(passed.select(*said, F.col("rows").isNull().alias("conflict"), "rows"))
    return reduce(DataFrame.unionAll, found)


@query
def canonical_float_keys(spark: SparkSession, folder: str) -> DataFrame:
    """Keys with floating, null and NaN parts as text (F-23); separators made visible."""
    lines = GivenTables(spark, folder).given("lineitem").select(
        F.expr("if(l_orderkey % 11 = 0, double('NaN'), l_quantity)").alias("quantity"),
        F.expr("if(l_orderkey % 13 = 0, NULL, l_linenumber)").alias("line"),
        F.expr("CAST(l_suppkey AS FLOAT) + if(l_orderkey % 4 = 0, 0.5, 0)").alias("place"),
    )
    key = canonical_key(lines, ["quantity", "line", "place"])
    visible = F.replace(F.replace(key, F.lit(NULL_SENTINEL), F.lit("<null>")), F.lit(KEY_SEP), F.lit("|"))
    return lines.groupBy(visible.alias("key")).agg(F.count("*").alias("rows"))


@query
def dispositions(spark: SparkSession, folder: str) -> DataFrame:
    """Rows after two loads with each way of writing (I-13)."""
    regions = GivenTables(spark, folder).given("nation")
    base = new_run_dir(spark, "dispositions")
    rows = []
    for how in landing.DISPOSITIONS:
        for half in (0, 1):
            part = regions.filter(F.col("n_nationkey") % 2 >= half)
            landing.write(part, f"{base}/{how}", how, key=["n_nationkey"])
        rows.append((how, spark.read.parquet(f"{base}/{how}").count()))
    return spark.createDataFrame(rows, "disposition STRING, row_count BIGINT")


@query
def stream_dedup_events(spark: SparkSession, folder: str) -> DataFrame:
    """The events delivered twice as a stream, landed once."""
    events = _events(spark, folder)
    # A glob, since a file stream takes a folder or a glob but not the path of one file.
    path = f"{folder}/events.parque[t]"
    base = new_run_dir(spark, "stream")
    twice = file_stream(spark, path, events.schema).union(file_stream(spark, path, events.schema))
    target = f"{base}/events"
    land_stream(twice, target, f"{base}/checkpoint", ["event_id"], "ts").awaitTermination()
    return spark.read.parquet(target)


@query
def stream_state_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Two starts from one checkpoint; the second delivers all events again, with what is new.

    The keys are in the state store, so what has landed is not read.
    """
    events = _events(spark, folder)
    base = new_run_dir(spark, "stream-state")
    source, target = f"{base}/source", f"{base}/events"
    own = state_session(spark)
    for batch in (events.filter("event_id % 3 > 0"), events):
        batch.write.mode("append").parquet(source)
        stream = file_stream(own, source, events.schema)
        land_stream_keyed(stream, target, f"{base}/checkpoint", ["event_id"]).awaitTermination()
    return spark.read.parquet(target)


@query
def stream_within(spark: SparkSession, folder: str) -> DataFrame:
    """Keys remembered for ten days: two starts, copies in both, and rows that break the promise.

    The first start brings what happened before ``EVENTS_UNTIL``, but for each
    eleventh event. The second brings everything; of the held back events only those land that
    are no more than ten days older than the latest of the first start.
    """
    events = _events(spark, folder)
    base = new_run_dir(spark, "stream-within")
    source, target = f"{base}/source", f"{base}/events"
    own = state_session(spark)
    until = F.lit(EVENTS_UNTIL).cast("timestamp_ntz")
    first = events.filter(F.col("ts") < until).filter("event_id % 11 > 0")
    for batch in (first.unionAll(first), events):
        batch.write.mode("append").parquet(source)
        stream = file_stream(own, source, events.schema)
        land_stream_within(
            stream, target, f"{base}/checkpoint", ["event_id"], "ts", "10 days"
        ).awaitTermination()
    return spark.read.parquet(target)


@query
def refreshed_fact_sales(spark: SparkSession, folder: str) -> DataFrame:
    """A fact by month that lacked a batch of orders, brought up to date in their months only (I-14)."""
    m = layers(spark, folder, ids=True, limits=True)
    month = F.date_format("order_purchase_at", "yyyy-MM")
    fact = m.fact_orders.withColumn("order_month", month)
    batch = F.expr("order_id % 2 = 1 AND order_month IN ('1996-03', '1997-07')")
    zone = new_run_dir(spark, "warehouse")
    landing.materialise("fact_orders", fact.filter(~batch), "table", zone, partition_by="order_month")
    changed = m.stg_orders.withColumn("order_month", month).filter(batch)

    def of_months(touched: Column) -> DataFrame:
        """The fact over the items of these months' orders; other items are not shuffled again."""
        orders = m.stg_orders.withColumn("order_month", month).filter(touched)
        ids = written(orders.select("order_id"), "touched-orders")
        items = m.raw.items(ids=True, limits=True, orders=ids)
        return Layers(m.raw, items).fact_orders.withColumn("order_month", month)

    fact = landing.refresh("fact_orders", fact, zone, "order_month", changed, of_months)
    return rounded(
        core.header_rows(fact)
        .groupBy("order_month")
        .agg(
            F.count("*").alias("order_count"),
            F.sum(F.col("order_revenue").cast("decimal(18,2)")).cast("double").alias("revenue"),
        )
    )


@query
def materialised_fact_sales(spark: SparkSession, folder: str) -> DataFrame:
    """The fact as a table by order month, read back at order grain (I-14, P-6)."""
    m = layers(spark, folder, ids=True, limits=True)
    month = F.date_format("order_purchase_at", "yyyy-MM")
    fact = landing.materialise(
        "fact_orders",
        m.fact_orders.withColumn("order_month", month),
        "table",
        new_run_dir(spark, "warehouse"),
        partition_by="order_month",
    )
    return rounded(
        core.header_rows(fact)
        .groupBy("order_month")
        .agg(
            F.count("*").alias("order_count"),
            F.sum(F.col("order_revenue").cast("decimal(18,2)")).cast("double").alias("revenue"),
        )
    )
