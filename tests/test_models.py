"""Edge cases of the models on hand-made rows."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F
from samples import item, order, product, raw, ts

from freightlens.functions.geo import great_circle_metres
from freightlens.operators import quality
from freightlens.plans import core, staging
from freightlens.plans.explore import review_spread
from freightlens.plans.layers import Layers


def by(df, *key):
    return {tuple(r[k] for k in key) if len(key) > 1 else r[key[0]]: r for r in df.collect()}


STATUS_CASES = [
    ("01-09 00:00", "01-10 00:00", "early", -1.0),
    ("01-09 00:01", "01-10 00:00", "on_time", -23 / 24),
    ("01-10 00:00", "01-10 00:00", "on_time", 0.0),
    ("01-10 02:00", "01-10 00:00", "late_1_3_days", 2 / 24),
    ("01-13 23:59", "01-10 00:00", "late_1_3_days", 95 / 24),
    ("01-14 00:00", "01-10 00:00", "late_4_7_days", 4.0),
    ("01-17 23:59", "01-10 00:00", "late_4_7_days", 191 / 24),
    ("01-18 00:00", "01-10 00:00", "late_8_plus_days", 8.0),
    (None, "01-10 00:00", "not_delivered", None),
    ("01-10 00:00", None, "late_8_plus_days", None),
]


def test_delivery_status_limits(spark):
    tables = raw(
        spark, orders=[order(n, delivered=d, due=e) for n, (d, e, _, _) in enumerate(STATUS_CASES)]
    )
    found = by(Layers(tables).stages, "order_id")
    for n, (_, _, status, delay) in enumerate(STATUS_CASES):
        assert found[n]["delivery_status"] == status
        assert found[n]["delivery_delay_days"] == delay


def test_hours_do_not_depend_on_the_session_time_zone(spark):
    # Clocks changed in New York between these two times.
    tables = raw(spark, orders=[order(1, bought="03-10 12:00", delivered="03-11 12:00")])
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert Layers(tables).stages.first()["total_delivery_days"] == 1.0
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_fact_grain_header_and_rollups(spark):
    tables = raw(
        spark,
        orders=[order(1), order(2), order(3)],
        items=[
            item(1, 2, seller=2, price=20.0),
            item(1, 1, seller=1, price=10.0),
            item(1, 3, seller=1, price=0.1),
            item(3, 1),
            item(99, 1),  # no such order
        ],
        reviews=[(1, 1, 5, None, None), (2, 1, 2, None, None)],
        sellers=[(1, "1", "a", "SP"), (2, "2", "b", "RJ")],
    )
    fact = Layers(tables).fact_orders
    found = by(fact, "order_id", "order_item_id")
    assert set(found) == {(1, 1), (1, 2), (1, 3), (2, None), (3, 1)}
    assert {k for k, r in found.items() if r["is_order_header_row"]} == {(1, 1), (2, None), (3, 1)}
    for n in (1, 2, 3):
        r = found[1, n]
        assert (r["item_count"], r["distinct_seller_count"]) == (3, 2)
        assert (r["order_revenue"], r["order_freight"]) == (30.1, 3.0)
        assert (r["avg_review_score"], r["review_count"]) == (3.5, 2)
    empty = found[2, None]
    assert (empty["item_count"], empty["distinct_seller_count"], empty["order_revenue"]) == (0, 0, 0.0)
    assert empty["seller_id"] is None and empty["review_count"] is None
    assert quality.one_header_per_order(fact).count() == 0
    assert core.header_rows(fact).count() == 3


def test_shape_rules(spark):
    sellers = [(1, "1", "SAO PAULO", "SP"), (2, "2", "campinas", "SP"), (3, "3", "sao paulo", "RJ")]
    customers = [(1, 1, "1", "sao paulo", "SP"), (2, 2, "1", "x", None)]
    tables = raw(
        spark,
        orders=[
            order(1),
            order(2, handed="01-06 01:00"),  # five days exactly
            order(3, handed="01-06 02:00"),  # five days and an hour, past the limit
            order(4, handed="01-06 02:00"),  # slow, but no limit is known
            order(5),
            order(6, approved=None, handed=None, delivered=None),
            order(7, approved=None),
            order(8, handed=None, delivered=None),
            order(9),
            order(10),
            order(11, customer=2),
            order(12),
        ],
        items=[
            item(1),
            item(2, limit="01-02 00:00"),
            item(3, limit="01-02 00:00"),
            item(4, limit=None),
            item(5, 1, seller=2, price=5.0),
            item(5, 2, seller=1, price=5.0),  # equal revenue: the lower id counts
            item(6),
            item(7),
            item(8),
            item(9, seller=3),
            item(10, seller=2),
            item(11),
        ],
        sellers=sellers,
        customers=customers,
    )
    found = by(Layers(tables).shapes(), "order_id")
    shape = {n: r["order_shape"] for n, r in found.items()}
    assert shape[1] == shape[2] == shape[4] == "single_seller_normal_handoff"
    assert shape[3] == "single_seller_slow_handoff"
    assert shape[5] == "multi_seller"
    reasons = {n: r["unclassified_reason"] for n, r in found.items() if r["unclassified_reason"]}
    assert reasons == {
        6: "never_approved_or_shipped",
        7: "approval_timestamp_missing",
        8: "never_handed_to_carrier",
        12: "no_items_on_order",
    }
    band = {n: r["distance_band"] for n, r in found.items()}
    assert band[1] == band[5] == "1. same_city"
    assert band[9] == "3. cross_state"
    assert band[10] == "2. same_state"
    assert band[11] == band[12] == "4. unknown"
    strict = by(Layers(tables).shapes(slow_handoff_days=4), "order_id")
    assert strict[2]["order_shape"] == "single_seller_slow_handoff"


def test_centroid_ignores_repeated_points(spark):
    points = [("1", -23.5, -46.6, "a", "SP")] * 2 + [("1", -23.9, -46.8, "b", "SP")]
    geo = Layers(raw(spark, geolocation=points)).dim_geolocation.first()
    assert (geo["city"], geo["state"]) == ("a", "SP")
    assert geo["centroid_lng"] == pytest.approx(-46.6998, abs=1e-4)
    assert geo["centroid_lat"] == pytest.approx(-23.7000, abs=1e-4)


def test_mode_ties_are_decided_by_name(spark):
    points = [("1", 0.0, 0.0, "b", "SP"), ("1", 0.0, 0.0, "a", "RJ")]
    assert Layers(raw(spark, geolocation=points)).dim_geolocation.first()["city"] == "a"


def test_distance(spark):
    tables = raw(
        spark,
        orders=[order(1), order(2)],
        items=[item(1), item(1, 2), item(2, seller=2)],
        customers=[(1, 1, "C", "x", "RJ")],
        sellers=[(1, "S", "y", "SP"), (2, "unknown", "y", "SP")],
        geolocation=[("S", -23.5, -46.6, "y", "SP"), ("C", -22.9, -43.2, "x", "RJ")],
    )
    rows = Layers(tables).distances.collect()
    assert [(r["order_id"], r["seller_id"]) for r in rows] == [(1, 1)]
    assert rows[0]["distance_meters"] == pytest.approx(353_827.943, abs=0.01)


def test_size_and_zone_classes(spark):
    from freightlens.plans.marts import size_class_sql, zone_sql

    sizes = spark.createDataFrame(
        [(30_001, 80), (100, 301), (5_000, 80), (5_001, 80), (100, 121), (30_000, 10), (100, 300)],
        "product_weight_g INT, product_dimension INT",
    )
    assert [r[0] for r in sizes.selectExpr(size_class_sql()).collect()] == [
        "S",
        "Too Large or Too Heavy for Delivery",
        "S",
        "M",
        "L",
        "XL",
        "XL",
    ]
    distances = spark.createDataFrame(
        [(100_000.0,), (100_000.1,), (500_000.0,), (1_500_000.0,), (1_500_001.0,)],
        "distance_meters DOUBLE",
    )
    assert [r[0][-1] for r in distances.selectExpr(zone_sql()).collect()] == list("12234")[:1] + [
        "2",
        "2",
        "3",
        "4",
    ]


def test_category_fallbacks(spark):
    tables = raw(
        spark,
        products=[product(1), product(2, "brinquedos"), product(3, "novo"), product(4, "outro")],
        translation=[("brinquedos", "toys"), ("novo", "new_thing")],
    )
    found = by(Layers(tables).stg_products, "product_id")
    names = {
        n: (r["product_category_name_english"], r["product_category_buckets"])
        for n, r in found.items()
    }
    assert names == {
        1: ("uncategorized", "Uncategorized"),
        2: ("toys", "Books, Media & Hobbies"),
        3: ("new_thing", "Uncategorized"),
        4: ("uncategorized", "Uncategorized"),
    }
    assert len(staging.BUCKET_OF) == sum(map(len, staging.CATEGORY_BUCKETS.values()))


def test_fan_out_is_counted_without_making_pairs(spark):
    """The literal join of items and fact rows on order_id, against the weights."""
    tables = raw(
        spark,
        orders=[order(1), order(2, delivered="01-20 00:00")],
        items=[item(1, n) for n in (1, 2, 3)] + [item(2, n) for n in (1, 2)],
        customers=[(1, 1, "C", "x", "RJ")],
        sellers=[(1, "S", "y", "SP")],
        geolocation=[("S", -23.5, -46.6, "y", "SP"), ("C", -22.9, -43.2, "x", "RJ")],
    )
    m = Layers(tables)
    row = m.mart_delay_pdt_vs_dist().first()
    pairs = m.stg_order_items.alias("i").join(m.fact_orders.select("order_id", "delivery_status"), "order_id")
    late = pairs.filter(F.col("delivery_status").startswith("late")).count()
    assert (row["distance_bucket"], row["size_bucket"]) == ("Zone 2", "S")
    assert row["order_item_count"] == pairs.count() == 13
    assert row["late_pct"] == late / 13
    assert m.mart_delay_pdt_vs_dist("item").first()["order_item_count"] == 5
    with pytest.raises(ValueError):
        m.mart_delay_pdt_vs_dist("order")


def test_revenue_weights(spark):
    tables = raw(
        spark,
        orders=[order(1), order(2), order(3, delivered="01-20 00:00")],
        items=[item(1, 1, price=1.0), item(1, 2, price=2.0), item(3, 1, price=4.0)],
    )
    m = Layers(tables)
    wide = m.mart_delivery_revenue_risk().first()
    assert (wide["total_orders"], wide["total_revenue"], wide["late_orders"]) == (4, 10.0, 1)
    narrow = m.mart_delivery_revenue_risk(order_grain=True).first()
    assert (narrow["total_orders"], narrow["total_revenue"], narrow["late_revenue"]) == (3, 7.0, 4.0)
    assert narrow["late_revenue_pct"] == 4 / 7


def test_sunburst_leaves_a_place_to_the_unknown_state(spark):
    customers = [(n, n, "1", "c", f"S{n:02}") for n in range(1, 12)] + [(12, 12, "1", "c", None)]
    tables = raw(
        spark,
        orders=[order(n, customer=n) for n in range(1, 13)],
        items=[item(n, price=float(n)) for n in range(1, 13)],
        customers=customers,
    )
    states = {r["customer_state"] for r in Layers(tables).mart_delivery_sunburst().collect()}
    assert states == {f"S{n:02}" for n in range(3, 12)}


def test_shares_without_denominator_are_null(spark):
    tables = raw(spark, orders=[order(1, handed=None, delivered=None)], items=[item(1)])
    m = Layers(tables)
    assert m.mart_transit_drivers().first()["late_pct"] is None
    performance = m.mart_seller_performance.first()
    assert performance["late_shipping_pct"] is None and performance["late_delivery_pct"] == 0.0
    assert performance["delivered_order_count"] == 1  # undelivered orders count as known
    stages = m.mart_delivery_delay_stages.collect()
    assert [r["total_days"] for r in stages] == [None] * 3


def test_properties_on_given_tables(spark, folder):
    from freightlens.registered import layers

    m = layers(spark, folder, ids=True, limits=True)
    orders, items = m.stg_orders.count(), m.stg_order_items.count()
    fact = m.fact_orders.cache()
    assert fact.filter("is_order_header_row").count() == orders
    assert fact.filter("order_item_id IS NOT NULL").count() == items
    kpis = m.mart_delivery_kpis.agg(F.sum("order_count")).first()[0]
    assert kpis == orders
    drivers = m.mart_transit_drivers().collect()
    assert math.isclose(sum(r["pct_of_orders"] for r in drivers), 1.0)
    assert sum(r["order_count"] for r in drivers) == orders
    stages = m.mart_delivery_delay_stages.collect()
    assert math.isclose(sum(r["pct_of_delay"] for r in stages), 1.0)
    assert m.mart_seller_perf.agg(F.sum("seller_item_count")).first()[0] == items
    fact.unpersist()


def test_dim_date_fixed_span(spark):
    days = core.dim_date(core.fixed_span(spark))
    assert days.count() == 1096
    first = days.orderBy("date_key").first()
    assert (first["year_month"], first["month_name"], first["day_of_week"]) == ("2016-01", "January", 6)
    assert first["is_weekend"] is False
    assert ts("01-01 00:00").year == 2018


def test_unknown_points_have_no_distance(spark):
    """Neither as a null coordinate in the formula nor as a zip code without a point."""
    point = spark.createDataFrame([(0.0, 0.0, None, 1.0), (0.0, 0.0, 180.0, 0.0)], "a DOUBLE, b DOUBLE, c DOUBLE, d DOUBLE")
    found = point.select(great_circle_metres("a", "b", "c", "d").alias("m")).collect()
    assert found[0]["m"] is None
    assert found[1]["m"] == pytest.approx(math.pi * 6_371_010)
    tables = raw(
        spark,
        orders=[order(1)],
        items=[item(1)],
        customers=[(1, 1, "C", "x", "RJ")],
        sellers=[(1, "S", "y", "SP")],
        geolocation=[("S", None, -46.6, "y", "SP"), ("C", -22.9, -43.2, "x", "RJ")],
    )
    m = Layers(tables)
    assert m.distances.isEmpty() and m.mart_delay_pdt_vs_dist().isEmpty()
    assert m.dim_geolocation.filter("zip_code_prefix = 'S' AND centroid_lat IS NULL").count() == 1


@pytest.mark.parametrize("ids", [(1, 1, 2), (None, 1, 2), (None, None), (2, 2)])
def test_one_header_row_whatever_the_item_ids(spark, ids):
    """A repeated id gives one header, and a null id comes before all others."""
    tables = raw(spark, orders=[order(1)], items=[item(1, i, price=5.0) for i in ids])
    fact = Layers(tables).fact_orders
    assert fact.count() == len(ids)
    (header,) = core.header_rows(fact).collect()
    assert header["order_item_id"] == (None if None in ids else min(ids))
    assert header["order_revenue"] == 5.0 * len(ids)
    assert quality.one_header_per_order(fact).isEmpty()


def test_amounts_keep_their_digits(spark):
    tables = raw(spark, orders=[order(1)], items=[item(1, price=1.005, freight=1.005), item(1, 2, price=0.00000001, freight=0.001)])
    row = Layers(tables).fact_orders.first()
    assert (row["order_revenue"], row["order_freight"]) == (1.00500001, 1.006)


def test_totals_beyond_whole_cents_of_a_double(spark):
    """More than 2^53 cents per order, and more than a bigint of cents in all."""
    many = [item(n, price=99_999_999_999_999.5) for n in range(1, 1201)]
    tables = raw(spark, orders=[order(n) for n in range(1, 1201)], items=many)
    m = Layers(tables)
    assert m.fact_orders.first()["order_revenue"] == 99_999_999_999_999.5
    assert m.mart_monthly_sales.first()["total_revenue"] == 1200 * 99_999_999_999_999.5
    assert m.mart_delivery_revenue_risk().first()["total_revenue"] == 1200 * 99_999_999_999_999.5


def test_reviews_count_without_dates(spark):
    tables = raw(
        spark,
        orders=[order(1)],
        items=[item(1)],
        reviews=[(1, 1, 5, None, None), (2, 1, 2, None, None)],
    )
    m = Layers(tables)
    found = review_spread(m.stg_order_items, m.stg_order_reviews).first()
    assert found["pct_orders_with_multiple_reviews"] == 100.0
    assert found["median_spread_when_multiple"] is None
