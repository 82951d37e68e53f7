"""One order, seller, customer, product and zip code hold a third of everything.

The thresholds are lowered so that joins shuffle and AQE finds the skew on this
small data; results must still match the SQL.
"""

from __future__ import annotations

import pytest
from oracle_check import connect, difference
from oracles import ORACLES

from freightlens.registered import QUERIES

SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2KB",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    # Several scan tasks, since a split takes the output of some of them.
    "spark.sql.files.maxPartitionBytes": "32KB",
    "spark.sql.files.openCostInBytes": "0",
}
CHECKED = [
    "fact_orders",
    "order_transit_shape",
    "seller_customer_distance",
    "dim_geolocation",
    "mart_delivery_kpis",
    "mart_pdt_delivery",
    "mart_delay_pdt_vs_dist",
    "mart_seller_perf",
    "mart_seller_performance",
    "mart_delivery_revenue_risk",
    "mart_delivery_sunburst",
    "mart_transit_drivers",
    "dq_header_invariant",
    "dq_relationships",
    "reconcile_key_digest",
    "n6_deadline_spread",
    "n7_seller_states",
    "n8_controlled_transit",
    "n9_review_spread",
]
CHANGES = {
    "lineitem": """SELECT * REPLACE (
        if(rowid % 3 = 0, 6, l_orderkey) AS l_orderkey,
        if(rowid % 3 = 1, 3, l_suppkey) AS l_suppkey,
        if(rowid % 3 = 2, 4, l_partkey) AS l_partkey) FROM t""",
    "orders": "SELECT * REPLACE (if(rowid % 3 = 0, 7, o_custkey) AS o_custkey) FROM t",
    "customer": "SELECT * REPLACE (if(rowid % 3 = 0, 5, c_nationkey) AS c_nationkey) FROM t",
}


@pytest.fixture(scope="module")
def skewed(folder, tmp_path_factory):
    import duckdb

    target = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    from oracle_check import TABLES

    for name in TABLES:
        con.execute(f"CREATE OR REPLACE TABLE t AS SELECT * FROM '{folder}/{name}.parquet'")
        rows = CHANGES.get(name, "SELECT * FROM t")
        con.execute(f"COPY ({rows}) TO '{target}/{name}.parquet' (ROW_GROUP_SIZE 2048)")
    return str(target)


@pytest.fixture(scope="module")
def small_thresholds(spark):
    before = {k: spark.conf.get(k, None) for k in SMALL}
    for k, v in SMALL.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("name", CHECKED)
def test_results_under_skew(spark, skewed, small_thresholds, name):
    assert difference(QUERIES[name](spark, skewed), connect(skewed), ORACLES[name]) is None


@pytest.mark.parametrize("name", ["mart_seller_performance", "mart_delay_pdt_vs_dist", "fact_orders"])
def test_skewed_joins_are_split(spark, skewed, small_thresholds, name):
    df = QUERIES[name](spark, skewed)
    df.collect()
    assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
