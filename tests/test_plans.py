"""What the physical plans must and must not contain."""

from __future__ import annotations

import re
from pathlib import Path

import pytest

from freightlens.registered import QUERIES
from freightlens.session import fine_session
from freightlens.sources.given import GivenTables

MARTS = [name for name in QUERIES if name.startswith(("mart_", "fact_", "order_", "seller_", "n6", "n8"))]


def plan(spark, folder, name):
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return QUERIES[name](spark, folder)._jdf.queryExecution().explainString(mode)


@pytest.mark.parametrize("name", MARTS)
def test_no_cross_join_and_no_python(spark, folder, name):
    text = plan(spark, folder, name)
    for node in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "EvalPython", "MapInPandas"):
        assert node not in text


def test_windows_only_where_expected(spark, folder):
    """Order marts need no window; one is left after the aggregation of the shares."""
    for name in MARTS:
        windows = len(re.findall(r"\) Window\n", plan(spark, folder, name)))
        if name == "mart_transit_drivers":
            assert windows == 1
        elif name != "fact_orders":
            assert windows == 0, name


def test_scans_read_only_what_they_need(spark, folder):
    text = plan(spark, folder, "mart_delivery_kpis")
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", text)
    lines = [s for s in schemas if "l_orderkey" in s]
    assert lines and all(s.count(":") <= 3 for s in lines)
    assert "l_quantity" not in text


def test_unused_rollups_leave_the_plan(spark, folder):
    """Stages alone need neither items nor reviews."""
    assert "lineitem" not in plan(spark, folder, "mart_delivery_delay_stages")
    assert "lineitem" not in plan(spark, folder, "mart_satisfaction_by_delivery")


def test_filters_reach_the_scan(spark, folder):
    text = plan(spark, folder, "incremental_batch")
    pushed = re.search(r"PushedFilters: \[([^\]]*)\]", text).group(1)
    assert "GreaterThanOrEqual(ts" in pushed and "LessThan(ts" in pushed
    assert "props" not in re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)


def test_totals_are_computed_once(spark, folder):
    """The ranking of states and the result share one aggregation."""
    df = QUERIES["mart_delivery_sunburst"](spark, folder)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange [customer_state" in final


@pytest.mark.parametrize("name", ["stg_order_items", "fact_orders", "dq_header_invariant"])
def test_lines_are_numbered_once(spark, folder, name):
    """The given lines are read while they are numbered; later steps read the numbered ones."""
    text = plan(spark, folder, name)
    assert "lineitem.parquet" not in text
    assert len(re.findall(r"\) Scan parquet[^\n]*\n(?:[^\n]+\n)*?Location: [^\n]*numbered-", text)) <= 2


@pytest.mark.parametrize("name, most", [("seller_customer_distance", 17), ("mart_delay_pdt_vs_dist", 18)])
def test_distances_need_points_only(spark, folder, name, most):
    """Names of places are not looked up for a distance."""
    assert len(re.findall(r"\) Scan parquet", plan(spark, folder, name))) <= most


def test_tasks_of_the_models_stay_small(spark, folder):
    """Reduce tasks read less than Spark's default; a lower setting and the caller's session are kept."""
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    df = QUERIES["mart_seller_performance"](spark, folder)
    assert df.sparkSession.conf.get(name) == f"{16 << 20}b"
    assert spark.conf.get(name) == before
    number = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    assert df.sparkSession.conf.get(number) == spark.conf.get("spark.sql.shuffle.partitions")
    assert int(fine_session(spark, 8 << 30).conf.get(number)) == 4096
    read = GivenTables(spark, folder).file_bytes("orders", "lineitem")
    assert read == sum(Path(f"{folder}/{t}.parquet").stat().st_size for t in ("orders", "lineitem"))
    spark.conf.set(name, "2KB")
    try:
        assert fine_session(spark).conf.get(name) == "2048b"
    finally:
        spark.conf.set(name, before)


def test_empty_lines_do_not_make_the_items_shuffle_again(spark, folder):
    """Lines and empty lines lie by order already when the fact joins them to the orders."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = QUERIES["fact_orders"](spark, folder)
        text = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = text.splitlines()
    (at,) = [i for i, x in enumerate(lines) if x.endswith("- Union")]
    assert "Sort [order_id" in lines[at - 1]


def test_items_of_some_orders_keep_their_places(spark, folder):
    """What a refresh reads; null ids match nothing, repeated ones add no rows, and numbering runs once."""
    given = GivenTables(spark, folder)
    whole = given.items(ids=True, limits=True)
    some = spark.createDataFrame([(1,), (1,), (6,), (None,)], "order_id BIGINT")
    part = given.items(ids=True, limits=True, orders=some)
    want = whole.filter("order_id IN (1, 6)")
    assert part.count() > 0 and part.count() == want.count()
    assert part.exceptAll(want).isEmpty()
    numbered = [p for df in (whole, part) for p in df.inputFiles() if "numbered-" in p]
    assert len({p.rsplit("/", 2)[-2] for p in numbered}) == 1
