"""Quantiles, mergeable distinct counts, footers, refreshed partitions and stored distances."""

from __future__ import annotations

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from freightlens.operators.distinct import (
    dense_ids,
    distinct_cells,
    distinct_counts,
    with_dense_ids,
)
from freightlens.operators.quantiles import exact_quantiles
from freightlens.registered import layers
from freightlens.sources import landing
from freightlens.sources.catalog import (
    footer_aggregate,
    footer_fields,
    footer_profile,
    footer_session,
)


def plan(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def brute(values, shares):
    own = sorted(values)
    ranks = {s: max(1, math.ceil(Fraction(str(s)) * len(own))) for s in shares}
    return {(s, own[r - 1], len(own)) for s, r in ranks.items()}


@pytest.mark.parametrize("steps, few", [(4, 3), (4096, 50)])
def test_quantiles_of_any_domain(spark, steps, few):
    """Groups of 1 to 900 values, one value with most rows, huge spans, nulls and NaN, a null group."""
    r = random.Random(2)
    groups = {
        "wide": [r.uniform(-1, 1) * 10 ** r.randint(-8, 12) for _ in range(900)],
        "hot": [5.0] * 700 + [r.random() for _ in range(200)],
        "one": [3.25], "equal": [-2.0] * 40, None: [float(i) for i in range(60)],
        "near": [1.0 + i * 2**-52 for i in range(90)],
    }
    rows = [(k, v) for k, own in groups.items() for v in own]
    rows += [("wide", None), ("hot", float("nan")), ("nothing", None)]
    shares = [0.0, 0.1, 0.5, 0.9, 0.999, 1.0]
    df = spark.createDataFrame(rows, "k STRING, v DOUBLE").repartition(3)
    got = exact_quantiles(df, "v", shares, ["k"], steps=steps, few=few).collect()
    for k, own in groups.items():
        assert {tuple(x)[1:] for x in got if x.k == k} == brute(own, shares), k
    assert len(got) == len(groups) * len(shares)


def test_no_task_holds_the_values(spark, folder):
    df = spark.read.parquet(f"{folder}/lineitem.parquet")
    found = exact_quantiles(df, "l_extendedprice", [0.5], few=20)
    text = plan(found)
    assert "percentile" not in text and "collect" not in text.lower()
    values = [x[0] for x in df.select("l_extendedprice").collect()]
    assert {tuple(x) for x in found.collect()} == brute(values, [0.5])
    assert exact_quantiles(df.limit(0), "l_extendedprice", [0.5]).isEmpty()


def test_counts_roll_up_without_the_facts(spark):
    r = random.Random(3)
    rows = [(r.randint(1, 12), r.choice("ab"), r.choice([None, *range(-3, 70_000, 997)]), r.random() < 0.3) for _ in range(3000)]
    df = spark.createDataFrame(rows, "month INT, state STRING, id BIGINT, late BOOLEAN")
    cells = distinct_cells(df, "id", ["month", "state"], {"all": "true", "late": "late"})
    half = F.when(F.col("month") > 6, 2).otherwise(1)
    for got, of in (
        (distinct_counts(cells, ["month", "state"]), lambda x: x[:2]),
        (distinct_counts(cells, ["half"], {"half": half}), lambda x: (1 + (x[0] > 6),)),
        (distinct_counts(cells, []), lambda x: ()),
    ):
        want = {}
        for x in rows:
            if x[2] is not None:
                everyone, late = want.setdefault(of(x), (set(), set()))
                everyone.add(x[2])
                if x[3]:
                    late.add(x[2])
        assert {tuple(x)[:-2]: tuple(x)[-2:] for x in got.collect()} == {
            k: (len(a), len(b)) for k, (a, b) in want.items()
        }


def test_dense_numbers_of_any_key(spark):
    rows = [(f"k{i % 40}", i % 3 or None) for i in range(500)] + [(None, None)] * 5
    df = spark.createDataFrame(rows, "a STRING, b INT")
    ids = dense_ids(df, ["a", "b"])
    assert sorted(x.dense_id for x in ids.collect()) == list(range(1, len(set(rows)) + 1))
    numbered = with_dense_ids(df, ids, ["a", "b"])
    assert numbered.columns == ["a", "b", "dense_id"] and numbered.count() == len(rows)
    cells = distinct_cells(numbered, "dense_id", ["b"])
    got = {x.b: x.ids for x in distinct_counts(cells, ["b"]).collect()}
    assert got == {b: len({x for x in rows if x[1] == b}) for b in (None, 1, 2)}


def test_footers_answer_without_reading(spark, folder, tmp_path):
    table = footer_session(spark).read.parquet(f"{folder}/orders.parquet")
    names = ["o_orderkey", "o_totalprice", "o_orderstatus"]
    text = plan(footer_aggregate(table, footer_fields(table, names)))
    found = footer_profile(spark, f"{folder}/orders.parquet", names)
    assert "PushedAggregation: [COUNT(*), COUNT(o_orderkey)" in text and "MAX(o_totalprice)" in text
    n = spark.read.parquet(f"{folder}/orders.parquet").count()
    assert [(x.column, x.rows, x.present) for x in found.collect()] == [("o_orderkey", n, n), ("o_totalprice", n, n)]
    rows = spark.createDataFrame([(None, 1, "2020-01-02"), (None, None, "2020-01-01")], "a DOUBLE, b INT, c STRING")
    rows.selectExpr("a", "b", "CAST(c AS DATE) AS d").write.parquet(str(tmp_path / "t"))
    got = {tuple(x) for x in footer_profile(spark, str(tmp_path / "t")).collect()}
    assert got == {("a", 2, 0, None, None), ("b", 2, 1, 1.0, 1.0), ("d", 2, 2, 18262.0, 18263.0)}
    assert spark.conf.get("spark.sql.parquet.aggregatePushdown") == "false"


def test_only_touched_partitions_are_rewritten(spark, tmp_path):
    df = spark.range(60).selectExpr("id", "concat('m', id % 5) AS m").unionAll(
        spark.createDataFrame([(100, None), (101, "x=y/z")], "id LONG, m STRING")
    )
    landing.materialise("t_months", df, "table", str(tmp_path), partition_by="m")

    def files():
        return {p: p.stat().st_mtime_ns for p in (tmp_path / "t_months").glob("*/*.parquet")}

    before = files()
    # m1 changes, m2 and the odd names lose all their rows, m9 is new.
    after = df.filter("coalesce(m, 'x=y/z') NOT IN ('m2', 'x=y/z')").withColumn(
        "id", F.when(F.col("m") == "m1", F.col("id") + 1000).otherwise(F.col("id"))
    ).unionAll(spark.createDataFrame([(7000, "m9")], "id LONG, m STRING"))
    changed = spark.createDataFrame([("m1",), ("m2",), ("m9",), (None,), ("x=y/z",)], "m STRING")
    found = landing.refresh("t_months", after, str(tmp_path), "m", changed)
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, after.collect()))
    now = files()
    for path, written_at in before.items():
        untouched = path.parent.name in ("m=m0", "m=m3", "m=m4")
        assert (now.get(path) == written_at) == untouched
    assert not landing.refresh("t_months", after, str(tmp_path), "m", changed.limit(0)).isEmpty()
    assert files() == now


def test_one_haversine_for_each_pair_of_places(spark, folder):
    m = layers(spark, folder)
    places = m.place_distances
    assert places.groupBy("seller_zip_code_prefix", "customer_zip_code_prefix").count().filter("count > 1").isEmpty()
    from freightlens.plans.intermediate import with_known_distance

    found = with_known_distance(
        m.stg_order_items.select("order_id", "seller_id"), m.stg_orders, m.dim_seller, m.dim_customer, places
    )
    assert "asin" not in plan(found).lower()
    far = m.distances.agg(F.max("distance_meters")).first()[0]
    assert found.agg(F.max("distance_meters")).first()[0] == pytest.approx(far)
