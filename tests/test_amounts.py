"""Fixed-point sums against exact arithmetic."""

from __future__ import annotations

import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from freightlens.functions.aggregates import (
    amount_sql,
    exact_sql,
    exact_sum,
    exact_sum_sql,
    measures,
    money_sum,
)
from freightlens.registered import QUERIES


def exact(spark, df, *names):
    return df.agg(*[F.expr(exact_sum_sql(n)).alias(n) for n in names])


def test_cents_add_up_to_the_nearest_double(spark):
    r = random.Random(1)
    cents = [r.randint(-(10**11), 10**11) for _ in range(4000)] + [1, -1, 99, 10**15 + 7, 10**13 + 1]
    rows = [(i % 7, c / 100, i % 3 == 0) for i, c in enumerate(cents)] + [(i, None, True) for i in range(9)]
    df = spark.createDataFrame(rows, "k INT, a DOUBLE, late BOOLEAN").repartition(5)
    got = df.groupBy("k").agg(*measures({"all": money_sum("a"), "some": money_sum("a", "late")}))
    for k, everything, some in got.collect():
        own = [(c, i % 3 == 0) for i, c in enumerate(cents) if i % 7 == k]
        if not own:
            assert everything is None and some is None
            continue
        assert everything == float(Fraction(sum(c for c, _ in own), 100))
        assert some == float(Fraction(sum(c for c, late in own if late), 100))


def test_two_steps_give_the_same_bits_as_one(spark):
    df = spark.range(20_000).selectExpr("id % 900 AS a", "id % 17 AS b", "(id * 7919 % 100003) / 1000D - 20 AS x")
    shares = df.groupBy("a", "b").agg(F.expr(exact_sum_sql(exact_sql("x"))).alias("x"))
    steps = shares.groupBy("b").agg(exact_sum("x").alias("x"))
    once = df.groupBy("b").agg(money_sum("x").alias("x"))
    want = {}
    for i in range(20_000):
        want[i % 17] = want.get(i % 17, 0) + Fraction(i * 7919 % 100003 - 20_000, 1000)
    assert dict(map(tuple, steps.collect())) == dict(map(tuple, once.collect()))
    assert {b: round(x, 6) for b, x in steps.collect()} == {b: round(float(x), 6) for b, x in want.items()}


def test_parts_are_carried_and_never_negative(spark):
    df = spark.createDataFrame([(-0.25,), (0.999999999,), (0.999999999,), (1e12 + 0.5,), (-3.0,)], "a DOUBLE")
    one = df.selectExpr(f"{exact_sql('a')} AS e").agg(F.expr(exact_sum_sql("e")).alias("e")).first().e
    total = 10**12 * 10**9 - 3 * 10**9 + 2 * 999_999_999 + 250_000_000
    assert one.units * 10**9 + one.parts == total and 0 <= one.parts < 10**9
    weighted = df.selectExpr(f"{exact_sql('a', '7L')} AS e").agg(F.expr(exact_sum_sql("e")).alias("e")).first().e
    assert weighted.units * 10**9 + weighted.parts == 7 * total
    # As many rows as would overflow one sum of billionths.
    big = spark.range(1).selectExpr(f"named_struct('units', 1L, 'parts', {9 * 10**18}L) AS e")
    three = big.unionAll(big).unionAll(big).agg(F.expr(exact_sum_sql("e")).alias("e")).first().e
    assert three.units == 3 + 27 * 10**9 and three.parts == 0


def test_odd_amounts(spark):
    df = spark.createDataFrame([(float("nan"),), (None,), (2.5,)], "a DOUBLE")
    assert df.agg(money_sum("a").alias("x")).first().x == 2.5
    assert df.filter("a IS NULL").agg(money_sum("a").alias("x")).first().x is None
    assert spark.range(4).agg(money_sum("id").alias("x")).first().x == 6.0
    assert df.selectExpr(f"{amount_sql(exact_sql('a'))} AS x").filter("x IS NOT NULL").count() == 1


@pytest.mark.parametrize("name", ["mart_monthly_sales", "mart_seller_perf", "order_transit_shape", "mart_pdt_delivery"])
def test_no_decimal_is_added_up(spark, folder, name):
    df = QUERIES[name](spark, folder)
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)
    assert "partial_sum" in text and "decimal" not in text.lower()
