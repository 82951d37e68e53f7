"""Row numbers of hot keys against a plain window."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from freightlens.operators import numbering
from freightlens.operators.numbering import number_rows


def _skewed(spark):
    """A third of the rows in one key, one of its rows copied many times, and null keys."""
    plain = spark.range(6000).selectExpr(
        "if(id % 700 = 9, NULL, id % 700) AS k",
        "CAST(id * 7919 % 1009 AS INT) AS a",
        "CAST(id AS INT) AS b",
    )
    hot = spark.range(3000).selectExpr(
        "-1L AS k", "CAST(id * 31 % 997 AS INT) AS a", "CAST(id AS INT) AS b"
    )
    copies = spark.range(1500).selectExpr("-1L AS k", "500 AS a", "-7 AS b")
    return plain.unionAll(hot).unionAll(copies)


def test_keys_are_numbered_as_by_a_window(spark):
    df = _skewed(spark)
    expected = df.withColumn(
        "n", F.row_number().over(Window.partitionBy("k").orderBy("a", "b"))
    )
    found = number_rows(df, "k", ["a", "b"], "n")
    assert found.exceptAll(expected).isEmpty()
    assert expected.exceptAll(found).isEmpty()


def test_thousands_of_hot_keys(spark):
    """No bound on their number, and none is treated apart."""
    df = spark.range(60_000).selectExpr("id % 3000 AS k", "CAST(id AS INT) AS a")
    found = number_rows(df, "k", ["a"], "n").groupBy("k").agg(F.max("n"), F.countDistinct("n"))
    assert {tuple(r)[1:] for r in found.collect()} == {(20, 20)}


def test_a_hot_key_is_spread_even_if_its_rows_are_equal(spark, monkeypatch):
    kept = {}

    def written(df, purpose):
        kept[purpose] = numbering_written(df, purpose)
        return kept[purpose]

    numbering_written = numbering.written
    monkeypatch.setattr(numbering, "written", written)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(0, 4000, 1, 6).selectExpr("1 AS k", "2 AS a")
        found = number_rows(df, "k", ["a"], "n")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    assert [r["n"] for r in found.orderBy("n").collect()] == list(range(1, 4001))
    sizes = [r["count"] for r in kept["numbered"].groupBy("_range").count().collect()]
    assert len(sizes) >= 6 and max(sizes) < 2000


def test_one_shuffle_and_one_write(spark, monkeypatch):
    """The numbered rows are read from what was written; only the ranges' edges move again."""
    seen = []
    plain = numbering.written
    monkeypatch.setattr(numbering, "written", lambda df, purpose: seen.append(df) or plain(df, purpose))
    found = number_rows(_skewed(spark), "k", ["a", "b"], "n")
    before, borders = seen
    assert borders.count() <= spark.sparkContext.defaultParallelism * 2 + 8
    text = before._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    )
    assert text.count("Exchange rangepartitioning") == 1 and "Exchange hash" not in text
    text = found._jdf.queryExecution().explainString(
        spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    )
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_long_keys_end_and_begin_at_borders_of_ranges(spark):
    """Runs of keys that fill several ranges, next to keys of one row, text and null keys."""
    rows = [(f"k{i:04}", i) for i in range(50)] + [("k0007", i) for i in range(900)]
    rows += [(None, i) for i in range(700)] + [("k0008", i) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, a int").repartition(5)
    found = number_rows(df, "k", ["a"], "n")
    want = df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("a")))
    assert found.groupBy("k", "n").count().filter("count > 1").isEmpty()
    assert found.select("k", "n").exceptAll(want.select("k", "n")).isEmpty()
    assert found.count() == want.count()


def test_no_rows(spark):
    assert number_rows(_skewed(spark).limit(0), "k", ["a"], "n").isEmpty()
