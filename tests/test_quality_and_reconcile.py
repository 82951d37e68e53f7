"""Checks find what they should, and each mutation fails exactly its checks."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from freightlens.functions.keys import canonical_key, numbers_match
from freightlens.operators import quality
from freightlens.operators import reconcile as trees
from freightlens.operators.reconcile import key_differences, key_digest, reconcile, report


@pytest.fixture(scope="module")
def table(spark):
    rows = [(n, float(n), n * 1.5, f"s{n}" if n % 3 else None) for n in range(1, 41)]
    return spark.createDataFrame(rows, "id INT, k DOUBLE, amount DOUBLE, name STRING")


def failing(source, layer, **options):
    found = reconcile("t", source, {"copy": layer}, **{"keys": ["id"], "deep": True, **options})
    return {r["check"] for r in found.filter(~F.col("ok")).collect()}


def test_checks(spark):
    df = spark.createDataFrame(
        [(1, "a", 5), (1, "b", 700), (2, None, None), (None, "c", -1), (None, "a", 3)],
        "id INT, s STRING, x INT",
    )
    assert [r["id"] for r in quality.unique(df, "id").collect()] == [1]
    assert quality.not_null(df, "id").count() == 2
    assert quality.unique_combination(df, ["id", "s"]).count() == 0
    assert quality.unique_combination(df, ["id"]).count() == 2  # nulls are one combination
    parent = spark.createDataFrame([(1,)], "pid INT")
    orphans = quality.relationships(df, "id", parent, "pid").collect()
    assert [(r["id"], r["rows"]) for r in orphans] == [(2, 1)]
    assert quality.values_in_set(df, "s", ["a", "b"]).count() == 1
    assert quality.values_between(df, "x", 0, 500, "x IS NOT NULL").count() == 2
    pairs = spark.createDataFrame([(1, 1), (2, 1), (None, 1)], "a INT, b INT")
    assert quality.pair_greater(pairs, "a", "b").count() == 1
    assert quality.pair_greater(pairs, "a", "b", or_equal=True).count() == 0
    flags = spark.createDataFrame([(1, True), (1, True), (2, True), (3, False)], "order_id INT, is_order_header_row BOOLEAN")
    assert {r["order_id"] for r in quality.one_header_per_order(flags).collect()} == {1, 3}
    counts = quality.failures({"u": quality.unique(df, "id"), "n": quality.not_null(df, "id")})
    assert {r["check"]: r["failing_rows"] for r in counts.collect()} == {"u": 1, "n": 2}


def test_equal_tables_pass(table):
    assert failing(table, table.repartition(7)) == set()
    found = reconcile("t", table, {"copy": table}, ["id"], deep=True)
    assert {r["check"] for r in found.collect()} == {
        "row_count",
        "columns",
        "missing_values",
        "distinct_keys",
        "numeric_totals",
        "key_fingerprint",
    }


MUTATIONS = {
    "drop row": ("id != 7", None, {"row_count", "distinct_keys", "numeric_totals", "key_fingerprint"}),
    "null a cell": (None, {"name": "if(id = 7, NULL, name)"}, {"missing_values"}),
    "nan in a number": (
        None,
        {"amount": "if(id = 7, double('NaN'), amount)"},
        {"missing_values", "numeric_totals"},
    ),
    "change a number": (None, {"amount": "if(id = 7, amount + 1, amount)"}, {"numeric_totals"}),
    "tiny change": (None, {"amount": "if(id = 7, amount + 5e-7D, amount)"}, set()),
    "swap keys": (None, {"id": "CASE id WHEN 7 THEN 41 WHEN 40 THEN 6 ELSE id END"}, None),
    "other type of key": (None, {"id": "CAST(id AS DOUBLE)"}, set()),
    "text numbers": (None, {"amount": "CAST(amount AS STRING)"}, set()),
}


@pytest.mark.parametrize("name", MUTATIONS)
def test_each_mutation_fails_its_checks(table, name):
    where, changed, expected = MUTATIONS[name]
    copy = table.filter(where) if where else table
    for column, text in (changed or {}).items():
        copy = copy.withColumn(column, F.expr(text))
    found = failing(table, copy)
    if expected is None:
        assert "key_fingerprint" in found
    else:
        assert found == expected


def test_duplicated_row_keeps_the_key_set(table):
    twice = table.unionAll(table.filter("id = 7"))
    assert failing(table, twice) == {"row_count", "missing_values", "numeric_totals"} - {"missing_values"}
    # id 9 has a missing name
    assert "missing_values" in failing(table, table.unionAll(table.filter("id = 9")))


def test_absent_columns_and_layers(spark, table):
    assert failing(table, table.drop("amount")) == {"columns", "numeric_totals"}
    assert failing(table, table.withColumn("_id", F.lit(1))) == set()
    layers = {"gone": lambda: spark.read.parquet("/no/such/table"), "copy": table}
    found = reconcile("t", table, layers, ["id"])
    rows = {(r["layer"], r["check"]): r for r in found.collect()}
    assert not rows["gone", "reachable"]["ok"] and "/no/such/table" in rows["gone", "reachable"]["detail"]
    assert ("copy", "key_fingerprint") not in rows
    assert {r["layer"]: r["failures"] for r in report(found).collect()} == {"gone": 1, "copy": 0}


def test_detail_names_the_difference(table):
    found = reconcile("t", table, {"copy": table.filter("id < 40")}, ["id"])
    detail = {r["check"]: r["detail"] for r in found.collect()}
    assert detail["row_count"] == "source=40 copy=39"
    assert "amount: source=1230 copy=1170" in detail["numeric_totals"]


def test_canonical_keys(spark):
    df = spark.sql(
        """SELECT * FROM VALUES (1, 1D, 'a'), (1, double('NaN'), NULL), (NULL, 1.5D, 'None'),
        (NULL, NULL, 'a') AS t(i, d, s)"""
    )
    keys = [r[0] for r in df.select(canonical_key(df, ["i", "d", "s"])).collect()]
    null = "\x00NULL\x00"
    assert keys == [
        "1\x011\x01a",
        f"1\x01{null}\x01{null}",
        f"{null}\x011.5\x01None",
        f"{null}\x01{null}\x01a",
    ]
    nulls = spark.sql("SELECT * FROM VALUES (1, NULL), (1, 2) AS t(a, b)")
    assert key_digest(nulls, ["a", "b"]).first()["distinct_keys"] == 2


def test_key_differences(table):
    other = table.filter("id > 2").unionAll(table.limit(1).withColumn("id", F.lit(99)))
    found = {(r["key"], r["side"]) for r in key_differences(table, other, ["id"]).collect()}
    assert found == {("1", "source"), ("2", "source"), ("99", "layer")}


def test_tolerance(spark):
    df = spark.sql(
        """SELECT * FROM VALUES (1D, 1.0000005D), (1D, 1.000002D), (NULL, NULL), (1D, NULL),
        (1e12D, 1e12D + 500) AS t(a, b)"""
    )
    found = [r[0] for r in df.select(numbers_match(F.col("a"), F.col("b"))).collect()]
    assert found == [True, False, True, False, True]


def test_one_changed_key_in_a_million(spark, tmp_path):
    """It is found, and only the files of its buckets are read for it."""
    a = spark.range(1_000_000)
    b = a.withColumn("id", F.when(F.col("id") == 765_432, -5).otherwise(F.col("id")))
    for name, df in (("a", a), ("b", b)):
        trees.key_tree(df, ("id",), str(tmp_path / name))
    both = [trees.stored_key_tree(spark, str(tmp_path / name)) for name in "ab"]
    buckets = trees.differing_buckets(*both).collect()
    assert len(buckets) == 2 and sum(r.source_keys - r.layer_keys for r in buckets) == 0
    found = trees.tree_differences(*both)
    assert sorted(map(tuple, found.collect())) == [("-5", "layer"), ("765432", "source")]
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = found._jdf.queryExecution().explainString(mode)
    scans = [x for x in text.splitlines() if x.startswith("PartitionFilters")]
    assert len(scans) == 4 and all("coarse" in x and x.count(",") <= 3 for x in scans)
    assert len(list((tmp_path / "a" / "keys").glob("coarse=*"))) == 256
    assert trees.tree_differences(both[0], both[0]).isEmpty()


def test_trees_that_differ_everywhere_or_are_empty(spark, monkeypatch):
    a, b, none = (trees.key_tree(x, ("id",)) for x in (spark.range(300), spark.range(100, 500), spark.range(0)))
    want = [(str(i), "source") for i in range(100)] + [(str(i), "layer") for i in range(300, 500)]
    for few in (500, 3):
        monkeypatch.setattr(trees, "_FEW_BUCKETS", few)
        assert sorted(map(tuple, trees.tree_differences(a, b).collect())) == sorted(want)
    assert trees.tree_differences(none, none).isEmpty()
    assert trees.tree_differences(none, a).count() == 300
    # Repeated and null keys count once.
    c = spark.createDataFrame([(1,), (1,), (None,), (None,)], "id BIGINT")
    d = spark.createDataFrame([(1,), (2,)], "id BIGINT")
    got = sorted(map(tuple, key_differences(c, d, ("id",)).collect()))
    assert got == [("\x00NULL\x00", "source"), ("2", "layer")]
