"""CSV scan, normalisation, zones and the catalogue."""

from __future__ import annotations

from decimal import Decimal
from types import SimpleNamespace

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException

from samples import item, order, raw, ts

from freightlens.plans.layers import Layers
from freightlens.sources import landing
from freightlens.sources.catalog import time_columns
from freightlens.sources.csv_scan import scan_folder
from freightlens.sources.registry import REGISTRY


@pytest.fixture()
def csv_dir(tmp_path):
    (tmp_path / "x_sellers.csv").write_text(
        'seller_id,seller_zip_code_prefix,seller_city,seller_state,extra\na,01234,"sao ""x"" paulo",SP,\n'
    )
    (tmp_path / "x_order_reviews.csv").write_text(
        "review_id,order_id,review_score,review_comment_title,review_comment_message,"
        "review_creation_date,review_answer_timestamp\n"
        'r,o,5,,"two\nlines, quoted",2018-01-01 00:00:00,2018-01-02 03:04:05\n'
    )
    (tmp_path / "x_customers.csv").write_text("customer_state,customer_id\nSP,1\n")
    return str(tmp_path)


def test_scan_takes_present_files_and_declared_types(spark, csv_dir):
    found = scan_folder(spark, csv_dir, "x_{table}.csv")
    assert set(found) == {"sellers", "order_reviews", "customers"}
    seller = found["sellers"].first()
    assert seller["seller_zip_code_prefix"] == "01234"  # not a number
    assert seller["seller_city"] == 'sao "x" paulo' and seller["extra"] is None
    review = found["order_reviews"].first()
    assert review["review_comment_message"] == "two\nlines, quoted"
    assert (review["review_score"], review["review_answer_timestamp"].hour) == (5, 3)
    assert found["customers"].first().asDict() == {"customer_state": "SP", "customer_id": "1"}


def test_scan_fails_on_values_of_the_wrong_type(spark, tmp_path):
    (tmp_path / "order_payments.csv").write_text(
        "order_id,payment_sequential,payment_type,payment_installments,payment_value\na,one,x,1,2.5\n"
    )
    table = scan_folder(spark, str(tmp_path))["order_payments"]
    with pytest.raises((PySparkException, Py4JJavaError), match="FAILFAST|Malformed"):
        table.collect()


def test_scan_fails_on_files_with_other_columns(spark, tmp_path):
    """A second file with two columns exchanged must not land in the wrong ones."""
    folder = tmp_path / "sellers.csv"
    folder.mkdir()
    (folder / "a.csv").write_text("seller_id,seller_zip_code_prefix,seller_city,seller_state\na,1,x,SP\n")
    (folder / "b.csv").write_text("seller_id,seller_city,seller_zip_code_prefix,seller_state\nb,y,2,SP\n")
    with pytest.raises((PySparkException, Py4JJavaError), match="CSV header does not conform"):
        scan_folder(spark, str(tmp_path))["sellers"].collect()


def test_dispositions(spark, tmp_path):
    first = spark.createDataFrame([(1, "a"), (2, "b")], "id INT, v STRING")
    second = spark.createDataFrame([(2, "c"), (3, "d")], "id INT, v STRING")
    found = {}
    for how in landing.DISPOSITIONS:
        for df in (first, second):
            landing.write(df, str(tmp_path / how), how, key=["id"])
        found[how] = sorted(map(tuple, spark.read.parquet(str(tmp_path / how)).collect()))
    assert found == {
        "replace": [(2, "c"), (3, "d")],
        "append": [(1, "a"), (2, "b"), (2, "c"), (3, "d")],
        "merge": [(1, "a"), (2, "b"), (3, "d")],
    }
    with pytest.raises(ValueError):
        landing.write(first, str(tmp_path / "x"), "merge")
    with pytest.raises(ValueError):
        landing.write(first, str(tmp_path / "x"), "upsert")


def test_normalise(spark):
    df = spark.sql(
        """SELECT double('NaN') AS f, X'0aFF' AS b, 1.50BD AS d, named_struct('x', float('NaN')) AS s,
        array(double('NaN'), 1D) AS a, timestamp'2018-01-01 00:00:00' AS t, 7 AS i"""
    )
    row = landing.normalise(df).first()
    assert (row["f"], row["b"], row["d"], row["s"]["x"], row["a"]) == (None, "0aff", "1.50", None, [None, 1.0])
    assert row["t"].year == 2018 and row["i"] == 7
    assert dict(landing.normalise(df).dtypes)["t"] == "timestamp_ntz"
    assert Decimal(row["d"]) == Decimal("1.5")


def test_landing_replaces_and_counts(spark, tmp_path):
    zone, copied = str(tmp_path / "landing"), str(tmp_path / "raw")
    assert landing.land({"t": spark.range(5)}, zone) == {"t": 5}
    assert landing.land({"t": spark.range(3)}, zone) == {"t": 3}
    assert landing.copy_zone(spark, zone, copied, ["t"]) == {"t": 3}
    assert landing.read_zone(spark, copied, ["t"])["t"].count() == 3
    landing.land({"sellers": spark.range(2), "not_registered": spark.range(1)}, zone)
    assert landing.copy_zone(spark, zone, copied) == {"sellers": 2}
    assert set(landing.read_zone(spark, copied)) == {"sellers"}


def test_models_run_on_scanned_files(spark, tmp_path):
    """Ids are text in the files and numbers in the samples; the marts agree."""
    tables = raw(
        spark,
        orders=[order(1), order(2, delivered="01-20 00:00"), order(3, handed=None, delivered=None)],
        items=[item(1, 1), item(1, 2, seller=2), item(2)],
        reviews=[(1, 1, 4, ts("01-09 00:00"), ts("01-10 00:00"))],
        sellers=[(1, "01000", "SAO PAULO", "SP"), (2, "02000", "rio", "RJ")],
        geolocation=[("01000", -23.5, -46.6, "sao paulo", "SP")],
        translation=[("a", "toys")],
    )
    for name, df in vars(tables).items():
        df.write.option("header", True).csv(f"{tmp_path}/{name}.csv")
    scanned = Layers(SimpleNamespace(**scan_folder(spark, str(tmp_path))))
    built = Layers(tables)
    for mart in ("mart_delivery_kpis", "mart_pdt_delivery", "mart_satisfaction_by_delivery"):
        ours, theirs = getattr(scanned, mart), getattr(built, mart)
        assert ours.exceptAll(theirs).isEmpty() and theirs.exceptAll(ours).isEmpty()
    assert scanned.mart_transit_drivers().collect() == built.mart_transit_drivers().collect()
    assert scanned.distances.count() == built.distances.count() == 2
    assert scanned.mart_seller_perf.count() == 2


def test_materialise(spark, tmp_path):
    df = spark.range(10).selectExpr("id", "CAST(id % 2 AS STRING) AS month")
    table = landing.materialise("m", df, "table", str(tmp_path), partition_by="month")
    assert table.filter("month = '1'").count() == 5
    assert (tmp_path / "m" / "month=1").is_dir()
    assert spark.table("m").count() == 10
    landing.materialise("v", df.filter("id < 4"))
    assert spark.table("v").count() == 4
    with pytest.raises(ValueError):
        landing.materialise("w", df, "table")
    with pytest.raises(ValueError):
        landing.materialise("w", df, "cube")


def test_time_columns(spark):
    items = spark.createDataFrame([], REGISTRY["order_items"].schema)
    hidden = spark.sql("SELECT current_date() AS d")
    found = time_columns({"order_items": items, "_loads": hidden}).collect()
    assert [r["column_name"] for r in found if r["is_time_valued"]] == ["shipping_limit_date"]
    assert not any(r["is_delivery_event"] for r in found)
