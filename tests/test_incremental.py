"""Loading options, marks and the stream."""

from __future__ import annotations

import warnings
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from freightlens.sources.incremental import (
    Cursor,
    append_new,
    append_new_indexed,
    filtered,
    limited,
    load_increment,
    load_table,
    new_to_indexed,
    projected,
    read_indexed,
    read_mark,
)
from freightlens.sources.landing import load
from freightlens.streaming.landing_stream import (
    file_stream,
    land_stream,
    land_stream_keyed,
    land_stream_within,
    state_session,
)


@pytest.fixture()
def rows(spark):
    return spark.createDataFrame([(n, n // 2, f"v{n}") for n in range(10)], "id INT, t INT, v STRING")


def ids(df):
    return [r["id"] for r in df.orderBy("id").collect()]


def test_cursor_bounds(rows):
    assert ids(filtered(rows, cursor=Cursor("t"))) == list(range(10))
    assert ids(filtered(rows, cursor=Cursor("t", last=3))) == [6, 7, 8, 9]
    assert ids(filtered(rows, cursor=Cursor("t", last=1, end=3))) == [2, 3, 4, 5]
    assert ids(filtered(rows, cursor=Cursor("t", last=1, newest=False))) == [0, 1, 2, 3]
    assert ids(filtered(rows, cursor=Cursor("t", last=3, end=1, newest=False))) == [4, 5, 6, 7]


def test_conditions_may_not_repeat_the_cursor(rows):
    with pytest.raises(ValueError, match="already"):
        filtered(rows, [("t", ">=", 1)], Cursor("t", last=2))
    assert ids(filtered(rows, [("t", ">=", 4)], Cursor("t"))) == [8, 9]
    # Another operator on the same field narrows the load, it does not replace the mark.
    assert ids(filtered(rows, [("t", "<", 4)], Cursor("t", last=3))) == [6, 7]
    assert ids(filtered(rows, [("v", "in", ["v1", "v2"]), ("id", "not in", [2])])) == [1]


def test_row_order(rows):
    def first(newest, order, last):
        cursor = Cursor("t", last=last, newest=newest, row_order=order)
        return load_table(rows, limit=1, cursor=cursor, key=["id"]).first()["id"]

    assert first(True, "asc", 1) == 2
    assert first(True, "desc", 1) == 8
    assert first(False, "asc", 1) == 2
    assert first(False, "desc", 1) == 0
    with pytest.raises(ValueError):
        Cursor("t", last=1, row_order="up").ordering()


def test_projection_keeps_keys(rows):
    assert projected(rows, ["v"], ["id"]).columns == ["id", "v"]
    assert projected(rows, {"v": 1}, ["id"]).columns == ["id", "v"]
    with pytest.warns(UserWarning, match="key"):
        assert projected(rows, {"v": 0, "id": 0}, ["id"]).columns == ["id", "t"]
    with pytest.raises(ValueError):
        projected(rows, {"v": 1, "t": 0})


def test_limit(rows):
    assert ids(limited(rows, -5, ["id"])) == [0, 1, 2, 3, 4]
    assert limited(rows, 0, ["id"]).count() == limited(rows, None).count() == 10
    with pytest.warns(UserWarning, match="ordering"):
        assert limited(rows, 3).count() == 3
    with warnings.catch_warnings():
        warnings.simplefilter("error")
        limited(rows, 3, ["id"])


def test_boundary_rows_land_once(spark, tmp_path, rows):
    target, state = str(tmp_path / "t"), str(tmp_path / "s")
    assert read_mark(spark, state, "x") is None
    assert load_increment(rows.filter("id < 5"), "x", target, state, ["id"], "t") == 2
    # id 5 arrived late with the cursor value of the mark
    assert load_increment(rows, "x", target, state, ["id"], "t") == 4
    assert ids(spark.read.parquet(target)) == list(range(10))
    # Nothing new: the mark stays, nothing is appended twice.
    assert load_increment(rows, "x", target, state, ["id"], "t") == 4
    assert spark.read.parquet(target).count() == 10


def test_run_lost_before_its_mark_is_repeated_safely(spark, tmp_path, rows):
    target, state = str(tmp_path / "t"), str(tmp_path / "s")
    append_new(rows, target, ["id"], "t")  # the data was written, the mark was not
    assert load_increment(rows, "x", target, state, ["id"], "t") == 4
    assert spark.read.parquet(target).count() == 10


def test_copies_of_a_key_keep_the_newest(spark, tmp_path):
    target = str(tmp_path / "t")
    copies = spark.createDataFrame([(1, 1, "old"), (1, 3, "new"), (1, 2, "mid")], "id INT, t INT, v STRING")
    append_new(copies, target, ["id"], "t")
    assert [tuple(r) for r in spark.read.parquet(target).collect()] == [(1, 3, "new")]


def test_a_key_lands_once_whatever_its_cursor_says_later(spark, tmp_path):
    target = str(tmp_path / "t")
    schema = "id INT, t INT, v STRING"
    loads = [
        [(1, 1, "first"), (2, None, "undated"), (None, 5, "no key")],
        [(1, 9, "later"), (1, 0, "earlier"), (2, None, "undated"), (None, 7, "no key")],
        [(1, None, "undated"), (2, 3, "dated"), (3, None, "new")],
    ]
    for batch in loads:
        append_new(spark.createDataFrame(batch, schema), target, ["id"], "t")
    landed = spark.read.parquet(target).orderBy("id").collect()
    assert [tuple(r) for r in landed] == [
        (None, 5, "no key"), (1, 1, "first"), (2, None, "undated"), (3, None, "new"),
    ]


def test_the_mark_does_not_follow_the_clock(spark, tmp_path):
    state = str(tmp_path / "state")
    marks = [(7, "2024-01-02"), (5, "2024-01-09")]
    df = spark.createDataFrame(marks, "mark INT, loaded_at STRING")
    df.selectExpr("mark", "CAST(loaded_at AS TIMESTAMP) AS loaded_at").write.parquet(f"{state}/x")
    assert read_mark(spark, state, "x") == 7


@pytest.fixture()
def delivered_files(spark, tmp_path):
    """Three files with overlapping keys, the last one with an old timestamp."""
    source = tmp_path / "in"
    schema = "id INT, ts TIMESTAMP_NTZ"
    for keys, day in (([1, 2, 3], 3), ([3, 4], 4), ([5], 1)):
        batch = [(k, datetime(2024, 1, day if k != 3 else 3, k)) for k in keys]
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(str(source))
    return str(source), spark.read.parquet(str(source)).schema


def test_stream_lands_every_key_once(spark, tmp_path, delivered_files):
    path, schema = delivered_files
    target, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    for _ in range(2):  # the second run finds no new files
        stream = file_stream(spark, path, schema, files_per_trigger=1)
        land_stream(stream, target, checkpoint, ["id"], "ts").awaitTermination()
        assert ids(spark.read.parquet(target)) == [1, 2, 3, 4, 5]


def test_stream_with_promised_lateness(spark, tmp_path, delivered_files):
    path, schema = delivered_files
    target = str(tmp_path / "out")
    stream = file_stream(spark, path, schema)
    query = land_stream_within(
        stream.union(stream), target, str(tmp_path / "cp"), ["id"], "ts", "10 days"
    )
    query.awaitTermination()
    landed = spark.read.parquet(target)
    assert ids(landed) == [1, 2, 3, 4, 5]
    assert dict(landed.dtypes)["ts"] == "timestamp_ntz"
    assert landed.agg(F.min("ts")).first()[0] == datetime(2024, 1, 1, 5)


def plan_of(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


def test_stream_with_keys_in_the_state_store(spark, tmp_path, delivered_files):
    """Three starts from one checkpoint, a key that comes again in each, null keys; no scan of the target."""
    path, schema = delivered_files
    target, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    own = state_session(spark)
    assert own.conf.get("spark.sql.session.timeZone") == spark.conf.get("spark.sql.session.timeZone")
    want = [1, 2, 3, 4, 5]
    for keys in ([], [5, 6, None], [None, 6, 1, 7]):
        if keys:
            rows = [(k, datetime(2023, 1, 1, 7)) for k in keys]
            more = spark.createDataFrame(rows, "id INT, ts TIMESTAMP_NTZ")
            more.write.mode("append").parquet(path)
            want = sorted({*want, *keys}, key=lambda k: (k is not None, k))
        stream = file_stream(own, path, schema, files_per_trigger=1)
        query = land_stream_keyed(stream, target, checkpoint, ["id"])
        query.awaitTermination()
        assert ids(spark.read.parquet(target)) == want
    text = query._jsq.explainInternal(True)
    scans = [x for x in text.splitlines() if "FileScan" in x]
    assert "StreamingDeduplicate" in text and scans and all("/in" in x and "/out" not in x for x in scans)
    assert "RocksDB" in str(query.lastProgress["stateOperators"][0]["customMetrics"].keys()).replace("rocksdb", "RocksDB")
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before


def test_an_indexed_target_reads_only_touched_buckets(spark, tmp_path):
    target = str(tmp_path / "t")
    df = spark.range(5000).selectExpr("CAST(id AS INT) AS id", "CAST(id AS INT) AS t", "CAST(id AS STRING) AS v")
    append_new_indexed(df.filter("id < 4000"), target, ["id"], "t")
    some = df.filter("id IN (17, 3999, 4000)")
    fresh, name = new_to_indexed(some, target, ["id"], "t")
    assert ids(fresh) == [4000]
    text = plan_of(fresh)
    (pruned,) = [x for x in text.splitlines() if "PartitionFilters" in x and name in x]
    assert 1 <= pruned.count(",") <= 4 and "PushedFilters: [In(id, [17,3999,4000])" in text
    assert "ReadSchema: struct<id:int>" in text
    many, _ = new_to_indexed(df.filter("id >= 3000"), target, ["id"], "t")
    assert "GreaterThanOrEqual(id,3000)" in plan_of(many) and many.count() == 1000
    append_new_indexed(df, target, ["id"], "t")
    append_new_indexed(df, target, ["id"], "t")
    assert ids(read_indexed(spark, target)) == list(range(5000))
    assert read_indexed(spark, target).columns == ["id", "t", "v"]
    # One file a bucket and load at most.
    assert spark.read.parquet(target).selectExpr("input_file_name() AS f").distinct().count() <= 2 * 64


def test_an_indexed_target_has_bloom_filters(spark, tmp_path):
    target = tmp_path / "t"
    append_new_indexed(spark.range(100).withColumnRenamed("id", "k"), str(target), ["k"])
    file = next(target.glob("*/*.parquet"))
    assert file.stat().st_size < 100_000
    jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    hadoop = jvm.org.apache.parquet.hadoop
    path = jvm.org.apache.hadoop.fs.Path(str(file))
    reader = hadoop.ParquetFileReader.open(hadoop.util.HadoopInputFile.fromPath(path, conf))
    assert reader.getFooter().getBlocks().get(0).getColumns().get(0).getBloomFilterOffset() > 0
    reader.close()


def test_composite_and_null_keys_in_an_indexed_target(spark, tmp_path):
    target = str(tmp_path / "t")
    schema = "a STRING, b INT, v STRING"
    loads = [
        [("x", 1, "1"), ("x", None, "2"), (None, 1, "3"), (None, None, "4")],
        [("x", 1, "no"), ("x", None, "no"), (None, 1, "no"), (None, None, "no"), ("y", 1, "5"), (None, 2, "6")],
        [(None, None, "no")],
    ]
    for rows in loads:
        append_new_indexed(spark.createDataFrame(rows, schema), target, ["a", "b"])
    assert sorted(r.v for r in read_indexed(spark, target).collect()) == list("123456")
    append_new_indexed(spark.createDataFrame([], schema), target, ["a", "b"])
    assert read_indexed(spark, target).count() == 6
    append_new(spark.range(2), str(tmp_path / "plain"), ["id"])
    with pytest.raises(ValueError, match="index"):
        append_new_indexed(spark.range(3), str(tmp_path / "plain"), ["id"])


@pytest.mark.parametrize("append", [append_new, append_new_indexed])
def test_a_falling_mark_is_stored(spark, tmp_path, rows, append):
    target, state = str(tmp_path / "t"), str(tmp_path / "s")

    def back(source, end=None):
        return load_increment(source, "x", target, state, ["id"], "t", end, newest=False, append=append)

    assert back(rows.filter("id <> 5"), end=2) == 3
    assert ids(spark.read.parquet(target)) == [6, 7, 8, 9]
    assert back(rows, end=1) == 2  # id 5 came late, id 4 lies at the new mark
    assert ids(spark.read.parquet(target)) == [4, 5, 6, 7, 8, 9]
    assert back(rows) == 0 and back(rows) == 0
    assert ids(spark.read.parquet(target)) == list(range(10))
    assert read_mark(spark, state, "x", newest=False) == 0


def test_loader_writes_in_a_disposition(spark, tmp_path, rows):
    path = str(tmp_path / "t")
    load(rows, path, "merge_indexed", [("id", "<", 6)], ["v"], 4, key=["id"])
    load(rows, path, "merge_indexed", [("id", "<", 6)], ["v"], key=["id"])
    assert ids(read_indexed(spark, path)) == [0, 1, 2, 3, 4, 5]
    load(rows, path, "replace", limit=2, key=["id"])
    assert ids(spark.read.parquet(path)) == [0, 1]
    with pytest.raises(ValueError, match="key"):
        load(rows, path, "merge")
