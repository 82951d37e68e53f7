"""Does a layer hold the same table as its source? (R-1 … R-10)

A table is probed by two aggregates that meet only at a handful of rows: one
pass for counts, missing values and totals, which shuffles one row per task, and
one pass over the distinct natural keys. No keys leave the executors.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freightlens.functions.keys import canonical_key, is_missing, numbers_match, without_nan
from freightlens.session import new_run_dir
from freightlens.sources.registry import ARTIFACT_COLUMNS

Layer = DataFrame | Callable[[], DataFrame]

#: Hex digits of a SHA-256, and of each part that is added up.
_HEX_DIGITS, _HEX_DIGITS_PER_PART = 64, 8


def data_columns(df: DataFrame) -> list[str]:
    """Columns without those that a storage hop has added."""
    return [c for c in df.columns if c not in ARTIFACT_COLUMNS]


def numeric_columns(df: DataFrame) -> list[str]:
    return [
        f.name
        for f in df.schema
        if isinstance(f.dataType, T.NumericType) and f.name not in ARTIFACT_COLUMNS
    ]


def _total(field: T.StructField) -> Column:
    """Sum as a double; integers are added exactly, text is read as a number."""
    c = without_nan(field)
    if isinstance(field.dataType, T.IntegralType):
        return F.sum(c.cast("decimal(28,0)")).cast("double")
    return F.sum(c.try_cast("double"))


def key_set(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The distinct canonical keys, one per row, in a column ``key``."""
    return df.select(canonical_key(df, keys).alias("key")).distinct()


def key_digest(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many distinct keys, and a digest of the set of keys (A-20, R-7).

    Each key is hashed with SHA-256, and the eight parts of the hashes, which
    cover all their digits, are added up. Addition does not care for order, so the set needs no sorting and
    no single task sees all of it. Equal sets give equal digests.
    """
    digest = F.sha2(F.col("key"), 256)
    parts = [
        F.conv(F.substring(digest, 1 + i * _HEX_DIGITS_PER_PART, _HEX_DIGITS_PER_PART), 16, 10)
        for i in range(_HEX_DIGITS // _HEX_DIGITS_PER_PART)
    ]
    sums = [F.sum(p.cast("decimal(28,0)")).alias(f"part_{i}") for i, p in enumerate(parts)]
    added = key_set(df, keys).agg(F.count("*").alias("distinct_keys"), *sums)
    text = [F.coalesce(F.col(c).cast("string"), F.lit("0")) for c in added.columns]
    return added.select("distinct_keys", F.sha2(F.concat_ws(":", *text), 256).alias("fingerprint"))


def _measure(check: str, item: str, value: Column, digest: Column | None = None) -> Column:
    return F.struct(
        F.lit(check).alias("check"),
        F.lit(item).alias("item"),
        value.cast("double").alias("value"),
        (F.lit(None).cast("string") if digest is None else digest).alias("digest"),
    )


def probe(
    df: DataFrame,
    columns: Sequence[str],
    numeric: Sequence[str],
    keys: Sequence[str] | None = None,
    deep: bool = False,
) -> DataFrame:
    """Measures of one layer as rows (check, item, value, digest) (R-1, A-19)."""
    fields = {f.name: f for f in df.schema}
    counted = [c for c in columns if c in fields]
    added = [c for c in numeric if c in fields]
    wide = df.agg(
        F.count("*").alias("rows"),
        *[F.count_if(is_missing(fields[c])).alias(f"missing {c}") for c in counted],
        *[_total(fields[c]).alias(f"total {c}") for c in added],
    )
    measures = [_measure("row_count", "", F.col("rows"))]
    measures += [_measure("missing_values", c, F.col(f"`missing {c}`")) for c in counted]
    measures += [_measure("numeric_totals", c, F.col(f"`total {c}`")) for c in added]
    found = wide.select(F.explode(F.array(*measures)).alias("m")).select("m.*")
    if keys and all(k in fields for k in keys):
        of_keys = [_measure("distinct_keys", "", F.col("distinct_keys"))]
        if deep:
            of_keys.append(_measure("key_fingerprint", "", F.lit(None), F.col("fingerprint")))
        key_rows = key_digest(df, keys).select(F.explode(F.array(*of_keys)).alias("m"))
        found = found.unionAll(key_rows.select("m.*"))
    return found


def _finding(spark: SparkSession, table: str, check: str, layer: str, ok: bool, detail: str) -> DataFrame:
    return spark.range(1).select(
        F.lit(table).alias("table"),
        F.lit(check).alias("check"),
        F.lit(layer).alias("layer"),
        F.lit(ok).alias("ok"),
        F.lit(detail).alias("detail"),
    )


def _compare(table: str, layer: str, source: DataFrame, other: DataFrame) -> DataFrame:
    """One finding per check; its detail lists the columns that differ (R-2 … R-7)."""
    theirs = other.select(
        "check", "item", F.col("value").alias("other_value"), F.col("digest").alias("other_digest")
    )
    # Only measures that both sides can take are compared, except that a numeric
    # column absent from the layer has no total there.
    both = source.join(theirs, ["check", "item"], "left").filter(
        F.col("other_value").isNotNull()
        | F.col("other_digest").isNotNull()
        | (F.col("check") == "numeric_totals")
    )
    same_number = F.when(
        F.col("check") == "numeric_totals", numbers_match(F.col("value"), F.col("other_value"))
    ).otherwise(F.col("value").eqNullSafe(F.col("other_value")))
    same = same_number & F.col("digest").eqNullSafe(F.col("other_digest"))

    def shown(value: str, digest: str) -> Column:
        number = F.format_string("%.6f", F.col(value))
        short = F.regexp_replace(number, r"\.?0+$", "")
        return F.coalesce(F.substring(F.col(digest), 1, 12), short, F.lit("null"))

    difference = F.concat(
        F.when(F.col("item") != "", F.concat(F.col("item"), F.lit(": "))).otherwise(""),
        F.lit("source="),
        shown("value", "digest"),
        F.lit(f" {layer}="),
        shown("other_value", "other_digest"),
    )
    # One entry per differing column at most.
    differing = F.sort_array(F.collect_list(F.when(~same, difference)))
    return both.groupBy("check").agg(F.bool_and(same).alias("ok"), differing.alias("d")).select(
        F.lit(table).alias("table"),
        "check",
        F.lit(layer).alias("layer"),
        "ok",
        F.when(F.col("ok"), "match").otherwise(F.array_join("d", "; ")).alias("detail"),
    )


def reconcile(
    table: str,
    source: DataFrame,
    layers: Mapping[str, Layer],
    keys: Sequence[str] | None = None,
    deep: bool = False,
) -> DataFrame:
    """Findings (table, check, layer, ok, detail) for every layer of one table.

    A layer is a DataFrame, or a function that reads one; a layer that cannot be
    read is a finding and does not end the run (R-10).
    """
    spark = source.sparkSession
    columns, numeric = data_columns(source), numeric_columns(source)
    expected = probe(source, columns, numeric, keys, deep)
    findings = []
    for name, layer in layers.items():
        try:
            df = layer() if callable(layer) else layer
            present = set(data_columns(df))
        except PySparkException as unreadable:
            reason = str(unreadable).splitlines()[0]
            findings.append(_finding(spark, table, "reachable", name, False, reason))
            continue
        absent = [c for c in columns if c not in present]
        detail = "absent: " + ", ".join(absent) if absent else "all present"
        findings.append(_finding(spark, table, "columns", name, not absent, detail))
        actual = probe(df, columns, numeric, keys, deep)
        findings.append(_compare(table, name, expected, actual))
    return reduce(DataFrame.unionAll, findings)


def report(findings: DataFrame) -> DataFrame:
    """Checks and failures per layer (R-9)."""
    return findings.groupBy("layer").agg(
        F.count("*").alias("checks"), F.count_if(~F.col("ok")).alias("failures")
    )


#: Hex digits of a key's hash that name its coarse and its fine bucket.
_COARSE, _FINE = 2, 4


@dataclass(frozen=True)
class KeyTree:
    """The distinct keys of a layer as written, with two levels of digests over them.

    ``keys`` holds (key, fine, coarse) in folders by coarse bucket; ``digests``
    holds for each fine bucket how many keys it has and what their hashes add up to.
    There are at most 256 coarse and 65,536 fine buckets, however many keys there are.
    """

    keys: DataFrame
    digests: DataFrame

    def coarse(self) -> DataFrame:
        sums = [F.sum(c).alias(c) for c in self.digests.columns if c not in ("fine", "coarse")]
        return self.digests.groupBy("coarse").agg(*sums)


def key_tree(df: DataFrame, keys: Sequence[str], path: str | None = None) -> KeyTree:
    """Write the key set of a layer and its digests, below ``path`` or the shared folder (R-7).

    A layer's tree can be kept beside it and compared as often as wanted. The keys
    are shuffled once to make them distinct, and once to be written by bucket,
    in which AQE splits and joins buckets by their size.
    """
    spark = df.sparkSession
    path = path or new_run_dir(spark, "key-tree")
    digest = F.sha2("key", 256)
    placed = key_set(df, keys).select(
        "key", F.substring(digest, 1, _FINE).alias("fine"), F.substring(digest, 1, _COARSE).alias("coarse")
    )
    by_bucket = placed.hint("rebalance", "coarse").sortWithinPartitions("coarse", "fine")
    by_bucket.write.partitionBy("coarse").parquet(f"{path}/keys")
    schema = "key STRING, fine STRING, coarse STRING"
    stored = spark.read.schema(schema).parquet(f"{path}/keys")
    parts = [
        F.conv(F.substring(digest, 1 + i * _HEX_DIGITS_PER_PART, _HEX_DIGITS_PER_PART), 16, 10)
        for i in range(_HEX_DIGITS // _HEX_DIGITS_PER_PART)
    ]
    # Eight digits of 32 bits: sums of a bigint hold two thousand million keys a bucket.
    sums = [F.sum(p.cast("bigint")).alias(f"part_{i}") for i, p in enumerate(parts)]
    made = stored.groupBy("coarse", "fine").agg(F.count("*").alias("n"), *sums)
    made.write.parquet(f"{path}/digests")
    return KeyTree(stored, spark.read.schema(made.schema).parquet(f"{path}/digests"))


def stored_key_tree(spark: SparkSession, path: str) -> KeyTree:
    """A tree that ``key_tree`` has written."""
    keys = spark.read.schema("key STRING, fine STRING, coarse STRING").parquet(f"{path}/keys")
    return KeyTree(keys, spark.read.parquet(f"{path}/digests"))


def _unlike(ours: DataFrame, theirs: DataFrame, bucket: str) -> DataFrame:
    """Buckets whose digests differ, or that one side lacks, with the keys of both sides."""
    sums = [c for c in ours.columns if c.startswith("part_")]
    named = [F.struct("n", *sums).alias("theirs")]
    both = ours.select(bucket, F.struct("n", *sums).alias("ours")).join(
        theirs.select(bucket, *named), bucket, "full"
    )
    n = [F.coalesce(F.col(f"{side}.n"), F.lit(0)) for side in ("ours", "theirs")]
    return both.filter("NOT ours <=> theirs").select(
        bucket, n[0].alias("source_keys"), n[1].alias("layer_keys")
    )


def differing_buckets(source: KeyTree, other: KeyTree) -> DataFrame:
    """Where two key sets differ: (bucket, source_keys, layer_keys) of the fine buckets (R-7).

    The coarse digests are compared first; only fine ones below a difference are
    read. The names of differing coarse buckets, 256 at most, pass the driver, so
    that they prune files.
    """
    coarse = [r["coarse"] for r in _unlike(source.coarse(), other.coarse(), "coarse").collect()]
    below = [x.digests.filter(F.col("coarse").isin(coarse)) for x in (source, other)]
    return _unlike(*below, "fine").withColumnRenamed("fine", "bucket")


def tree_differences(source: KeyTree, other: KeyTree) -> DataFrame:
    """Keys that only one side has (U-3), joined within the buckets that differ, and read from no others."""
    buckets = differing_buckets(source, other)
    fine = [r["bucket"] for r in buckets.select("bucket").limit(_FEW_BUCKETS + 1).collect()]
    coarse = sorted({x[:_COARSE] for x in fine})
    if len(fine) > _FEW_BUCKETS:
        whole = buckets.select(F.substring("bucket", 1, _COARSE).alias("c")).distinct()
        coarse = sorted(r["c"] for r in whole.collect())

    def within(tree: KeyTree) -> DataFrame:
        keys = tree.keys.filter(F.col("coarse").isin(coarse))
        if len(fine) <= _FEW_BUCKETS:
            return keys.filter(F.col("fine").isin(fine)).select("fine", "key")
        # One short row a bucket, 65,536 at most.
        unlike = F.broadcast(buckets.select(F.col("bucket").alias("fine")))
        return keys.join(unlike, "fine", "left_semi").select("fine", "key")

    ours, theirs = within(source), within(other)
    only_ours = ours.join(theirs, ["fine", "key"], "left_anti").select("key", F.lit("source").alias("side"))
    only_theirs = theirs.join(ours, ["fine", "key"], "left_anti").select("key", F.lit("layer").alias("side"))
    return only_ours.unionAll(only_theirs)


#: Up to so many fine buckets are named in the filters on the files; more are joined.
_FEW_BUCKETS = 500


def key_differences(source: DataFrame, other: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that only one side has (U-3): the rows behind a differing digest."""
    return tree_differences(key_tree(source, keys), key_tree(other, keys))
