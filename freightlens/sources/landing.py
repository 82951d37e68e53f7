"""Normalise, land and copy tables between zones (I-3 … I-7, I-13, I-14)."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freightlens.sources.incremental import Condition, Cursor, append_new, append_new_indexed, load_table
from freightlens.session import written
from freightlens.sources.registry import REGISTRY


def _normal_value(c: Column, t: T.DataType) -> Column:
    if isinstance(t, (T.FloatType, T.DoubleType)):
        return F.when(~F.isnan(c), c)
    if isinstance(t, T.BinaryType):
        return F.lower(F.hex(c))
    if isinstance(t, T.DecimalType):
        return c.cast("string")
    if isinstance(t, T.TimestampType):
        return c.cast("timestamp_ntz")
    if isinstance(t, T.StructType):
        fields = [_normal_value(c[f.name], f.dataType).alias(f.name) for f in t]
        return F.when(c.isNotNull(), F.struct(*fields))
    if isinstance(t, T.ArrayType):
        return F.transform(c, lambda x: _normal_value(x, t.elementType))
    return c


def normalise(df: DataFrame) -> DataFrame:
    """One representation per kind of value, in nested fields too (I-7).

    NaN becomes NULL, binary ids become hex text, decimals become text, and
    zoned timestamps become ``timestamp_ntz`` in the session time zone.
    """
    return df.select([_normal_value(F.col(f.name), f.dataType).alias(f.name) for f in df.schema])


#: Ways to write a table: in place of what is there, behind it, or its new keys behind it.
DISPOSITIONS = ("replace", "append", "merge")
#: A merge into a target with a key index, which has a layout of its own.
MERGE_INDEXED = "merge_indexed"


def write(
    df: DataFrame, path: str, disposition: str = "replace", key: Sequence[str] = ()
) -> None:
    """Write a table in one of the ``DISPOSITIONS`` or ``MERGE_INDEXED`` (I-13).

    The merges keep rows that have landed.
    """
    if disposition not in (*DISPOSITIONS, MERGE_INDEXED):
        raise ValueError(f"unknown disposition {disposition!r}")
    if disposition in ("merge", MERGE_INDEXED):
        if not key:
            raise ValueError("merge needs a key")
        (append_new if disposition == "merge" else append_new_indexed)(df, path, key)
    else:
        mode = "overwrite" if disposition == "replace" else "append"
        df.write.mode(mode).parquet(path)


def load(
    source: DataFrame,
    path: str,
    disposition: str = "replace",
    where: Sequence[Condition] = (),
    columns: Iterable[str] | Mapping[str, int] | None = None,
    limit: int | None = None,
    cursor: Cursor | None = None,
    key: Sequence[str] = (),
) -> None:
    """Load one table with every load option (I-6) and ``write`` it (I-13)."""
    write(load_table(source, where, columns, limit, cursor, key), path, disposition, key)


def land(tables: Mapping[str, DataFrame], zone_dir: str) -> dict[str, int]:
    """Replace each table in a zone and return its row count (I-3).

    The count is observed while the table is written, so nothing is read twice.
    """
    counts = {}
    for name, df in tables.items():
        seen = Observation()
        written = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        written.write.mode("overwrite").parquet(f"{zone_dir}/{name}")
        counts[name] = seen.get["rows"]
    return counts


def read_zone(
    spark: SparkSession, zone_dir: str, tables: Iterable[str] | None = None
) -> dict[str, DataFrame]:
    """The named tables of a zone, or all registered ones that are there (I-5)."""
    if tables is not None:
        return {name: spark.read.parquet(f"{zone_dir}/{name}") for name in tables}
    found = {}
    for name in REGISTRY:
        try:
            found[name] = spark.read.parquet(f"{zone_dir}/{name}")
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
    return found


def copy_zone(
    spark: SparkSession, from_dir: str, to_dir: str, tables: Iterable[str] | None = None
) -> dict[str, int]:
    """Landing → raw: read, normalise, replace (I-4)."""
    landed = read_zone(spark, from_dir, tables)
    return land({name: normalise(df) for name, df in landed.items()}, to_dir)


def materialise(
    name: str,
    df: DataFrame,
    kind: str = "view",
    zone_dir: str | None = None,
    partition_by: str | None = None,
) -> DataFrame:
    """Publish a model as a temp view or as a Parquet table with a view on it (I-14)."""
    if kind == "table":
        if zone_dir is None:
            raise ValueError(f"table {name} needs a folder")
        path = f"{zone_dir}/{name}"
        if partition_by:
            # One task per value would serialise a hot value; AQE splits it instead.
            df = df.hint("rebalance", partition_by)
            df.write.mode("overwrite").partitionBy(partition_by).parquet(path)
        else:
            df.write.mode("overwrite").parquet(path)
        df = df.sparkSession.read.parquet(path)
    elif kind != "view":
        raise ValueError(f"unknown kind {kind!r}")
    df.createOrReplaceTempView(name)
    return df


def refresh(
    name: str,
    df: DataFrame,
    zone_dir: str,
    partition_by: str,
    changed: DataFrame,
    of_touched: Callable[[Column], DataFrame] | None = None,
) -> DataFrame:
    """Rewrite only those partitions of a materialised table that a batch has touched (I-14).

    ``changed`` has the touched values of ``partition_by``, old and new ones; ``df`` is the model
    over all data. Its other partitions are neither computed, as far as the
    filter reaches its sources, nor written. A touched partition that has no rows any more
    is removed. The touched values, at most as many as there are partitions, pass the driver.
    Where the filter reaches only some of the sources, ``of_touched`` is given the condition on
    ``partition_by`` and returns the model over less of the others, complete where it holds.
    """
    spark, path = df.sparkSession, f"{zone_dir}/{name}"
    touched = [r[0] for r in changed.select(partition_by).distinct().collect()]
    column = F.col(partition_by)
    mine = column.isin([x for x in touched if x is not None])
    mine = mine | column.isNull() if None in touched else mine
    fresh = (df if of_touched is None else of_touched(mine)).filter(mine)
    # Read the table's new state before the files that hold its old one are replaced.
    fresh = written(fresh.hint("rebalance", partition_by), "refreshed")
    fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        partition_by
    ).parquet(path)
    left = {r[0] for r in fresh.select(partition_by).distinct().collect()}
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    names = spark.sparkContext._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    for value in touched:
        if value not in left:
            text = "__HIVE_DEFAULT_PARTITION__" if value is None else names.escapePathName(str(value))
            folder = hadoop(f"{path}/{names.escapePathName(partition_by)}={text}")
            folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
    df = spark.read.parquet(path)
    df.createOrReplaceTempView(name)
    return df
