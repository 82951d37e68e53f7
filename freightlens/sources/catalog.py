"""Column metadata of a set of tables as a DataFrame (I-15, N-5)."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TIME_TYPES = ("date", "timestamp", "timestamp_ntz")


def column_catalog(tables: Mapping[str, DataFrame]) -> DataFrame:
    """One row per column: table, ordinal, name, type and how many values it holds.

    The metadata comes from the schemas; the value counts are one aggregate per
    table, of which only the columns that a later filter keeps are scanned when
    the caller narrows the tables first.
    """
    parts = None
    for name, df in tables.items():
        filled = df.agg(*[F.count(F.col(f.name)).alias(f.name) for f in df.schema])
        rows = filled.select(
            F.explode(
                F.array(
                    *[
                        F.struct(
                            F.lit(name).alias("table_name"),
                            F.lit(place).alias("ordinal_position"),
                            F.lit(f.name).alias("column_name"),
                            F.lit(f.dataType.simpleString()).alias("data_type"),
                            F.col(f.name).alias("value_count"),
                        )
                        for place, f in enumerate(df.schema, start=1)
                    ]
                )
            ).alias("c")
        ).select("c.*")
        parts = rows if parts is None else parts.unionByName(rows)
    return parts


#: Types whose least and greatest values Parquet files keep in a form Spark takes over.
_IN_FOOTERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DateType)


def footer_session(spark: SparkSession, push: bool = True) -> SparkSession:
    """A session like ``spark`` that answers counts and extremes of Parquet files from their footers."""
    own = spark.newSession()
    for name, value in spark.conf.getAll.items():
        if own.conf.isModifiable(name):
            own.conf.set(name, value)
    own.conf.set("spark.sql.parquet.aggregatePushdown", str(push).lower())
    listed = own.conf.get("spark.sql.sources.useV1SourceList").split(",")
    own.conf.set("spark.sql.sources.useV1SourceList", ",".join(x for x in listed if x != "parquet"))
    return own


def footer_fields(table: DataFrame, columns: Iterable[str] | None = None) -> list[T.StructField]:
    """The columns whose type has extremes in the footers."""
    wanted = set(columns) if columns is not None else None
    return [
        f for f in table.schema
        if isinstance(f.dataType, _IN_FOOTERS) and (wanted is None or f.name in wanted)
    ]


def footer_aggregate(table: DataFrame, fields: Iterable[T.StructField]) -> DataFrame:
    """One row with the number of rows, and of values and extremes of each field."""
    return table.agg(
        F.count("*").alias("rows"),
        *[g(f"`{f.name}`").alias(f"{n}_{i}") for i, f in enumerate(fields) for n, g in _EXTREMES.items()],
    )


def footer_profile(
    spark: SparkSession, path: str, columns: Iterable[str] | None = None
) -> DataFrame:
    """Rows, non-null values and extremes of a Parquet table's columns, no page of which is read (N-1, N-3).

    One row for each column whose type has extremes in the footers, numbers as
    doubles and dates as days since 1970; a column without values has null
    extremes. The one row of results passes the driver: where a row group has only nulls, its
    footer names no extremes and Spark gives up, and then the columns are read after all.
    """
    table = footer_session(spark).read.parquet(path)
    fields = footer_fields(table, columns)
    try:
        (row,) = footer_aggregate(table, fields).collect()
    except Py4JJavaError as unnamed:
        if "No min/max found" not in str(unnamed):
            raise
        (row,) = footer_aggregate(footer_session(spark, push=False).read.parquet(path), fields).collect()

    def number(x: object) -> float | None:
        return None if x is None else float((x - date(1970, 1, 1)).days if isinstance(x, date) else x)

    found = [
        (f.name, row["rows"], row[f"present_{i}"], number(row[f"low_{i}"]), number(row[f"high_{i}"]))
        for i, f in enumerate(fields)
    ]
    schema = "column STRING, rows BIGINT, present BIGINT, low DOUBLE, high DOUBLE"
    return spark.createDataFrame(found, schema)


_EXTREMES = {"present": F.count, "low": F.min, "high": F.max}


def time_columns(tables: Mapping[str, DataFrame], hidden_prefix: str = "_") -> DataFrame:
    """Columns that hold, or by their name should hold, a point in time."""
    catalog = column_catalog(tables)
    name = F.lower("column_name")
    by_type = F.col("data_type").isin(*TIME_TYPES)
    # The underscore is the LIKE wildcard here, so "state" matches as well.
    by_name = name.like("%date%") | name.like("%_at%")
    return (
        catalog.filter(~F.col("table_name").startswith(hidden_prefix))
        .filter(by_type | by_name)
        .withColumn("is_time_valued", by_type)
        .withColumn("is_delivery_event", by_type & name.contains("deliver"))
        .orderBy("table_name", "ordinal_position")
    )
