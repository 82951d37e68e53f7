"""CSV scan with declared types (I-1)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from freightlens.sources.registry import REGISTRY, RawTable


def scan_csv(spark: SparkSession, path: str, table: RawTable) -> DataFrame:
    """One raw table from a CSV file, folder or glob, without type inference.

    The header gives the column order; a column the registry does not know is
    kept as text. A value that does not fit its declared type, or a file whose
    header differs from the first one's, fails the job instead of becoming NULL or
    landing in another column.
    """
    reader = (
        spark.read.option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("multiLine", table.free_text)
    )
    declared = {f.name: f.dataType for f in table.schema}
    header = reader.csv(path).columns
    schema = T.StructType([T.StructField(c, declared.get(c, T.StringType())) for c in header])
    return reader.schema(schema).option("mode", "FAILFAST").option("enforceSchema", False).csv(path)


def scan_folder(
    spark: SparkSession,
    data_dir: str,
    pattern: str = "{table}.csv",
    tables: Iterable[str] | None = None,
) -> dict[str, DataFrame]:
    """Every registered table that is present in a folder; absent ones are skipped."""
    found = {}
    for name in tables or REGISTRY:
        try:
            found[name] = scan_csv(
                spark, f"{data_dir}/{pattern.format(table=name)}", REGISTRY[name]
            )
        except AnalysisException as missing:
            if missing.getCondition() != "PATH_NOT_FOUND":
                raise
    return found
