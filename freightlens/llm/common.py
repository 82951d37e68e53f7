"""Helpers that the operators share."""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from freightlens.session import new_run_dir


def importable(spark: SparkSession) -> None:
    """Let Python workers on this machine find the package as the driver does.

    On a cluster the package is installed or sent with ``--py-files``.
    """
    root = str(Path(__file__).resolve().parents[2])
    paths = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in paths.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [paths, root]))


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id long, text string) of every row; a null text counts as empty.

    Only these two columns are read, so other columns may have any name.
    """
    importable(df.sparkSession)
    return df.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )


def saved(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read again.

    This cuts the lineage where all executors can reach the data, so a lost
    executor costs no more than the tasks it was running.
    """
    path = f"{new_run_dir(df.sparkSession, purpose)}.parquet"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def free_name(df: DataFrame, name: str) -> str:
    """A name like ``name`` that no column of ``df`` has, in capitals or not."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z; every other letter stays as it is."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def slices(batch: pa.RecordBatch, column: str, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """A batch in slices of some megabytes of ``column``, or of one row."""
    import pyarrow.compute as pc

    start, size = 0, 0
    for i, n in enumerate(pc.binary_length(batch.column(column)).to_pylist()):
        n = n or 0
        if i > start and size + n > most:
            yield batch.slice(start, i - start)
            start, size = i, 0
        size += n
    if batch.num_rows > start:
        yield batch.slice(start)


def groups(
    batches: Iterator[pa.RecordBatch], key: str, *values: str
) -> Iterator[tuple[np.ndarray, ...]]:
    """The values of each key, in turn; the rows must be sorted by ``key``. No nulls."""
    open_key, open_parts = None, []

    def closed() -> tuple[np.ndarray, ...]:
        if len(open_parts) == 1:
            return open_parts[0]
        return tuple(np.concatenate(x) for x in zip(*open_parts))

    for batch in batches:
        if not batch.num_rows:
            continue
        keys, *columns = (batch.column(c).to_numpy(zero_copy_only=False) for c in (key, *values))
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
        for a, b in zip(cuts, cuts[1:]):
            if open_parts and keys[a] != open_key:
                yield closed()
                open_parts = []
            open_key = keys[a]
            open_parts.append(tuple(c[a:b] for c in columns))
    if open_parts:
        yield closed()
