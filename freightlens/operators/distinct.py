"""Exact distinct counts that can be added up later (A-4, A-5, A-20).

A set of ids is kept as bitmaps of 32,768 bits, one row for each stretch of ids that it
has any of. Bitmaps of a cell are made in one pass, cells are joined by OR, and the
count is the number of bits. So counts by month and state roll up to years or to
all states without reading the facts again, which counts themselves do not.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightlens.operators.numbering import number_rows


def dense_ids(df: DataFrame, keys: Sequence[str], name: str = "dense_id") -> DataFrame:
    """The distinct composite keys, each with a number from 1 on, for bitmaps of any kind of key.

    A key with a null part is a key. Bitmaps of numbers without gaps are the smallest.
    """
    distinct = df.select(*keys).distinct().withColumn("_all", F.lit(0))
    return number_rows(distinct, "_all", keys, name).drop("_all")


def with_dense_ids(df: DataFrame, ids: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with the number of their key, from a table that ``dense_ids`` made."""
    named = ids.select(*[F.col(k).alias(f"_key_{k}") for k in keys], *ids.columns[len(keys) :])
    same = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys]
    return df.join(named, same).drop(*[f"_key_{k}" for k in keys])


def distinct_cells(
    df: DataFrame, id_col: str, by: Sequence[str], counted: Mapping[str, str] | None = None
) -> DataFrame:
    """Bitmaps of the ids in each cell: (by, stretch, one binary column for each count).

    ``counted`` maps names to SQL conditions under which an id counts (A-5); by
    default there is one column, ``ids``, without a condition. Null ids do not count.
    """
    bitmaps = [
        F.expr(f"bitmap_construct_agg(bitmap_bit_position({id_col})) FILTER (WHERE {where})").alias(name)
        for name, where in (counted or {"ids": "true"}).items()
    ]
    stretch = F.expr(f"bitmap_bucket_number({id_col})").alias("stretch")
    return df.filter(F.col(id_col).isNotNull()).groupBy(*by, stretch).agg(*bitmaps)


def distinct_counts(
    cells: DataFrame, by: Sequence[str], levels: Mapping[str, Column] | None = None
) -> DataFrame:
    """Distinct ids of each cell of a coarser ``by``, from stored bitmaps alone.

    ``levels`` gives columns of ``by`` that the cells do not have, such as the year of
    their month.
    """
    names = [f.name for f in cells.schema if f.dataType.typeName() == "binary"]
    coarser = cells.withColumns(dict(levels)) if levels else cells
    joined = coarser.groupBy(*by, "stretch").agg(*[F.bitmap_or_agg(n).alias(n) for n in names])
    return joined.groupBy(*by).agg(
        *[F.coalesce(F.sum(F.bitmap_count(n)), F.lit(0)).alias(n) for n in names]
    )
