"""Declarative data checks (Q-1 … Q-8).

Each check returns the violating rows; an empty result is a pass. ``failures``
turns named checks into one table of counts.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def unique_combination(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Combinations that occur more than once, with their number of rows (Q-4)."""
    return df.groupBy(*columns).agg(F.count("*").alias("rows")).filter("rows > 1")


def unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once; nulls are not values (Q-1, P-11)."""
    return unique_combination(df.filter(F.col(column).isNotNull()), [column])


def relationships(child: DataFrame, column: str, parent: DataFrame, field: str) -> DataFrame:
    """Keys of the child that the parent lacks, with their number of child rows (Q-3, J-13).

    Child keys are counted first, so a frequent key is looked up once.
    """
    keys = child.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("rows"))
    return keys.join(parent.select(F.col(field).alias(column)), column, "left_anti")


def values_in_set(df: DataFrame, column: str, allowed: Sequence[Any]) -> DataFrame:
    c = F.col(column)
    return df.filter(c.isNotNull() & ~c.isin(*allowed))


def values_between(
    df: DataFrame, column: str, low: Any, high: Any, row_condition: Column | str | None = None
) -> DataFrame:
    rows = df if row_condition is None else df.filter(row_condition)
    return rows.filter(~F.col(column).between(low, high))


def pair_greater(
    df: DataFrame,
    a: str,
    b: str,
    or_equal: bool = False,
    row_condition: Column | str | None = None,
) -> DataFrame:
    rows = df if row_condition is None else df.filter(row_condition)
    holds = F.col(a) >= F.col(b) if or_equal else F.col(a) > F.col(b)
    return rows.filter(~holds)


def one_header_per_order(fact: DataFrame) -> DataFrame:
    """Orders whose fact rows do not carry exactly one header flag (Q-8)."""
    return (
        fact.groupBy("order_id")
        .agg(F.count_if("is_order_header_row").alias("header_row_count"))
        .filter("header_row_count != 1")
    )


def failures(checks: Mapping[str, DataFrame]) -> DataFrame:
    """Number of violating rows per check (R-9 style summary of Q-1 … Q-8).

    A check that returns groups says how many rows each stands for in a
    ``rows`` column only when rows are what fails (``relationships``).
    """
    counted = [
        violating.agg(F.count("*").alias("failing_rows")).select(
            F.lit(name).alias("check"), "failing_rows"
        )
        for name, violating in checks.items()
    ]
    return reduce(DataFrame.unionAll, counted)


def orphan_rows(checks: Mapping[str, DataFrame]) -> DataFrame:
    """Number of child rows without a parent, per relationship check."""
    counted = [
        keys.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("failing_rows")).select(
            F.lit(name).alias("check"), "failing_rows"
        )
        for name, keys in checks.items()
    ]
    return reduce(DataFrame.unionAll, counted)


def null_failures(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Nulls in columns that must not have any (Q-2), one pass per table."""
    parts = []
    for name, (df, columns) in tables.items():
        wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(f"{name}.{c}") for c in columns])
        columns_of = [F.col(f"`{c}`") for c in wide.columns]
        parts.append(wide.unpivot([], columns_of, "check", "failing_rows"))
    return reduce(DataFrame.unionAll, parts)
