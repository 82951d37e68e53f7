"""Exact quantiles of any numeric column, by narrowing a histogram (A-12, A-13).

A group's quantile is sought between the least and the greatest value left. One pass
counts the values of equal steps in between, all groups and shares at once; the
step that holds the sought rank is kept, with the least and the greatest value that
it really has. So each pass leaves about one in ``steps`` of the values. When few are left, or
all of them are equal, the value is read off. Rows meet only in counts of steps: no
task holds the values of a group, however many there are, and a value that a third
of the rows share is one count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freightlens.session import written


def exact_quantiles(
    df: DataFrame,
    value: str,
    shares: Sequence[float],
    by: Sequence[str] = (),
    steps: int = 4096,
    few: int = 5000,
) -> DataFrame:
    """(by, share, value, n): the smallest value that at least the share of the n values do not exceed.

    Null and NaN values do not count; a group without others has no row. Null group keys are
    a group. The passes are jobs of their own, about log(n) / log(steps) of them; what they
    narrow to is written to the shared folder, one row for each group and share.
    """
    keys = [f"_by_{i}" for i in range(len(by))]
    number = F.nanvl(F.col(value).cast("double"), F.lit(None))
    rows = df.select(
        *[F.col(c).alias(k) for c, k in zip(by, keys)], number.alias("_v")
    ).filter("_v IS NOT NULL")
    whole = rows.groupBy(*keys).agg(
        F.count("*").alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high")
    )
    asked = [F.struct(F.lit(float(s)).alias("share"), _rank(s).alias("rank")) for s in shares]
    sought = whole.filter("_n > 0").select(
        *keys, F.col("_n").alias("_all"), "_n", "_low", "_high", F.inline(F.array(*asked))
    )
    sought = written(sought, "quantiles")
    while not sought.filter(f"_n > {few} AND _low < _high").isEmpty():
        open_ones = sought.filter(f"_n > {few} AND _low < _high")
        step = F.least(
            F.floor((F.col("_v") - F.col("_low")) / ((F.col("_high") - F.col("_low")) / steps)),
            F.lit(steps - 1).cast("long"),
        )
        counted = (
            _within(rows, open_ones, keys)
            .groupBy(*keys, "share", "rank", "_all", step.alias("_step"))
            .agg(F.count("*").alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
        )
        order = Window.partitionBy(*keys, "share").orderBy("_step")
        narrowed = (
            counted.withColumn("_upto", F.sum("_n").over(order))
            .filter("_upto >= rank AND _upto - _n < rank")
            .withColumn("rank", F.expr("rank - (_upto - _n)"))
            .select(*sought.columns)
        )
        done = sought.filter(f"NOT (_n > {few} AND _low < _high)")
        sought = written(done.unionAll(narrowed), "quantiles")
    # At most ``few`` values of each group and share, unless all are equal.
    last = Window.partitionBy(*keys, "share").orderBy("_v")
    read_off = (
        _within(rows, sought.filter("_low < _high"), keys)
        .withColumn("_place", F.row_number().over(last))
        .filter("_place = rank")
        .select(*keys, "share", F.col("_v").alias("value"), F.col("_all").alias("n"))
    )
    equal = sought.filter("_low = _high").select(
        *keys, "share", F.col("_low").alias("value"), F.col("_all").alias("n")
    )
    found = read_off.unionAll(equal)
    return found.select(*[F.col(k).alias(c) for c, k in zip(by, keys)], "share", "value", "n")


def _rank(share: float) -> Column:
    """The place of the quantile, from 1, without the rounding of doubles."""
    return F.expr(f"greatest(1L, CAST(ceil(_n * CAST('{share:.9f}' AS DECIMAL(10,9))) AS BIGINT))")


def _within(rows: DataFrame, sought: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The rows beside what is sought in their group, if they lie in its bounds."""
    named = sought.select(*[F.col(k).alias(f"{k}_") for k in keys], *sought.columns[len(keys) :])
    inside = F.col("_v").between(F.col("_low"), F.col("_high"))
    for k in keys:
        inside = inside & F.col(k).eqNullSafe(F.col(f"{k}_"))
    return rows.join(named, inside).drop(*[f"{k}_" for k in keys])
