"""Aggregates whose result does not depend on the order in which rows arrive."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


#: An exact amount is a struct of whole units and billionths, 0 to 999,999,999 of them.
_PARTS = 1_000_000_000
#: Sums of billionths go in two halves, so that no number of rows overflows them.
_LOW = 31_250
_HIGH = _PARTS // _LOW

#: (below this, a double's neighbours are nearer than half of, one part in so many)
_SCALES = ((2**22, 10**9), (2**32, 10**6), (2**42, 10**3), (2**45, 10**2), (2**48, 10))


def exact_sql(amount: str, weight: str | None = None) -> str:
    """An amount of money, times a whole weight, as two bigints: units and billionths (A-8).

    Integers add up exactly, in any order, and in generated code, which wide decimals do
    not. Amounts have up to 18 digits before the point and nine after it, or as many as
    a double of that size can tell apart, so that cents stay cents.
    """
    amount = f"nanvl(CAST({amount} AS DOUBLE), NULL)"
    units = f"floor({amount})"
    told = " ".join(f"WHEN abs({amount}) < {size}D THEN {scale}" for size, scale in _SCALES)
    scale = f"CASE {told} ELSE 1 END"
    parts = f"CAST(rint(({amount} - {units}) * {scale}) AS BIGINT) * ({_PARTS}L div {scale})"
    if weight is not None:
        units, parts = f"({units}) * {weight}", f"({parts}) * {weight}"
    carried = f"({units}) + ({parts}) div {_PARTS}L"
    return f"named_struct('units', {carried}, 'parts', ({parts}) % {_PARTS}L)"


def exact_sum_sql(exact: str, where: str = "true", over: str = "") -> str:
    """Sum of exact amounts, exact again; rows outside ``where`` add zero. NULL without amounts."""

    def added(part: str) -> str:
        return f"sum({part if where == 'true' else f'if({where}, {part}, 0L)'}) {over}"

    units = added(f"({exact}).units")
    low = added(f"({exact}).parts % {_LOW}L")
    high = f"({added(f'({exact}).parts div {_LOW}L')} + ({low}) div {_LOW}L)"
    return f"""named_struct('units', {units} + {high} div {_HIGH}L,
        'parts', {high} % {_HIGH}L * {_LOW}L + ({low}) % {_LOW}L)"""


def amount_sql(exact: str) -> str:
    """An exact amount as a double: the nearest one wherever it is a number of cents."""
    units, parts = f"({exact}).units", f"({exact}).parts"
    cents = f"({units} * 100L + {parts} div {_PARTS // 100}L)"
    return f"""if({parts} % {_PARTS // 100}L = 0 AND abs({units}) < {9 * 10**13}L,
        {cents} / 100D, {units} + {parts} / {_PARTS}D)"""


def money_sum(amount: str, where: str = "true") -> Column:
    """Exact sum of an amount as a double (A-8, A-9)."""
    return F.expr(amount_sql(exact_sum_sql(exact_sql(amount), where)))


def exact_sum(exact: str, where: str = "true") -> Column:
    """Like ``money_sum`` for a column that is exact already."""
    return F.expr(amount_sql(exact_sum_sql(exact, where)))


def ratio_sql(a: str, b: str) -> str:
    """a / b as a double, NULL when b is zero (A-14, F-16)."""
    return f"try_divide(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))"


def ratio(a: str, b: str) -> Column:
    return F.expr(ratio_sql(a, b))


def hours_of_sql(days: str) -> str:
    """The whole hours that ``days_between`` made a duration from."""
    return f"CAST(rint({days} * 24) AS BIGINT)"


def total_days(days: str, where: str = "true") -> Column:
    """Sum of a duration; hours are summed as integers, so it is exact."""
    return F.expr(f"sum({hours_of_sql(days)}) FILTER (WHERE {where}) / 24D")


def mean_days(days: str, weight: str | None = None) -> Column:
    """Mean of a duration, with the same bits whatever the partitioning."""
    hours = hours_of_sql(days)
    if weight is None:
        return ratio(f"sum({hours})", f"count({days}) * 24")
    return ratio(f"sum({hours} * {weight})", f"sum(if({days} IS NULL, 0, {weight})) * 24")


def exact_quantile(c: str, p: float) -> Column:
    """The smallest value that at least a share ``p`` of the non-null values do not exceed.

    Spark keeps a (value, count) map per group and merges the maps after a
    map-side pass. The inputs here are whole hours, so the map is bounded by the
    span of the durations and not by the number of rows (A-12, A-13).
    """
    return F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY {c})")


def distinct_rows(*keys: str) -> Column:
    """Distinct composite keys; a key with a null part counts too (A-20)."""
    return F.expr(f"count(DISTINCT struct({', '.join(keys)}))")


def measures(named: Mapping[str, str | Column]) -> list[Column]:
    """Named aggregates, each a Column or SQL text."""
    return [(F.expr(m) if isinstance(m, str) else m).alias(name) for name, m in named.items()]
