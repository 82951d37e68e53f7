"""Missing values, canonical keys and tolerant comparison (F-22 … F-25)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Key encoding and tolerances.
NULL_SENTINEL = "\x00NULL\x00"
KEY_SEP = "\x01"
REL_TOL = 1e-9
ABS_TOL = 1e-6


def is_floating(t: T.DataType) -> bool:
    return isinstance(t, (T.FloatType, T.DoubleType))


def is_missing(field: T.StructField) -> Column:
    """True for NULL, and for NaN in a floating column."""
    c = F.col(field.name)
    return c.isNull() | F.isnan(c) if is_floating(field.dataType) else c.isNull()


def without_nan(field: T.StructField) -> Column:
    c = F.col(field.name)
    return F.when(~F.isnan(c), c) if is_floating(field.dataType) else c


def canonical_key(df: DataFrame, keys: Sequence[str]) -> Column:
    """One string per composite key; 1.0 and 1 are the same key, NULL and NaN too."""
    parts = []
    for name in keys:
        field, c = df.schema[name], F.col(name)
        text = c.cast("string")
        if is_floating(field.dataType):
            whole = (c == F.rint(c)) & (F.abs(c) < F.lit(1e18))
            text = F.when(whole, c.try_cast("bigint").cast("string")).otherwise(text)
        parts.append(F.when(is_missing(field), NULL_SENTINEL).otherwise(text))
    return F.concat_ws(KEY_SEP, *parts)


def numbers_match(a: Column, b: Column, rel: float = REL_TOL, absolute: float = ABS_TOL) -> Column:
    """Equal within a tolerance; two NULLs match, one NULL does not."""
    bound = F.greatest(F.greatest(F.abs(a), F.abs(b)) * F.lit(rel), F.lit(absolute))
    return F.coalesce(F.abs(a - b) <= bound, a.isNull() & b.isNull())
