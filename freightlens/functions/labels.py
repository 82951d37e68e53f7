"""Value → label and value → rank lookups over small fixed vocabularies (F-21, O-2, O-6)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def text_sql(value: str) -> str:
    """A SQL string literal."""
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _found_sql(c: str, pairs: Mapping[str, str]) -> str:
    entries = ", ".join(f"{text_sql(value)}, {shown}" for value, shown in pairs.items())
    return f"try_element_at(map({entries}), {c})"


def relabel(c: str, labels: Mapping[str, str], otherwise: str = "keep") -> Column:
    """The label of a value.

    A value without a label stays as it is (``keep``), becomes NULL (``null``),
    or gets any other given label.
    """
    found = _found_sql(c, {value: text_sql(label) for value, label in labels.items()})
    if otherwise == "null":
        return F.expr(found)
    return F.expr(f"coalesce({found}, {c if otherwise == 'keep' else text_sql(otherwise)})")


def rank_of(c: str, order: Sequence[str]) -> Column:
    """1-based place of a value in a fixed order; unknown values come last."""
    places = {value: str(place) for place, value in enumerate(order, start=1)}
    return F.expr(f"coalesce({_found_sql(c, places)}, {len(order) + 1})")
