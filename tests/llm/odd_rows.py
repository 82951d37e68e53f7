"""Tables with columns of clashing names."""

from __future__ import annotations

#: Extra columns whose names the operators use for themselves.
CLASHING = (
    "tokens long, weight double, probability double, copies int, ratio double, run int, "
    "block int, bucket int, fp long, held_out boolean, score double, kept string, part int"
)


def rows_of(spark, pairs, clashing: bool = True):
    """(doc_id, text) pairs as a table with lang, source, and columns of clashing names."""
    extra = len(CLASHING.split(", ")) if clashing else 0
    rows = [(i, t, "en", "web", *[None] * extra) for i, t in pairs]
    more = f", {CLASHING}" if clashing else ""
    return spark.createDataFrame(rows, f"doc_id long, text string, lang string, source string{more}")
