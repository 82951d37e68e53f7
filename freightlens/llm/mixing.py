"""Mixing sources to target weights: raking to marginals, then calibrated sampling."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freightlens.llm.common import saved

#: White space that separates words.
WORD = "[^ \\t\\r\\n]+"
#: Bits of the hash that decides about a document.
_UNIT = 1 << 52


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def unit(doc_id: Column, seed: int = 0) -> Column:
    """A number in [0, 1) that depends on the doc_id and ``seed`` alone."""
    named = F.coalesce(doc_id.cast("string"), F.lit("null"))
    digest = F.md5(F.concat(F.lit(f"{seed}:"), named).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(_UNIT))


def topic(text: Column) -> Column:
    """A coarse topic by what a text holds; the first that applies."""
    t = F.coalesce(text, F.lit(""))
    return (
        F.when(F.contains(t, F.lit("icense")), "licence")
        .when(F.contains(t, F.lit(" | ")), "table")
        .when(F.contains(t, F.lit("@")), "contact")
        .when(F.contains(t, F.lit("!! ")) | F.contains(t, F.lit("*** ")), "noise")
        .otherwise("prose")
    )


#: Targets that add up to one but for rounding leave nothing over.
NOTHING_LEFT = 1e-9


def wanted_shares(cells: DataFrame, margin: str, targets: dict[str, float]) -> DataFrame:
    """(margin, want): the share of all tokens that each value of a marginal must get.

    Values that ``targets`` does not name share what it leaves over in
    proportion to their tokens. If it leaves nothing over, each keeps the share
    it has, and the targets hold among the values named; a value is left out only by
    a target of 0. Values that hold no tokens get nothing. The
    shares are then scaled to add up to one, which also spreads the targets of
    values that do not occur.
    """
    target = F.lit(None).cast("double")
    for value, share in targets.items():
        target = F.when(F.col(margin) == value, F.lit(float(share))).otherwise(target)
    have = cells.groupBy(margin).agg(F.sum("tokens").alias("have")).filter("have > 0")
    have = have.withColumn("target", target)
    unnamed = F.when(F.col("target").isNull(), F.col("have"))
    held, free, named = have.agg(F.sum("have"), F.sum(unnamed), F.sum("target")).first()
    rest = 1.0 - sum(targets.values())
    if rest <= NOTHING_LEFT and free:
        # Once all is scaled to add up to one, the unnamed have free / held of it.
        rest = named * free / (held - free) if named else 1.0
    have = have.withColumn(
        "want", F.coalesce("target", F.lit(rest) * F.col("have") / F.lit(float(free or 1)))
    )
    total = have.agg(F.sum("want")).first()[0] or 1.0
    return have.select(margin, (F.col("want") / F.lit(total)).alias("want"))


#: Up to so many cells, they are scaled in windows, and broadcast to the documents.
FEW_CELLS = 200_000
#: Rounds between two writes of the cells.
ROUNDS_AT_ONCE = 4


def rake(
    cells: DataFrame,
    targets: dict[str, dict[str, float]],
    rounds: int = 12,
    tolerance: float = 1e-12,
) -> DataFrame:
    """The cells with ``weight``: their share of the tokens once every marginal has its shares.

    ``cells`` has one row for each combination of the marginals and its
    ``tokens``. A round scales the weights to one marginal after the other. It
    ends after ``rounds``, with the last marginal exact, or earlier if no
    share is off by more than ``tolerance``. Targets that contradict each other never
    settle; the last round then counts.
    """
    wants = {m: saved(wanted_shares(cells, m, t), f"want-{m}") for m, t in targets.items()}
    now = cells.filter("tokens > 0").withColumn("weight", F.col("tokens").cast("double"))
    few = cells.count() <= FEW_CELLS
    for done in range(1, rounds + 1):
        for m, want in wants.items():
            now = _scaled(now, m, F.broadcast(want)) if few else _scaled_apart(now, m, want)
        if done % ROUNDS_AT_ONCE and done < rounds:
            continue
        now = saved(now.coalesce(8), "cells")
        off = [
            now.groupBy(m).agg(F.sum("weight").alias("have")).join(want, m)
            .select(F.abs(F.col("have") - F.col("want")).alias("off"))
            for m, want in list(wants.items())[:-1]
        ]
        if not off:
            break
        most = reduce(DataFrame.unionByName, off).agg(F.max("off")).first()[0]
        if (most or 0.0) <= tolerance:
            break
    return now


def _scaled(now: DataFrame, m: str, want: DataFrame) -> DataFrame:
    have = F.sum("weight").over(Window.partitionBy(m))
    return _by(now.withColumn("have", have).join(want, m))


def _scaled_apart(now: DataFrame, m: str, want: DataFrame) -> DataFrame:
    """The same for cells that no task should hold: sums are combined, and each step is written."""
    sums = now.groupBy(m).agg(F.sum("weight").alias("have")).join(want, m)
    return saved(_by(now.join(sums, m)), "cells")


def _by(cells: DataFrame) -> DataFrame:
    scale = F.when(F.col("have") > 0, F.col("want") / F.col("have")).otherwise(0.0)
    return cells.withColumn("weight", F.col("weight") * scale).drop("have", "want")


def _cell(marginals: dict[str, Column], prefix: str = "") -> dict[str, Column]:
    return {
        prefix + m: F.coalesce(c.cast("string"), F.lit("(none)")) for m, c in marginals.items()
    }


def _rates(
    docs: DataFrame,
    targets: dict[str, dict[str, float]],
    names: list[str],
    size: float,
) -> DataFrame:
    """(names, ratio, expected) of each cell: weight for a token, and copies of a document."""
    cells = saved(docs.groupBy(*names).agg(F.sum("tokens").alias("tokens")).coalesce(8), "cells")
    raked = rake(cells, targets).withColumn("ratio", F.col("weight") / F.col("tokens"))
    budget = size * float(cells.agg(F.sum("tokens")).first()[0] or 0)
    expected = F.col("ratio") * F.lit(budget)
    rates = raked.select(*names, "ratio", expected.alias("expected"))
    return F.broadcast(rates) if cells.count() <= FEW_CELLS else rates


def _copies(expected: Column, doc_id: Column, seed: int) -> Column:
    whole = F.floor(expected)
    return (whole + (unit(doc_id, seed) < expected - whole).cast("int")).cast("int")


def mix(
    df: DataFrame,
    targets: dict[str, dict[str, float]],
    marginals: dict[str, Column],
    id_col: str = "doc_id",
    text_col: str = "text",
    size: float = 1.0,
    seed: int = 0,
) -> DataFrame:
    """One row per input row: doc_id, the marginals, tokens, weight, probability, copies.

    ``marginals`` names each marginal and gives its column, ``targets`` the
    shares of tokens wanted of its values (see wanted_shares). ``weight`` is the
    share of the mix that the document's tokens stand for, ``probability`` the
    expected number of its copies. The mix has, on average, ``size`` times as many tokens as the
    table, so documents of scarce cells are repeated and those of plentiful ones
    sampled. The whole part of the expectation is certain; a hash of doc_id and
    ``seed`` decides about the rest, so results do not depend on partitioning or
    the order of rows.

    A null value of a marginal is the value "(none)". Null and empty texts have
    no tokens: they are sampled like the rest of their cell, and never if the
    whole cell has none. Rows that repeat a doc_id are decided alike. An empty
    table gives no rows. Other columns are not read.
    """
    names = list(marginals)
    doc_id = F.col(f"`{id_col}`").cast("long").alias("doc_id")
    tokens = n_words(F.col(f"`{text_col}`").cast("string")).alias("tokens")
    cell = [c.alias(m) for m, c in _cell(marginals).items()]
    docs = saved(df.select(doc_id, *cell, tokens), "tokens")
    rates = _rates(docs, targets, names, size)
    expected = F.coalesce("expected", F.lit(0.0))
    return docs.join(rates, names, "left").select(
        "doc_id",
        *names,
        "tokens",
        (F.col("tokens") * F.coalesce("ratio", F.lit(0.0))).alias("weight"),
        expected.alias("probability"),
        _copies(expected, F.col("doc_id"), seed).alias("copies"),
    )


def sample(
    df: DataFrame,
    targets: dict[str, dict[str, float]],
    marginals: dict[str, Column],
    id_col: str = "doc_id",
    text_col: str = "text",
    size: float = 1.0,
    seed: int = 0,
) -> DataFrame:
    """The mix itself: each row, with all its columns, as often as mix() gives it copies.

    Its tokens have, on average, the shares wanted of every marginal. The texts are read once for the weights and once to pass on the rows; they
    are not shuffled while the cells are few.
    """
    names = ["__mix_" + m for m in marginals]
    cell = _cell(marginals, "__mix_")
    tokens = n_words(F.col(f"`{text_col}`").cast("string")).alias("tokens")
    docs = df.select(*[c.alias(m) for m, c in cell.items()], tokens)
    by_name = {"__mix_" + m: t for m, t in targets.items()}
    rates = _rates(docs, by_name, names, size).withColumnRenamed("expected", "__mix_expected")
    expected = F.coalesce("__mix_expected", F.lit(0.0))
    copies = _copies(expected, F.col(f"`{id_col}`").cast("long"), seed)
    rows = df.withColumns(cell).join(rates.drop("ratio"), names, "left")
    each = rows.withColumn("__mix_copy", F.explode(F.array_repeat(F.lit(0), copies)))
    return each.select(*[f"`{c}`" for c in df.columns])
