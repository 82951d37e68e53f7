"""Merkle manifest of a table: a digest of each row, a tree for each group, one root, and proofs.

H is the lowercase hexadecimal SHA-256 of its inputs put one after the other. A
row's leaf is H of its fields, each as the number of its UTF-8 bytes, a colon
and its text, or "-" if null. In each group the leaves ascend by id; as long as there are
several nodes, each two consecutive ones become their H, and a last node that
is left over becomes the H of itself. What remains is the group's subroot (a lone
leaf itself). The subroots, in order of their groups, make the root alike. A
leaf's proof is the siblings it meets on its way to the root.

The work goes by superblocks, runs of 2^block_bits consecutive nodes. First each
superblock is reduced to its top; the tops are the next, far smaller tree, which
gives each of them its path to the root in the same way. Then a superblock's
leaves and the outer nodes it needs are cogrouped, and one call finishes
the local reduction, joins the proofs and folds each leaf up to the root. So
no task holds more than a superblock, and however many rows a group has, they are spread.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightlens.llm.common import importable, saved
from freightlens.operators.numbering import number_rows

PATHS = "g long, pos long, lefts array<string>, rights array<string>, subroot string, root string"
FOUND = (
    "doc_id long, leaf string, subroot string, root string, proof string, folded_root string, "
    "verified boolean, place long, group_size long"
)


def digest(*inputs: str) -> str:
    return hashlib.sha256("".join(inputs).encode()).hexdigest()


def levels(nodes: Sequence[str], rounds: int | None) -> list[list[str]]:
    """The nodes and the levels above them: ``rounds`` of them, or until one node remains."""
    found = [list(nodes)]
    while len(found) <= rounds if rounds is not None else len(found[-1]) > 1:
        below = found[-1]
        found.append([digest(*below[i : i + 2]) for i in range(0, len(below), 2)])
    return found


def sides(found: list[list[str]], i: int) -> tuple[list[str], list[str]]:
    """What stands left and right of node i's ancestors, level by level; "" where nothing does."""
    lefts, rights = [], []
    for level in found[:-1]:
        lefts.append(level[i - 1] if i & 1 else "")
        rights.append(level[i + 1] if not i & 1 and i + 1 < len(level) else "")
        i >>= 1
    return lefts, rights


def fold(leaf: str, lefts: Sequence[str], rights: Sequence[str]) -> str:
    """The root that a leaf and its siblings lead to."""
    for left, right in zip(lefts, rights):
        leaf = digest(left, leaf, right)
    return leaf


def leaf_of(values: Sequence[Column]) -> Column:
    """H of the values, each with its length, so that no two rows share an encoding."""
    texts = [v.cast("string") for v in values]
    sized = [F.concat(F.octet_length(t).cast("string"), F.lit(":"), t) for t in texts]
    return F.sha2(F.concat(*[F.coalesce(x, F.lit("-")) for x in sized]), 256)


def _in_blocks(nodes: DataFrame, bits: int):
    return nodes.withColumn("block", F.shiftright("pos", bits)).groupBy("g", "block")


def _rounds(n: int, bits: int) -> int | None:
    """Rounds within a superblock of a level of n nodes; None: until one remains."""
    return bits if n > 1 << bits else None


def _outer(nodes: DataFrame, bits: int, groups: bool) -> DataFrame:
    """The path to the root of each superblock's top (``PATHS``, pos counts the superblocks).

    ``nodes`` has g, pos (from 0, within g), n (nodes of g) and digest. With
    ``groups``, the groups' tops are nodes of one more tree.
    """

    def reduce(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        n = int(rows["n"].iloc[0])
        (top,) = levels(rows["digest"], _rounds(n, bits))[-1]
        return pd.DataFrame({"g": [key[0]], "pos": [key[1]], "n": [-(-n >> bits)], "digest": [top]})

    def joined(key: tuple, rows: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        up = outer.iloc[0]
        found = levels(rows["digest"], _rounds(int(rows["n"].iloc[0]), bits))
        paths = [sides(found, i) for i in range(len(rows))]
        return pd.DataFrame(
            {
                "g": rows["g"].to_numpy(),
                "pos": rows["pos"].to_numpy(),
                "lefts": [left + list(up["lefts"]) for left, _ in paths],
                "rights": [right + list(up["rights"]) for _, right in paths],
                "subroot": up["subroot"],
                "root": up["root"],
            }
        )

    schema = "g long, pos long, n long, digest string"
    tops = saved(_in_blocks(nodes, bits).applyInPandas(reduce, schema), "merkle-tops")
    if not tops.filter("n > 1").isEmpty():
        up = _outer(tops, bits, groups)
        return _in_blocks(tops, bits).cogroup(_in_blocks_of(up)).applyInPandas(joined, PATHS)
    if not groups:
        none = "CAST(array() AS array<string>)"
        return tops.selectExpr(
            "g", "pos", f"{none} AS lefts", f"{none} AS rights", "digest AS subroot", "digest AS root"
        )
    roots = tops.selectExpr("0L AS g", "g AS pos", f"{tops.count()}L AS n", "digest")
    up = _outer(roots, bits, False)
    up = _in_blocks(roots, bits).cogroup(_in_blocks_of(up)).applyInPandas(joined, PATHS)
    return tops.join(up.selectExpr("pos AS g", "lefts", "rights", "root"), "g").selectExpr(
        "g", "pos", "lefts", "rights", "digest AS subroot", "root"
    )


def _in_blocks_of(outer: DataFrame):
    return outer.groupBy("g", F.col("pos").alias("block"))


def manifest(
    df: DataFrame,
    fields: Sequence[str] = ("doc_id", "source", "lang", "n_chars", "text"),
    id_col: str = "doc_id",
    group_col: str = "lang",
    tampered: Mapping[str, Column] | None = None,
    block_bits: int = 12,
) -> DataFrame:
    """One row per row of ``df``: its leaf, the roots above it, its proof, and the check of it.

    ``proof`` is the siblings' digests, 64 letters each, from the leaf upwards.
    ``place`` (from 0) and ``group_size`` say on which side each stands.
    ``folded_root`` is what the leaf, or that of the row with the values of
    ``tampered``, folds to with the original siblings; ``verified`` tells whether it is the root.

    Every row counts. A null group is a group of its own before all others; null ids come
    first in their group; rows with equal ids follow each other by their leaves,
    and equal rows have equal leaves at places of their own. Nulls, empty and
    very long texts are hashed as they are. A table without rows has no root and
    gives no rows. Only the named columns are read, so others may have any name.
    """
    importable(df.sparkSession)
    columns = {f: F.col(f"`{f}`") for f in fields}
    other = {**columns, **(tampered or {})}
    changed = F.lit(False)
    for f in tampered or {}:
        changed = changed | ~columns[f].eqNullSafe(other[f])
    leaves = df.select(
        F.col(f"`{group_col}`").cast("string").alias("name"),
        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
        leaf_of(list(columns.values())).alias("digest"),
        F.when(changed, leaf_of([other[f] for f in fields])).alias("tampered"),
    )
    # Hashed once, before the sampling and the shuffle of the numbering.
    leaves = saved(leaves, "merkle-leaves")
    placed = number_rows(leaves, "name", ["doc_id", "digest", "tampered"], "pos")
    sizes = placed.groupBy("name").agg(F.count("*").alias("n"), F.lit(0).alias("all"))
    sizes = number_rows(sizes, "all", ["name"], "g").selectExpr("name AS of", "n", "g - 1 AS g")
    nodes = placed.join(sizes, F.col("name").eqNullSafe(F.col("of"))).select(
        "g", F.expr("pos - 1 AS pos"), "n", "doc_id", "digest", "tampered"
    )

    def finish(key: tuple, rows: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("pos")
        n = int(rows["n"].iloc[0])
        up = outer.iloc[0]
        lefts, rights, root = list(up["lefts"]), list(up["rights"]), up["root"]
        above = "".join(a + b for a, b in zip(lefts, rights))
        found = levels(rows["digest"], _rounds(n, block_bits))
        proofs, folded = [], []
        for i, (leaf, other_leaf) in enumerate(zip(rows["digest"], rows["tampered"])):
            a, b = sides(found, i)
            proofs.append("".join(x + y for x, y in zip(a, b)) + above)
            start = other_leaf if isinstance(other_leaf, str) else leaf
            folded.append(fold(fold(start, a, b), lefts, rights))
        return pd.DataFrame(
            {
                "doc_id": rows["doc_id"].array,
                "leaf": rows["digest"].array,
                "subroot": up["subroot"],
                "root": root,
                "proof": proofs,
                "folded_root": folded,
                "verified": [x == root for x in folded],
                "place": rows["pos"].array,
                "group_size": n,
            }
        )

    outer = saved(_outer(nodes.select("g", "pos", "n", "digest"), block_bits, True), "merkle-paths")
    return _in_blocks(nodes, block_bits).cogroup(_in_blocks_of(outer)).applyInPandas(finish, FOUND)
