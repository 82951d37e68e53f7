"""Hard negatives by exact integer scores, looked up in subset-sum tables.

A component x becomes the integer floor(scale * x). The score of a row for an
anchor is the inner product of their integers, exact in 64 bits. It is never
multiplied out. Eight components of an anchor make a table of its 256 subset sums (the
Four Russians' trick). A row's integers are stored as bit planes, two's complement,
so that one byte holds one bit of eight components, and indexes that table. The
looked-up sums of all bytes of a plane are added, and the planes are added up
from the highest, which counts negatively, with a doubling at each step.

Anchors are a stated set of queries. They and all rows are dealt into blocks by
a hash of their ids, each block is packed into one row, and each pair of blocks
meets once in a cogroup on both block numbers. A pair of blocks yields no more than
the best few for each anchor, which a limited window then merges. That is done
twice: for the positives, and, once their scores are known, for the negatives.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from freightlens.llm.common import importable, saved

#: Rows scored at a time, and anchors whose tables are held at a time.
ROWS_AT_ONCE, ANCHORS_AT_ONCE = 2048, 32

ROWS = "c long, ids binary, labels binary, n_planes int, n_groups int, planes binary"
ANCHORS = "a long, ids binary, labels binary, dims int, vectors binary, found binary"
FOUND = "anchor_id long, id long, score long"
MINED = "anchor_id long, positive_id long, positive_score long, id long, score long"


def matrix(vectors: pa.Array) -> np.ndarray:
    """The lists as rows of a matrix; shorter ones are filled up with zeros."""
    lengths = np.diff(vectors.offsets.to_numpy())
    filled = np.arange(lengths.max(initial=0)) < lengths[:, None]
    found = np.zeros(filled.shape, np.int64)
    found[filled] = vectors.flatten().to_numpy(zero_copy_only=False)
    return found


def bit_planes(values: np.ndarray) -> np.ndarray:
    """[plane, group of eight dimensions, row] bytes of the rows' integers, lowest plane first."""
    n, dims = values.shape
    reach = max(int(values.max(initial=0)), ~int(values.min(initial=0)))
    n_planes = reach.bit_length() + 1
    padded = np.zeros((n, -(-dims // 8) * 8), np.int64)
    padded[:, :dims] = values
    bits = ((padded >> p & 1).astype(np.uint8) for p in range(n_planes))
    planes = [np.packbits(x, axis=1, bitorder="little").T for x in bits]
    return np.ascontiguousarray(planes).reshape(n_planes, padded.shape[1] // 8, n)


def subset_sums(anchors: np.ndarray, kind: type) -> np.ndarray:
    """[group of eight dimensions, subset, anchor] sums of the anchors' components."""
    n, dims = anchors.shape
    padded = np.zeros((n, -(-dims // 8) * 8), kind)
    padded[:, :dims] = anchors
    found = np.zeros((padded.shape[1] // 8, 256, n), kind)
    for g in range(len(found)):
        for bit in range(8):
            at = 1 << bit
            np.add(found[g, :at], padded[:, 8 * g + bit], out=found[g, at : 2 * at])
    return found


def scores(tables: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """[row, anchor] inner products. Dimensions that one side lacks count as zero."""
    n_planes, n_groups, n = planes.shape
    found = np.zeros((n, tables.shape[2]), tables.dtype)
    looked_up = np.empty_like(found)
    total = np.empty_like(found)
    groups = min(n_groups, len(tables))
    for p in reversed(range(n_planes)):
        total[:] = 0
        for g in range(groups):
            np.take(tables[g], planes[p, g], axis=0, out=looked_up, mode="clip")
            np.add(total, looked_up, out=total)
        if p == n_planes - 1:
            np.negative(total, out=found)
        else:
            np.left_shift(found, 1, out=found)
            np.add(found, total, out=found)
    return found


def share(x: np.ndarray, percent: int) -> np.ndarray:
    """floor(x * percent / 100) without leaving 64 bits."""
    return x // 100 * percent + x % 100 * percent // 100


def first_of_each(of: np.ndarray, score: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Places of the first n of each ``of``, higher scores first, ties by smaller id."""
    order = np.lexsort((ids, -score, of))
    sorted_of = of[order]
    return order[np.arange(len(order)) - np.searchsorted(sorted_of, sorted_of) < n]


class Block:
    """A packed block of rows, sorted by label and id."""

    def __init__(self, row: dict) -> None:
        self.ids = np.frombuffer(row["ids"], "<i8")
        self.labels = np.frombuffer(row["labels"], "<i8")
        shape = row["n_planes"], row["n_groups"], len(self.ids)
        self.planes = np.frombuffer(row["planes"], np.uint8).reshape(shape).astype(np.intp)

    def scored(self, anchors: np.ndarray, of: slice) -> np.ndarray:
        """[row, anchor] scores of some of the rows."""
        planes = self.planes[:, :, of]
        # What any partial sum can reach decides the width of the integers.
        reach = int(np.abs(anchors).sum(axis=1, dtype=np.float64).max(initial=0)) << len(planes)
        kind = np.int32 if reach < 2**31 else np.int64
        tables = subset_sums(anchors, kind)
        n = planes.shape[2]
        cuts = range(0, n, ROWS_AT_ONCE)
        found = [scores(tables, planes[:, :, i : i + ROWS_AT_ONCE]) for i in cuts]
        return np.concatenate(found) if found else np.zeros((0, len(anchors)), kind)


class Anchors:
    """A packed block of anchors, sorted by label, with the positives found for them, if any."""

    def __init__(self, row: dict) -> None:
        self.ids = np.frombuffer(row["ids"], "<i8")
        self.labels = np.frombuffer(row["labels"], "<i8")
        self.vectors = np.frombuffer(row["vectors"], "<i8").reshape(len(self.ids), row["dims"])
        #: (place of the anchor, id of the positive, its score)
        self.found = np.frombuffer(row["found"], "<i8").reshape(-1, 3)


def best_positives(rows: Block, anchors: Anchors, n: int) -> tuple[np.ndarray, ...]:
    """(anchor_id, id, score) of each anchor's first n other rows of its label in the block."""
    found = [(np.zeros(0, np.int64),) * 3]
    for label in np.unique(anchors.labels):
        of = slice(*np.searchsorted(rows.labels, [label, label + 1]))
        own = np.flatnonzero(anchors.labels == label)
        ids = rows.ids[of]
        for i in range(0, len(own) if len(ids) else 0, ANCHORS_AT_ONCE):
            some = own[i : i + ANCHORS_AT_ONCE]
            points = rows.scored(anchors.vectors[some], of)
            others = ids[:, None] != anchors.ids[some]
            # The anchor itself may take one of the places that are looked at.
            last = max(0, len(ids) - n - 1)
            good = others & (points >= np.partition(points, last, axis=0)[last])
            row, col = np.nonzero(good)
            keep = first_of_each(col, points[row, col].astype(np.int64), ids[row], n)
            row, col = row[keep], col[keep]
            found.append((anchors.ids[some[col]], ids[row], points[row, col].astype(np.int64)))
    return tuple(map(np.concatenate, zip(*found)))


def best_negatives(
    rows: Block, anchors: Anchors, n: int, lowest: int, highest: int
) -> tuple[np.ndarray, ...]:
    """(anchor_id, positive_id, positive_score, id, score) of the first n rows for each positive."""
    found = [(np.zeros(0, np.int64),) * 5]
    at, positives, of_positive = anchors.found.T
    low, high = -share(-of_positive, lowest), share(of_positive, highest)
    for i in range(0, len(anchors.ids), ANCHORS_AT_ONCE):
        asked = np.flatnonzero((at >= i) & (at < i + ANCHORS_AT_ONCE) & (low <= high))
        some, which = np.unique(at[asked], return_inverse=True)
        if not len(some):
            continue
        points = rows.scored(anchors.vectors[some], slice(None))
        # The widest band of each anchor's positives first, then each of them.
        floor, ceiling = np.full(len(some), 2**63 - 1), np.full(len(some), -(2**63))
        np.minimum.at(floor, which, low[asked])
        np.maximum.at(ceiling, which, high[asked])
        row, col = np.nonzero((points >= floor) & (points <= ceiling))
        other = rows.labels[row] != anchors.labels[some[col]]
        row, col = row[other], col[other]
        points = points[row, col].astype(np.int64)
        order = np.lexsort((rows.ids[row], -points, col))
        row, col, points = row[order], col[order], points[order]
        starts = np.searchsorted(col, np.arange(len(some) + 1))
        for k, a in zip(asked, which):
            own = slice(starts[a], starts[a + 1])
            falling = -points[own]
            first, end = np.searchsorted(falling, -high[k]), np.searchsorted(falling, -low[k], "right")
            take = slice(own.start + first, own.start + min(end, first + n))
            m = max(0, take.stop - take.start)
            if m:
                known = (anchors.ids[at[k]], positives[k], of_positive[k])
                found.append((*(np.full(m, x) for x in known), rows.ids[row[take]], points[take]))
    return tuple(map(np.concatenate, zip(*found)))


def _row(schema: str, values: list) -> pa.Table:
    kinds = {"long": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    named = [x.split() for x in schema.split(", ")]
    fields = pa.schema([(name, kinds[kind]) for name, kind in named])
    return pa.Table.from_pylist([dict(zip(fields.names, values))], schema=fields)


def _packed_rows(table: pa.Table) -> pa.Table:
    table = table.sort_by([("label", "ascending"), ("id", "ascending")]).combine_chunks()
    planes = bit_planes(matrix(table.column("v").chunk(0)))
    ids, labels = (table.column(c).to_numpy().astype("<i8").tobytes() for c in ("id", "label"))
    c = table.column("c")[0].as_py()
    return _row(ROWS, [c, ids, labels, *planes.shape[:2], planes.tobytes()])


def _packed_anchors(table: pa.Table) -> pa.Table:
    table = table.sort_by([("label", "ascending"), ("id", "ascending")]).combine_chunks()
    vectors = matrix(table.column("v").chunk(0))
    ids, labels = (table.column(c).to_numpy().astype("<i8").tobytes() for c in ("id", "label"))
    positives = table.column("positives").to_pylist()
    found = [(i, p["id"], p["score"]) for i, own in enumerate(positives) for p in own]
    found = np.array(found, "<i8").tobytes()
    a = table.column("a")[0].as_py()
    return _row(ANCHORS, [a, ids, labels, vectors.shape[1], vectors.astype("<i8").tobytes(), found])


def _meetings(
    rows: DataFrame,
    anchors: DataFrame,
    counts: tuple[int, int],
    best: Callable[[Block, Anchors], tuple[np.ndarray, ...]],
    schema: str,
) -> DataFrame:
    """What ``best`` finds where a packed block of rows meets one of anchors, one pair at a time."""
    names = [x.split()[0] for x in schema.split(", ")]

    def met(own_rows: pa.Table, own_anchors: pa.Table) -> pa.Table:
        found = (np.zeros(0, np.int64),) * len(names)
        if own_rows.num_rows and own_anchors.num_rows:
            found = best(Block(own_rows.to_pylist()[0]), Anchors(own_anchors.to_pylist()[0]))
        return pa.table([pa.array(x, pa.int64()) for x in found], names=names)

    n_rows, n_anchors = counts
    of_rows = rows.withColumn("a", F.expr(f"explode(sequence(0L, {n_anchors - 1}L))"))
    of_anchors = anchors.withColumn("c", F.expr(f"explode(sequence(0L, {n_rows - 1}L))"))
    both = of_rows.groupBy("a", "c").cogroup(of_anchors.groupBy("a", "c"))
    return both.applyInArrow(met, schema)


def _dealt(df: DataFrame, name: str, n_blocks: int) -> DataFrame:
    return df.withColumn(name, F.pmod(F.xxhash64("id"), F.lit(n_blocks)))


def mine(
    df: DataFrame,
    anchor: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label: Column | None = None,
    scale: int = 256,
    n_positives: int = 5,
    n_negatives: int = 3,
    lowest: int = 50,
    highest: int = 95,
    rows_a_block: int = 4096,
    anchors_a_block: int = 2048,
) -> DataFrame:
    """Hard negatives for each anchor and positive: anchor_id, positive_id, rank, negative_id, two scores.

    Anchors are the rows where ``anchor`` is true; ``label`` (default: the
    column of that name) is an integer. An anchor's positives are its first
    ``n_positives`` other rows of the same label, higher scores first, ties by
    smaller id. For each of them the first ``n_negatives`` rows of other labels
    are returned whose score is from ``lowest`` to ``highest`` percent of the positive's.

    Rows with a null id, label or vector, or a null or non-finite component,
    take no part. Rows are told apart by their ids: of several rows with one id,
    the one with the smallest label, then vector, counts. Vectors of different
    lengths meet as if the shorter ended in zeros. Scores are 64-bit integers, so the scaled
    components must be small enough for them. A table without rows, anchors
    or positives gives no rows. Only the named columns are read, so others may have any name.
    """
    spark = df.sparkSession
    importable(spark)
    vector = F.col(f"`{vector_col}`")
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x.cast("double")) < float("inf"))
    )
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * scale))
    label = F.col("label") if label is None else label
    rows = (
        df.select(
            F.col(f"`{id_col}`").cast("long").alias("id"),
            F.struct(label.cast("long").alias("label"), whole.alias("v")).alias("row"),
            F.coalesce(anchor, F.lit(False)).alias("asks"),
            finite.alias("finite"),
        )
        .filter("id IS NOT NULL AND row.label IS NOT NULL AND finite")
        .groupBy("id")
        .agg(F.min("row").alias("row"), F.max("asks").alias("asks"))
    )
    rows = saved(rows.select("id", "row.label", "row.v", "asks"), "vectors")
    total = rows.agg(F.count("*").alias("rows"), F.count_if("asks").alias("anchors")).first()
    n_rows = max(1, -(-total["rows"] // rows_a_block))
    n_anchors = max(1, -(-total["anchors"] // anchors_a_block))

    blocks = _dealt(rows.select("id", "label", "v"), "c", n_rows).groupBy("c")
    blocks = saved(blocks.applyInArrow(_packed_rows, ROWS), "vector-blocks")
    asking = rows.filter("asks").select("id", "label", "v")
    none = F.expr("CAST(array() AS array<struct<id: bigint, score: bigint>>)")
    first = _dealt(asking.withColumn("positives", none), "a", n_anchors).groupBy("a")
    first = first.applyInArrow(_packed_anchors, ANCHORS)

    counts = n_rows, n_anchors
    met = _meetings(blocks, first, counts, partial(best_positives, n=n_positives), FOUND)
    order = Window.partitionBy("anchor_id").orderBy(F.desc("score"), "id")
    best = met.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= n_positives)
    best = best.groupBy("anchor_id").agg(F.collect_list(F.struct("id", "score")).alias("positives"))
    second = asking.join(best.withColumnRenamed("anchor_id", "id"), "id")
    second = _dealt(second, "a", n_anchors).groupBy("a").applyInArrow(_packed_anchors, ANCHORS)
    second = saved(second, "anchor-blocks")
    found = partial(best_negatives, n=n_negatives, lowest=lowest, highest=highest)
    met = _meetings(blocks, second, counts, found, MINED)
    order = Window.partitionBy("anchor_id", "positive_id").orderBy(F.desc("score"), "id")
    return (
        met.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= n_negatives)
        .select(
            "anchor_id",
            "positive_id",
            "rank",
            F.col("id").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        )
    )

