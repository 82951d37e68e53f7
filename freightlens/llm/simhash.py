"""SimHash near-duplicates by segment popcounts.

A fingerprint's bits are counted in short segments. Two fingerprints that differ
in d bits have count vectors at a Manhattan distance of at most d, so a range join
of the vectors finds every pair, and the exact distance is checked after it. The
vector is cut into ``BANDS`` parts. A pair within ``max_bits`` is within
``max_bits // BANDS`` in one part at least, and so lies in the same or
in neighbouring cells of that part's unit grid.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlens.llm.common import free_name, groups, importable, partitions, saved, slices, texts
from freightlens.llm.components import components
from freightlens.llm.exact_dedup import _row_key

SEED = 42
SEGMENT, SEGMENTS = 2, 32  # bits of a segment, segments of a fingerprint
#: First and last segment of each part of the vector.
BAND_ENDS = ((0, 11), (11, 22), (22, 32))
BANDS = len(BAND_ENDS)
#: Members and visitors of a cell are compared in blocks of at most so many rows.
BLOCK = 4096


def fingerprint(text: bytes, words: int = 4) -> int:
    """The SimHash of the text's shingles of ``words`` words; 0 without words."""
    import xxhash

    found = text.lower().split()  # of bytes: A-Z only, and ASCII white space only
    if not found:
        return 0
    joined = b" ".join(found)
    sizes = np.fromiter(map(len, found), np.int64, len(found))
    ends = np.cumsum(sizes + 1) - 1
    starts = ends - sizes
    n = max(1, len(found) - words + 1)
    ends = ends[-n:]
    hashes = np.fromiter(
        (xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts[:n].tolist(), ends.tolist())),
        np.uint64,
        n,
    )
    ones = np.zeros(64, np.int64)
    for i in range(0, n, 65_536):
        bits = np.unpackbits(hashes[i : i + 65_536].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(ones * 2 > n).tobytes(), "big")


def fingerprints(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 4,
    more: str | None = None,
) -> DataFrame:
    """(doc_id, fp) of every row; fp is the fingerprint as a signed 64-bit integer.

    ``more`` names a column of strings to pass on.
    """
    docs = texts(df, id_col, text_col) if more is None else df.select("doc_id", "text", more)
    docs = docs.withColumn("text", F.col("text").cast("binary"))
    passed = [] if more is None else [more]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                found = [fingerprint(t, words) for t in part.column("text").to_pylist()]
                fp = pa.array(np.array(found, np.uint64).view(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), fp, *map(part.column, passed)],
                    ["doc_id", "fp", *passed],
                )

    return docs.mapInArrow(run, ", ".join(["doc_id long, fp long", *(f"{c} string" for c in passed)]))


def popcounts(fps: np.ndarray) -> np.ndarray:
    """The ones in each segment of each fingerprint: rows × SEGMENTS."""
    shifts = np.arange(SEGMENTS, dtype=np.uint64) * np.uint64(SEGMENT)
    parts = (fps.astype(np.uint64)[:, None] >> shifts) & np.uint64(3)
    return np.bitwise_count(parts).astype(np.int64)


def _moves(dims: int, radius: int) -> np.ndarray:
    """All steps in the grid of at most ``radius`` in Manhattan distance."""
    found = [np.zeros(dims, np.int64)]
    for used in range(1, min(radius, dims) + 1):
        for at in combinations(range(dims), used):
            for by in product(*[[d for d in range(-radius, radius + 1) if d]] * used):
                if sum(map(abs, by)) <= radius:
                    move = np.zeros(dims, np.int64)
                    move[list(at)] = by
                    found.append(move)
    return np.array(found)


def cells(fps: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, bool, np.ndarray]]:
    """(cell, whether it is home, index of the fingerprint) for all cells of each.

    Of two neighbouring cells only the lower one's points visit the other.
    """
    counts = popcounts(fps)
    index = np.arange(len(fps))
    for band, (a, b) in enumerate(BAND_ENDS):
        weights = 3 ** np.arange(b - a, dtype=np.int64)
        home = counts[:, a:b] @ weights
        for move in _moves(b - a, radius):
            step = int(move @ weights)
            there = counts[:, a:b] + move
            inside = ((there >= 0) & (there <= SEGMENT)).all(axis=1)
            if step >= 0:
                yield (home + step)[inside] * BANDS + band, step == 0, index[inside]


def spanning_links(fps: np.ndarray, home: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Links that connect all that is linked with a row at home, fewer than there are rows."""
    linked = np.zeros(len(fps), bool)
    own = fps[home]
    for i in range(0, len(own), 512):
        near = np.bitwise_count(own[i : i + 512, None] ^ fps[None, :]) <= max_bits
        if near.sum() > len(near):  # more than each with itself
            linked |= near[near.sum(axis=1) > 1].any(axis=0)
    left, links = fps[linked], []
    while len(left):
        reached, left = [left[0]], left[1:]
        while reached and len(left):
            x = reached.pop()
            near = np.bitwise_count(left ^ x) <= max_bits
            if near.any():
                found = left[near]
                links += [(int(x), int(y)) for y in found]
                reached += list(found)
                left = left[~near]
    return links


def _visits(nodes: DataFrame, radius: int) -> DataFrame:
    """(cell, home, fp): every fingerprint in its cells and in those it visits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column("fp").to_numpy(zero_copy_only=False)
            for cell, home, index in cells(fps.view(np.uint64), radius):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell), pa.array(np.full(len(cell), home)), pa.array(fps[index])],
                    ["cell", "home", "fp"],
                )

    return nodes.select("fp").mapInArrow(run, "cell long, home boolean, fp long")


def links(nodes: DataFrame, max_bits: int = 4) -> DataFrame:
    """(a, b): links between distinct fingerprints (column fp) that connect all within ``max_bits``.

    A cell's rows are compared in blocks. A cell with more than ``BLOCK`` rows is
    dealt over several blocks, and every two blocks of it meet in a task of their own. Of
    each meeting only a spanning forest is returned, never all its pairs.
    """
    visits = _visits(nodes, max_bits // BANDS)
    sizes = visits.groupBy("cell").agg(F.count("*").alias("n"))
    large = sizes.filter(F.col("n") > BLOCK).select(
        "cell", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")
    )
    own = "CAST(pmod(xxhash64(fp, 7), blocks) AS INT)"
    meetings = (
        visits.join(large, "cell", "left")
        .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("own", F.expr(own))
        .withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)")))
        .selectExpr("xxhash64(cell, least(own, other), greatest(own, other)) AS meeting", "home", "fp")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for home, fps in groups(batches, "meeting", "home", "fp"):
            if len(fps) > 1:
                found = spanning_links(fps.view(np.uint64), home, max_bits)
                if found:
                    ends = np.array(found, np.uint64).view(np.int64)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ends[:, 0]), pa.array(ends[:, 1])], ["a", "b"]
                    )

    return (
        meetings.repartition(partitions(nodes.sparkSession), "meeting")
        .sortWithinPartitions("meeting")
        .mapInArrow(run, "a long, b long")
    )


def near_duplicates(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 4,
    max_bits: int = 4,
) -> DataFrame:
    """One row per input row: doc_id, fingerprint (16 hex digits), component_id.

    component_id is the smallest doc_id reachable over links of at most
    ``max_bits`` differing bits. Every such link is found. Texts without words,
    nulls among them, have fingerprint zero and link like any other; a text
    shorter than ``words`` words is one shingle. Rows that repeat a doc_id count
    one by one. Null doc_ids are grouped too, but name a component only if it
    has no other id, as null. An empty table gives no rows; other columns are
    not read.
    """
    rows = saved(fingerprints(df, id_col, text_col, words), "fingerprints")
    nodes = rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    grouped = _rooted(nodes, max_bits)
    smallest = grouped.groupBy("root").agg(F.min("first_id").alias("component_id"))
    classes = grouped.join(smallest, "root").select("fp", "component_id")
    return rows.join(classes, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _rooted(nodes: DataFrame, max_bits: int) -> DataFrame:
    """The distinct fingerprints (column fp) with ``root``, the same for all of a group."""
    roots = components(links(nodes, max_bits))
    return nodes.join(roots, nodes.fp == roots.node, "left").select(
        *nodes.columns, F.coalesce("root", "fp").alias("root")
    )


def without_near_duplicates(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 4,
    max_bits: int = 4,
) -> DataFrame:
    """The rows, with all their columns, that stay: exactly one of each group.

    It is the one with the smallest doc_id, and of rows that repeat it the one with the
    smallest digest of its text. A row is known by both, so rows of other groups
    that repeat its doc_id stay or go by themselves. A null doc_id stays only if its
    group has no other. Columns may have any name and are all kept; a table without rows gives none.
    """
    name = free_name(df, "__kept")
    importable(df.sparkSession)
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    key = _row_key(F.col(f"`{id_col}`").cast("long"), F.sha2(F.encode(text, "UTF-8"), 256))
    keyed = df.withColumn(name, key)
    named = keyed.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), text.alias("text"), F.col(name).alias("key")
    )
    rows = saved(fingerprints(named, words=words, more="key"), "fingerprints")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key"))
    nodes = rows.groupBy("fp").agg(first.alias("first"))
    stay = _rooted(nodes, max_bits).groupBy("root").agg(F.min("first").alias("first"))
    stay = stay.select(F.col("first.key").alias(name))
    # The join leaves the rows where dropDuplicates needs them.
    return keyed.join(stay, name, "left_semi").dropDuplicates([name]).drop(name)
