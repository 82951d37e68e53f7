"""Near-duplicate embeddings by an inverted multi-index.

Vectors are scaled to unit length and cut into halves. Each half has a codebook
of its own, so the product of both is a grid of cells, and every vector lives in
one. From a vector to a cell there is a least distance for each half: that to the plane between
the cell's codeword and any other. A vector visits cells in the order of
the sum of both, until the target recall is reached on a sample; for a target of
one, until the sum shows that no vector within the radius is left. What it meets
there is verified.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from freightlens.llm.common import importable, partitions, saved
from freightlens.llm.components import components

#: Rows that live in one cell and are compared in one task.
BLOCK = 2048
#: Visitors compared with them at once.
STEP = 2048
#: Values, not rows, of the sample that codebooks are fitted to.
SAMPLE_VALUES = 2_000_000
#: Rows of the sample whose neighbours say how far the traversal must go.
CALIBRATED = 2_000


def codebook(points: np.ndarray, size: int, rounds: int = 12, seed: int = 0) -> np.ndarray:
    """At most ``size`` centroids of the points, by Lloyd's rounds."""
    order = np.random.default_rng(seed)
    found = np.unique(points, axis=0)
    found = found[order.permutation(len(found))[:size]]
    for _ in range(rounds):
        near = _squares(points, found).argmin(axis=1)
        count = np.bincount(near, minlength=len(found))
        total = np.zeros_like(found)
        np.add.at(total, near, points)
        found[count > 0] = total[count > 0] / count[count > 0, None]
    return np.unique(found, axis=0)


def _squares(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances of all rows of x from all rows of c."""
    return np.maximum((x * x).sum(1)[:, None] + (c * c).sum(1)[None] - 2 * x @ c.T, 0)


def least_squares_to(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(nearest codeword, lower bounds of the squared distance to each codeword's region)."""
    square = _squares(x, c)
    gap = np.sqrt(_squares(c, c))
    bound = np.zeros_like(square)
    for j in range(len(c)):
        with np.errstate(divide="ignore", invalid="ignore"):
            to_plane = (square - square[:, j : j + 1]) / (2 * gap[:, j])
        bound = np.maximum(bound, np.where(gap[:, j] > 0, to_plane, 0))
    return square.argmin(axis=1), bound**2


def visits(first: np.ndarray, second: np.ndarray, limit: float) -> list[tuple[int, int]]:
    """The cells in which both bounds add up to ``limit`` at most, as the traversal meets them.

    For each codeword of the first half, in rising order, the codewords of the second
    follow as far as the limit goes.
    """
    by_first, by_second = np.argsort(first), np.argsort(second)
    sorted_second = second[by_second]
    found = []
    for i in by_first:
        if first[i] > limit:
            break
        n = np.searchsorted(sorted_second, limit - first[i], side="right")
        found += [(int(i), int(j)) for j in by_second[:n]]
    return found


def _unit(vectors: list[bytes], kind: str) -> np.ndarray:
    """The vectors in double precision, scaled to unit length."""
    x = np.stack([np.frombuffer(v, kind) for v in vectors]).astype(np.float64)
    x = x / np.abs(x).max(axis=1)[:, None]  # squares of very large or small values
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


class Index:
    """The codebooks of vectors of one length, and how far to go for a link."""

    def __init__(
        self, sample: np.ndarray, cells_per_half: int, radius2: float, target_recall: float
    ) -> None:
        half = sample.shape[1] // 2
        self.half = half
        self.books = codebook(sample[:, :half], cells_per_half), codebook(
            sample[:, half:], cells_per_half
        )
        # Rounding must not lose a link.
        self.limit = radius2 + 1e-9
        if target_recall < 1:
            self.limit = self._calibrated(sample, radius2, target_recall)

    def bounds(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(home cell, bounds of the first half, bounds of the second half) of each vector."""
        i, first = least_squares_to(x[:, : self.half], self.books[0])
        j, second = least_squares_to(x[:, self.half :], self.books[1])
        return i * len(self.books[1]) + j, first, second

    def _calibrated(self, sample: np.ndarray, radius2: float, target_recall: float) -> float:
        """The bound within which the target share of links is met.

        It must hold for the sample's own links, and for neighbours of the
        sample in random directions as far off as a link allows, which are the
        hardest to meet.
        """
        home, first, second = self.bounds(sample)
        order = np.random.default_rng(0)
        some = order.permutation(len(sample))[:CALIBRATED]
        x = sample[some]
        aside = order.normal(size=x.shape)
        aside -= (aside * x).sum(axis=1)[:, None] * x
        aside /= np.sqrt((aside * aside).sum(axis=1))[:, None]
        cosine = 1 - radius2 / 2
        far, _, _ = self.bounds(cosine * x + np.sqrt(max(0.0, 1 - cosine**2)) * aside)
        i, j = np.divmod(far, len(self.books[1]))
        needed = [first[some, i] + second[some, j]]
        own = []
        for at in range(0, len(some), 256):
            near = 2 - 2 * x[at : at + 256] @ sample.T <= radius2
            row, other = np.nonzero(near)
            row = some[row + at]
            row, other = row[row != other], other[row != other]
            i, j = np.divmod(home[other], len(self.books[1]))
            own.append(first[row, i] + second[row, j])
        needed.append(np.concatenate(own))
        found = [np.quantile(x, target_recall, method="higher") for x in needed if len(x)]
        return float(min(radius2 + 1e-9, max(found) + 1e-9))


def _meetings(classes: DataFrame, indexes: dict[int, Index], kind: str) -> DataFrame:
    """(label, dim, cell, home, node, code, copies, vector) for every cell a class visits.

    Of two classes in different cells the one in the lower cell visits the other.
    """
    sent = classes.sparkSession.sparkContext.broadcast(indexes)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                row, cell, home = _cells_of(part, sent.value, kind)
                yield pa.RecordBatch.from_arrays(
                    [part.column(c).take(row) for c in own] + [cell, home],
                    [*own, "cell", "home"],
                )

    own = ["label", "dim", "node", "code", "copies", "vector"]
    kinds = (
        "label string, dim int, node long, code long, copies long, vector binary, "
        "cell int, home boolean"
    )
    return classes.mapInArrow(run, kinds)


def _cells_of(
    part: pa.RecordBatch, indexes: dict[int, Index], kind: str
) -> tuple[pa.Array, pa.Array, pa.Array]:
    """(row of the batch, cell, whether it is home) for all visits of a batch."""
    rows, cells, homes = [], [], []
    dims = part.column("dim").to_numpy()
    for dim in np.unique(dims):
        own = np.flatnonzero(dims == dim)
        if dim not in indexes:
            # No codebook: one cell holds all vectors of this length.
            rows += own.tolist()
            cells += [0] * len(own)
            homes += [True] * len(own)
            continue
        index = indexes[dim]
        vectors = part.column("vector").take(pa.array(own)).to_pylist()
        home, first, second = index.bounds(_unit(vectors, kind))
        width = len(index.books[1])
        for k, r in enumerate(own.tolist()):
            there = {i * width + j for i, j in visits(first[k], second[k], index.limit)}
            there = [c for c in there if c > home[k]] + [int(home[k])]
            rows += [r] * len(there)
            cells += there
            homes += [False] * (len(there) - 1) + [True]
    return pa.array(rows, pa.int64()), pa.array(cells, pa.int32()), pa.array(homes, pa.bool_())


class _Cell:
    """The rows that live in a block of a cell, and the links that visitors find to them."""

    def __init__(self, least_cosine: float, kind: str) -> None:
        self.least, self.kind = least_cosine, kind
        self.node: list[int] = []
        self.code: list[int] = []
        self.copies: list[int] = []
        self.vectors: list[bytes] = []
        self.unit: np.ndarray | None = None

    def add(self, rows: list[dict]) -> None:
        for r in rows:
            self.node.append(r["node"])
            self.code.append(r["code"])
            self.copies.append(r["copies"])
            self.vectors.append(r["vector"])

    def ready(self) -> None:
        self.unit = _unit(self.vectors, self.kind)
        self.weight = np.array(self.copies, np.float64)
        self.found = np.zeros(len(self.node))
        self.group = np.arange(len(self.node))  # homes known to be connected

    def meet(self, unit: np.ndarray, weight: np.ndarray, after: int | None = None):
        """(links of each visitor, pairs (visitor, home) and (home, home) that connect them).

        With ``after`` the visitors are the homes from that one on, and each
        looks at those behind it only.
        """
        near = unit @ self.unit.T >= self.least
        if after is not None:
            near &= np.arange(len(self.node))[None, :] > (np.arange(len(unit)) + after)[:, None]
        self.found += weight @ near
        outer, inner = [], []
        for k in np.flatnonzero(near.any(axis=1)):
            groups = np.unique(self.group[near[k]])
            if after is not None:
                groups = np.unique(np.append(groups, self.group[k + after]))
            else:
                outer.append((int(k), int(groups[0])))
            if len(groups) > 1:
                inner += [(int(groups[0]), int(g)) for g in groups[1:]]
                self.group[np.isin(self.group, groups)] = groups[0]
        return near @ self.weight, outer, inner


FOUND = "node long, code long, n long, other long"


def _compare(least_cosine: float, kind: str):
    """Stream each meeting: first the rows that live there, then their visitors."""

    schema = pa.schema([(c, pa.int64()) for c in ("node", "code", "n", "other")])

    def rows_of(nodes, codes, counts) -> list[dict]:
        return [
            {"node": a, "code": c, "n": int(n), "other": None}
            for a, c, n in zip(nodes, codes, counts)
            if n
        ]

    def links(pairs) -> list[dict]:
        return [{"node": a, "code": None, "n": None, "other": b} for a, b in pairs if a != b]

    def visit(cell: _Cell, rows: list[dict]) -> list[dict]:
        weight = np.array([r["copies"] for r in rows], np.float64)
        counts, outer, inner = cell.meet(_unit([r["vector"] for r in rows], kind), weight)
        node = cell.node
        return (
            rows_of([r["node"] for r in rows], [r["code"] for r in rows], counts)
            + links((rows[k]["node"], node[h]) for k, h in outer)
            + links((node[a], node[b]) for a, b in inner)
        )

    def settle(cell: _Cell) -> list[dict]:
        cell.ready()
        out = []
        for at in range(0, len(cell.node), STEP):
            own = slice(at, at + STEP)
            counts, _, inner = cell.meet(cell.unit[own], cell.weight[own], at)
            cell.found[own] += counts
            out += links((cell.node[a], cell.node[b]) for a, b in inner)
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, cell, out = None, None, []
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                part = batch.slice(at, STEP).to_pylist()
                i = 0
                while i < len(part):
                    if part[i]["meeting"] != key:
                        if cell and cell.node:
                            if cell.unit is None:
                                out += settle(cell)
                            out += rows_of(cell.node, cell.code, cell.found)
                        key, cell = part[i]["meeting"], _Cell(least_cosine, kind)
                    j = i
                    home = part[i]["home"]
                    while j < len(part) and part[j]["meeting"] == key and part[j]["home"] == home:
                        j += 1
                    if home:
                        cell.add(part[i:j])
                    elif cell.node:
                        if cell.unit is None:
                            out += settle(cell)
                        out += visit(cell, part[i:j])
                    i = j
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=schema)
                    out = []
        if cell and cell.node:
            if cell.unit is None:
                out += settle(cell)
            out += rows_of(cell.node, cell.code, cell.found)
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run


def _fitted(
    classes: DataFrame, cells_per_half: int, radius2: float, target_recall: float, kind: str
) -> dict[int, Index]:
    """An index for each vector length, fitted to a sample of at most ``SAMPLE_VALUES`` values."""
    longest = classes.agg(F.max("dim")).first()[0]
    if not longest:
        return {}
    rows = max(cells_per_half, SAMPLE_VALUES // longest)
    sample = classes.orderBy("code", "node").limit(rows).select("dim", "vector").toArrow()
    dims = sample.column("dim").to_numpy()
    indexes = {}
    for dim in np.unique(dims):
        if dim >= 2:
            own = sample.filter(pa.array(dims == dim)).column("vector").to_pylist()
            indexes[int(dim)] = Index(_unit(own, kind), cells_per_half, radius2, target_recall)
    return indexes


def near_duplicates(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    least_cosine: float = 0.93,
    cells_per_half: int = 16,
    target_recall: float = 0.9995,
) -> DataFrame:
    """One row per input row: vec_id, n_links, component_id, kept.

    Vectors link if their labels are equal and their cosine, in double
    precision, is at least ``least_cosine``. ``n_links`` counts the other rows
    linked directly, ``component_id`` is the smallest vec_id reachable, and
    ``kept`` says whether it is the row's own. With ``target_recall`` 1 the
    traversal ends where the bounds prove that no link is left; below, where
    that share of the links of a bounded sample is met, counted for neighbours
    at the least cosine, the hardest to meet.

    Null vectors, zero vectors, vectors with null or non-finite components, null labels and
    null ids link with nothing; such a row is its own component. Vectors of different lengths
    do not link. Equal vectors are compared once, as a class with a count. Rows
    that repeat a vec_id are vectors of their own that share its component. An
    empty table gives no rows; other columns are not read.
    """
    importable(df.sparkSession)
    rows = df.select(
        F.col(f"`{id_col}`").cast("long").alias("vec_id"),
        F.col(f"`{label_col}`").cast("string").alias("label"),
        F.col(f"`{vector_col}`").cast("array<double>").alias("vector"),
    )
    usable = F.expr(
        "vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL AND size(vector) > 0 "
        "AND NOT exists(vector, x -> x IS NULL OR isnan(x) OR abs(x) = double('Infinity')) "
        "AND exists(vector, x -> x <> 0)"
    )
    # The exact bytes tell classes apart; the hashes stand for them in later joins.
    keyed = rows.select(
        "vec_id",
        "label",
        "vector",
        F.coalesce(usable, F.lit(False)).alias("usable"),
        F.xxhash64("label", "vector").alias("code"),
        F.hash("vector", "label").alias("check"),
    )
    classes = (
        keyed.filter("usable")
        .groupBy("label", "code", "check")
        .agg(
            F.min("vec_id").alias("node"),
            F.count("*").alias("copies"),
            F.first("vector").alias("vector"),
        )
    )
    # Single precision is sent as such and widened before anything is computed.
    single = df.schema[vector_col].dataType == T.ArrayType(T.FloatType())
    kind = "<f4" if single else "<f8"
    classes = saved(_as_bytes(classes, kind), "vector-classes")
    indexes = _fitted(classes, cells_per_half, 2 - 2 * least_cosine, target_recall, kind)
    meetings = _meetings(classes, indexes, kind)
    place = ["label", "dim", "cell"]
    large = (
        meetings.filter("home")
        .groupBy(*place)
        .agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
        .filter("blocks > 1")
    )
    # A home visits the blocks behind its own; other visitors go to each block.
    own = F.when(F.col("home"), F.expr("pmod(code, blocks)")).otherwise(F.lit(0))
    spread = (
        meetings.join(large, place, "left")
        .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("own", own.cast("int"))
        .withColumn("block", F.explode(F.expr("sequence(own, blocks - 1)")))
        .select(
            F.concat_ws(":", *place, "block").alias("meeting"),
            (F.col("home") & (F.col("own") == F.col("block"))).alias("home"),
            "node",
            "code",
            "copies",
            "vector",
        )
    )
    found = saved(
        spread.repartition(partitions(df.sparkSession), "meeting")
        .sortWithinPartitions("meeting", F.desc("home"))
        .mapInArrow(_compare(least_cosine, kind), FOUND),
        "vector-links",
    )
    counts = (
        found.filter("other IS NULL").groupBy("node", "code").agg(F.sum("n").alias("others"))
    )
    roots = components(found.filter("other IS NOT NULL").selectExpr("node AS a", "other AS b"))
    result = (
        classes.select("label", "code", "check", "node", "copies")
        .join(counts, ["node", "code"], "left")
        .join(roots, "node", "left")
        .select(
            F.col("label").alias("_label"),
            F.col("code").alias("_code"),
            F.col("check").alias("_check"),
            (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("links"),
            F.coalesce("root", "node").alias("smallest"),
        )
    )
    same = F.expr("usable AND label = _label AND code = _code AND check = _check")
    smallest = F.coalesce("smallest", "vec_id")
    return keyed.drop("vector").join(result, same, "left").select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        smallest.alias("component_id"),
        F.col("vec_id").eqNullSafe(smallest).alias("kept"),
    )


def _as_bytes(classes: DataFrame, kind: str) -> DataFrame:
    """The classes with their vectors as bytes and ``dim``, their length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = (x.values for x in batch.column("vector"))
            vectors = [x.to_numpy(zero_copy_only=False).astype(kind) for x in lists]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("label", "code", "check", "node", "copies")]
                + [
                    pa.array([len(v) for v in vectors], pa.int32()),
                    pa.array([v.tobytes() for v in vectors], pa.binary()),
                ],
                ["label", "code", "check", "node", "copies", "dim", "vector"],
            )

    kinds = "label string, code long, check int, node long, copies long, dim int, vector binary"
    return classes.mapInArrow(run, kinds)
