"""The main text of web pages: boosted trees over the nodes of the page, decoded as a whole.

Each block-level element and each run of text is a node, described by what is in
its subtree (letters, links, marks, tags, their densities), by the words of its
attributes and its ancestors', by depth and place, and by its siblings and
parent. Gradient-boosted trees say how likely there is main text in a node.

Nodes are not judged one by one: text within what is rejected is rejected, and what
holds main text is accepted. Among all choices in which every accepted node's
parent is accepted, the one with the largest sum of log-odds is taken,
computed from the leaves upwards and read from the root down.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlens.llm.common import importable, slices
from freightlens.llm.dom import ROOT, TEXT, Page, parse
from freightlens.llm.page_samples import samples, truth

BINS = 32


@dataclass(frozen=True)
class Trees:
    """Binary trees in heap order; a node without a feature is a leaf. Sums of values are log-odds."""

    feature: np.ndarray  # [tree, node]
    limit: np.ndarray
    value: np.ndarray
    base: float

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        found = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for feature, limit, value in zip(self.feature, self.limit, self.value):
            at = np.zeros(len(x), np.int64)
            while True:
                asked = feature[at]
                inner = asked >= 0
                if not inner.any():
                    break
                right = x[rows, np.maximum(asked, 0)] > limit[at]
                at = np.where(inner, 2 * at + 1 + right, at)
            found += value[at]
        return found


def boosted(
    x: np.ndarray, y: np.ndarray, n_trees: int = 40, depth: int = 5, rate: float = 0.25, least: float = 5.0
) -> Trees:
    """Gradient boosting for the log loss: trees of one depth, on histograms of each feature's quantiles."""
    n, width = x.shape
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS)[1:-1], method="lower")) for f in range(width)]
    binned = np.stack([np.searchsorted(e, x[:, f]) for f, e in enumerate(edges)])
    share = (y.sum() + 1) / (n + 2)
    base = float(np.log(share / (1 - share)))
    margin = np.full(n, base)
    size = 2 ** (depth + 1) - 1
    features, limits, values = (np.full((n_trees, size), v, t) for v, t in ((-1, np.int32), (0, float), (0, float)))
    for t in range(n_trees):
        p = 1 / (1 + np.exp(-margin))
        slope, bend = y - p, np.maximum(p * (1 - p), 1e-9)
        at = np.zeros(n, np.int64)
        for level in range(depth):
            first, many = 2**level - 1, 2**level
            here = np.flatnonzero((at >= first) & (level == 0 or features[t][np.maximum((at - 1) // 2, 0)] >= 0))
            if not len(here):
                break
            local = at[here] - first
            best = np.full(many, 1e-6)
            for f in range(width):
                if not len(edges[f]):
                    continue
                key = local * BINS + binned[f, here]
                g, h = (np.bincount(key, z[here], many * BINS).reshape(many, BINS).cumsum(1) for z in (slope, bend))
                whole_g, whole_h = g[:, -1:], h[:, -1:]
                gain = g**2 / (h + 1) + (whole_g - g) ** 2 / (whole_h - h + 1) - whole_g**2 / (whole_h + 1)
                gain[(h < least) | (whole_h - h < least)] = 0
                gain = gain[:, : len(edges[f])]
                cut = gain.argmax(1)
                top = gain[np.arange(many), cut]
                for k in np.flatnonzero(top > best):
                    best[k], features[t, first + k], limits[t, first + k] = top[k], f, edges[f][cut[k]]
            asked = features[t][at[here]]
            split = asked >= 0
            moved = here[split]
            right = x[moved, asked[split]] > limits[t][at[moved]]
            at[moved] = 2 * at[moved] + 1 + right
        g, h = (np.bincount(at, z, size) for z in (slope, bend))
        values[t] = rate * g / (h + 1)
        margin += values[t][at]
    return Trees(features, limits, values, base)


@dataclass(frozen=True)
class Forest:
    """The nodes of several pages, one page after the other."""

    parent: np.ndarray
    depth: np.ndarray
    levels: list[np.ndarray]  # places of the nodes of each depth
    root: np.ndarray  # of each node
    is_text: np.ndarray

    @classmethod
    def of(cls, pages: Sequence[Page]) -> Forest:
        sizes = np.array([len(p.parent) for p in pages])
        starts = np.cumsum(sizes) - sizes
        parent = np.concatenate([np.array(p.parent) + s for p, s in zip(pages, starts)])
        root = np.repeat(starts, sizes)
        parent[starts] = starts
        depth = np.zeros(len(parent), np.int64)
        for p, s in zip(pages, starts.tolist()):
            own = [0] * len(p.parent)
            for i in range(1, len(own)):
                own[i] = own[p.parent[i]] + 1
            depth[s : s + len(own)] = own
        order = np.argsort(depth, kind="stable")
        levels = np.split(order, np.searchsorted(depth[order], np.arange(1, depth.max(initial=0) + 1)))
        is_text = np.array([t == TEXT for p in pages for t in p.tag])
        return cls(parent, depth, levels, root, is_text)

    def sums(self, own: np.ndarray, add: np.ufunc = np.add) -> np.ndarray:
        """What the subtree of each node adds up to."""
        found = own.astype(float)
        for nodes in self.levels[:0:-1]:
            add.at(found, self.parent[nodes], found[nodes])
        return found

    def inherited(self, own: np.ndarray, join: np.ufunc, start: float = 0.0) -> np.ndarray:
        """The join over all ancestors of each node."""
        found = np.full(len(own), start)
        for nodes in self.levels[1:]:
            up = self.parent[nodes]
            found[nodes] = join(found[up], own[up])
        return found


def token_weights(pages: Sequence[Page], least: int = 4) -> dict[str, float]:
    """How much a tag or an attribute's word speaks for main text: smoothed log-odds over elements."""
    yes, no = Counter(), Counter()
    for page in pages:
        for tag, tokens, good in zip(page.tag, page.tokens, truth(page)):
            if tag not in (TEXT, ROOT):
                (yes if good else no).update([f"<{tag}", *tokens])
    a, b = sum(yes.values()) + 1, sum(no.values()) + 1
    both = [t for t in yes.keys() | no.keys() if yes[t] + no[t] >= least]
    return {t: float(np.log((yes[t] + 0.5) / a) - np.log((no[t] + 0.5) / b)) for t in sorted(both)}


def features(pages: Sequence[Page], forest: Forest, weights: dict[str, float]) -> np.ndarray:
    """[node, feature], see the module."""
    parent, root = forest.parent, forest.root
    n = len(parent)

    def column(values: Iterator) -> np.ndarray:
        return np.fromiter(values, float, n)

    own_chars = column(len(t) for p in pages for t in p.text)
    tag = column(weights.get(f"<{t}", 0.0) for p in pages for t in p.tag)
    found = [[weights.get(t, 0.0) for t in tokens] if tokens else (0.0,) for p in pages for tokens in p.tokens]
    low, high, named = (column(map(f, found)) for f in (min, max, sum))
    chars = forest.sums(own_chars)
    linked = forest.sums(column(x for p in pages for x in p.linked))
    marks = forest.sums(column(x for p in pages for x in p.marks))
    tags = forest.sums(column(x for p in pages for x in p.tags))
    fields = forest.sums(column(x for p in pages for x in p.fields))
    blocks = forest.sums(forest.is_text)
    link_share = linked / np.maximum(chars, 1)
    per_block = np.log1p(chars / np.maximum(blocks, 1))
    total = np.maximum(chars[root], 1)
    before = np.cumsum(own_chars) - own_chars
    before -= before[root]
    # Siblings: in order of the parent, and of the page within it. Roots are their own parents.
    order = np.argsort(parent, kind="stable")
    of = parent[order]
    first = np.searchsorted(of, of)
    count = np.searchsorted(of, of, "right") - first
    place = np.empty(n)
    place[order] = (np.arange(n) - first) / np.maximum(count - 1, 1)
    siblings = np.empty(n)
    siblings[order] = count
    previous, following = np.zeros(n), np.zeros(n)
    alike = of[1:] == of[:-1]
    previous[order[1:]] = np.where(alike, chars[order[:-1]], 0)
    following[order[:-1]] = np.where(alike, chars[order[1:]], 0)
    longest = np.zeros(n)
    np.maximum.at(longest, parent, np.where(parent == np.arange(n), 0, chars))
    return np.stack(
        [
            forest.is_text, forest.depth, np.log1p(chars), link_share, np.log1p(blocks), per_block,
            marks / np.maximum(chars, 1) * 100, np.log1p(chars / (tags + 1)), np.log1p(fields),
            chars / total, before / total, (before + chars) / total, np.log1p(total), link_share[root],
            named, low, high, tag,
            forest.inherited(named, np.add), forest.inherited(low, np.minimum), forest.inherited(high, np.maximum),
            forest.inherited(tag, np.minimum), forest.inherited(tag, np.maximum),
            forest.sums(low, np.minimum), forest.sums(high, np.maximum), forest.sums(tag, np.maximum),
            np.log1p(siblings), place, chars / np.maximum(chars[parent], 1), np.log1p(previous),
            np.log1p(following), np.log1p(longest[parent]), named[parent], tag[parent],
            np.log1p(chars[parent]), link_share[parent], per_block[parent],
        ],
        axis=1,
    ).astype(np.float32)


def accepted(forest: Forest, log_odds: np.ndarray) -> np.ndarray:
    """The nodes with the largest sum of log-odds in which every node's parent is one, too."""
    own = np.where(forest.parent == np.arange(len(log_odds)), 0.0, log_odds)
    best = own.copy()
    for nodes in forest.levels[:0:-1]:
        np.add.at(best, forest.parent[nodes], np.maximum(best[nodes], 0))
    found = np.ones(len(own), bool)
    for nodes in forest.levels[1:]:
        found[nodes] = found[forest.parent[nodes]] & (best[nodes] > 0)
    return found


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    trees: Trees

    def to_json(self) -> str:
        t = self.trees
        return json.dumps(
            {"weights": self.weights, "feature": t.feature.tolist(), "limit": t.limit.tolist(),
             "value": t.value.tolist(), "base": t.base}
        )

    @classmethod
    def of_json(cls, text: str) -> Model:
        x = json.loads(text)
        return cls(x["weights"], Trees(*(np.array(x[k]) for k in ("feature", "limit", "value")), x["base"]))

    def main_blocks(self, pages: Sequence[Page]) -> list[list[str]]:
        """The blocks of main text of each page, in page order."""
        forest = Forest.of(pages)
        kept = accepted(forest, self.trees.log_odds(features(pages, forest, self.weights)))
        found, at = [], 0
        for page in pages:
            own = kept[at : at + len(page.tag)]
            at += len(page.tag)
            found.append([t for t, k in zip(page.text, own.tolist()) if t and k])
        return found


def fitted(pages: Sequence[Page]) -> Model:
    """The model learnt from pages whose main text is marked."""
    if not pages:
        none = np.zeros((0, 1))
        return Model({}, Trees(none, none, none, base=-1.0))
    weights = token_weights(pages)
    x = features(pages, Forest.of(pages), weights)
    y = np.array([good for page in pages for good in truth(page)], float)
    return Model(weights, boosted(x, y))


def train(
    df: DataFrame,
    id_col: str = "page_id",
    html_col: str = "html",
    most_pages: int = 400,
    layouts: int = 3,
) -> Model:
    """A model learnt from the ``most_pages`` pages with the lowest hash of their id.

    Of rows with one id, one page counts; pages without an id go by their own hash. The texts of each are laid out ``layouts`` times anew (see page_samples.py). One task
    learns from this bounded sample, and only the model reaches the driver. Null
    and empty pages are not chosen; without any page, a model that accepts nothing.
    """
    importable(df.sparkSession)
    html = F.col(f"`{html_col}`").cast("string")
    placed = (
        df.select(F.col(f"`{id_col}`").cast("string").alias("id"), html.alias("html"))
        .filter("html IS NOT NULL AND length(html) > 0")
        .select(F.expr("if(id IS NULL, xxhash64(html), xxhash64(id))").alias("place"), "html")
    )
    # Only about four times the pages that are wanted leave their partitions.
    pages = placed.agg(F.approx_count_distinct("place")).first()[0]
    last = -(2**63) + int(2**64 * min(1.0, 4 * most_pages / max(1, pages))) - 1
    chosen = (
        placed.filter(F.col("place") <= last)
        .groupBy("place")
        .agg(F.max("html").alias("html"))
        .orderBy("place")
        .limit(most_pages)
    )

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pages = []
        for batch in batches:
            for place, text in zip(batch.column("place").to_pylist(), batch.column("html").to_pylist()):
                pages += samples(text, place, layouts)
        if pages:
            yield pa.RecordBatch.from_pydict({"model": [fitted(pages).to_json()]})

    rows = chosen.coalesce(1).mapInArrow(learn, "model string").collect()
    return Model.of_json(rows[0]["model"]) if rows else fitted([])


def extract(
    df: DataFrame,
    model: Model,
    id_col: str = "page_id",
    html_col: str = "html",
    keep: Sequence[str] = ("url",),
) -> DataFrame:
    """page_id, the columns of ``keep``, and the main text of each page: ``text``, ``n_chars``, ``n_blocks``.

    Character references are decoded, white space within a block is one space, and
    blocks are joined by an empty line. Nothing is cut. A null or empty
    page, and one without main text, has the empty text. Each row is
    judged by itself, so repeated and null ids do not matter; other columns may have any name.
    """
    importable(df.sparkSession)
    names = [f"c{i}" for i in range(len(keep))]
    rows = df.select(
        F.col(f"`{id_col}`").alias("id"),
        *[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names)],
        F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")).alias("html"),
    )
    plain = rows.drop("html")
    schema = plain.withColumn("text", F.lit("")).withColumn("n_blocks", F.lit(0)).schema
    shared = model.to_json()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model.of_json(shared)
        for batch in batches:
            for cut in slices(batch, "html", 2 << 20):
                found = own.main_blocks([parse(x) for x in cut.column("html").to_pylist()])
                texts = pa.array(["\n\n".join(x) for x in found], pa.string())
                counts = pa.array(list(map(len, found)), pa.int32())
                names = [*cut.schema.names[:-1], "text", "n_blocks"]
                yield pa.RecordBatch.from_arrays([*cut.columns[:-1], texts, counts], names=names)

    found = rows.mapInArrow(run, schema)
    return found.select(
        F.col("id").alias(id_col),
        *[F.col(n).alias(c) for c, n in zip(keep, names)],
        "text",
        F.char_length("text").cast("long").alias("n_chars"),
        "n_blocks",
    )
