"""Quality classifier: Naive Bayes log-count ratios under a linear support vector machine.

The features of a text are indicators: its words, its pairs of words, and the 1- to
3-grams of its words' shapes (case, marks, and whether a word repeats the one before),
each hashed to a bucket. An indicator is scaled by the log ratio of its smoothed shares in
the two classes. A linear model with L2-regularised hinge loss is fitted to the scaled
indicators by dual coordinate descent.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from freightlens.llm.chunks import Memory
from freightlens.llm.common import importable, slices, texts

WORDS, PAIRS, SHAPES = 1 << 18, 1 << 19, 1 << 17
BUCKETS = WORDS + PAIRS + SHAPES
_LETTERS = re.compile(r"[^\W\d_]+")
_DIGITS = re.compile(r"\d+")
_REPEAT = zlib.crc32(b"=")
_MIX = np.uint64(0x9E3779B97F4A7C15)


def shape(word: str) -> str:
    """The word with letters and digits masked, which leaves its case and its marks."""

    def case(m: re.Match) -> str:
        x = m[0]
        return "A" if x.isupper() and len(x) > 1 else "B" if x[0].isupper() else "a"

    return _DIGITS.sub("0", _LETTERS.sub(case, word))[:16]


def _codes(word: str) -> int:
    """The hash of the word and, above it, that of its shape."""
    return zlib.crc32(word.encode()) | zlib.crc32(shape(word).encode()) << 32


def known_words() -> Memory:
    """word → its codes; one for each task, so that no worker keeps it for other stages."""
    return Memory(_codes, 150_000)


def _spread(x: np.ndarray, buckets: int, first: int) -> np.ndarray:
    x = x * _MIX
    return ((x ^ (x >> np.uint64(29))) % np.uint64(buckets)).astype(np.int64) + first


def features(text: str, known: Memory) -> np.ndarray:
    """The buckets of the text's indicators, each once, ascending."""
    words = text.split()
    if not words:
        return np.zeros(0, np.int64)
    codes = np.array([known[w] for w in words], np.uint64)
    w, s = codes & np.uint64(0xFFFFFFFF), codes >> np.uint64(32)
    s[1:][w[1:] == w[:-1]] = _REPEAT
    two, ten = np.uint64(0x100000001B3), np.uint64(0xC2B2AE3D27D4EB4F)
    found = [
        _spread(w, WORDS, 0),
        _spread(w[:-1] * two + w[1:], PAIRS, WORDS),
        _spread(s, SHAPES, WORDS + PAIRS),
        _spread(s[:-1] * two + s[1:], SHAPES, WORDS + PAIRS),
        _spread(s[:-2] * ten + s[1:-1] * two + s[2:], SHAPES, WORDS + PAIRS),
    ]
    return np.unique(np.concatenate(found))


@dataclass(frozen=True)
class Model:
    """A weight for each bucket, and the share of the good class where nothing else is known."""

    weights: np.ndarray
    bias: float

    def margin(self, found: np.ndarray) -> float:
        return float(self.weights[found].sum(dtype=np.float64)) + self.bias

    def score(self, text: str, known: Memory) -> float:
        margin = self.margin(features(text, known))
        return float(1.0 / (1.0 + np.exp(-np.clip(2.0 * margin, -50, 50))))


def fit(
    rows: list[np.ndarray],
    labels: np.ndarray,
    smoothing: float = 1.0,
    cost: float = 0.05,
    least_texts: int = 5,
    rounds: int = 30,
    seed: int = 0,
) -> Model:
    """Scale by log-count ratios, then dual coordinate descent on the hinge loss.

    Without rows, or with one class only, every text gets the share of the good
    class with one row of each class added.
    """
    good, n = labels == 1, len(labels)
    share = (good.sum() + 1) / (n + 2)
    empty = Model(np.zeros(BUCKETS, np.float32), float(np.log(share / (1 - share)) / 2))
    if n == 0 or good.all() or not good.any():
        return empty
    counts = np.zeros((2, BUCKETS), np.int32)
    for r, k in zip(rows, labels):
        counts[k, r] += 1  # a row has each bucket once
    ratio = np.log((counts[1] + smoothing) / (good.sum() + 2 * smoothing))
    ratio -= np.log((counts[0] + smoothing) / ((~good).sum() + 2 * smoothing))
    ratio[counts.sum(axis=0) < least_texts] = 0.0
    rows = [r[ratio[r] != 0] for r in rows]
    y = np.where(good, 1.0, -1.0)
    # Each class counts as much as the other; the bias is one more indicator.
    most = np.where(good, n / (2 * good.sum()), n / (2 * (~good).sum())) * cost
    square = np.array([(ratio[r] ** 2).sum() + 1.0 for r in rows])
    w, bias, alpha = np.zeros(BUCKETS), 0.0, np.zeros(n)
    order = np.random.default_rng(seed)
    for _ in range(rounds):
        moved = 0.0
        for i in order.permutation(n):
            r = rows[i]
            x = ratio[r]
            slope = y[i] * (w[r] @ x + bias) - 1.0
            step = min(max(alpha[i] - slope / square[i], 0.0), most[i]) - alpha[i]
            if step:
                alpha[i] += step
                w[r] += step * y[i] * x
                bias += step * y[i]
                moved = max(moved, abs(step) * square[i])
        if moved < 1e-3:
            break
    return Model((w * ratio).astype(np.float32), float(bias))


def train(
    df: DataFrame,
    labels: DataFrame,
    label_col: str = "quality",
    id_col: str = "doc_id",
    text_col: str = "text",
    most_rows: int = 6000,
) -> Model:
    """Fit the model to at most ``most_rows`` labelled rows, those with the lowest hash of their id.

    That bound also holds for what reaches the driver: the buckets of these rows,
    not their texts. Rows whose crc32(doc_id as text) mod 3 is 1 are never
    learned from. Null ids and labels other than 0 and 1 are left out; of several labels of an
    id the largest counts, of several texts the last in order. Without labelled rows the model has no
    opinion: every score is a half.
    """
    one_each = (
        labels.select(
            F.col(f"`{id_col}`").cast("long").alias("doc_id"),
            F.col(f"`{label_col}`").cast("int").alias("label"),
        )
        .filter("doc_id IS NOT NULL AND label IN (0, 1)")
        .filter(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(most_rows)
    )
    # One row of each id, so that repeated ids do not raise the bound.
    chosen = (
        texts(df, id_col, text_col)
        .join(F.broadcast(one_each), "doc_id")
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"), F.max("text").alias("text"))
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = known_words()
        for batch in batches:
            for part in slices(batch, "text"):
                text = part.column("text").to_pylist()
                found = [features(t, known).astype(np.int32) for t in text]
                found = pa.array(found, pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("label"), found],
                    ["doc_id", "label", "found"],
                )

    table = chosen.mapInArrow(run, "doc_id long, label int, found array<int>").toArrow()
    # Views of the table, not copies: this is all that the driver holds of the sample.
    rows = [np.asarray(x.values) for x in table.column("found")]
    order = np.argsort(table.column("doc_id").to_numpy(), kind="stable")
    labels = table.column("label").to_numpy()
    return fit([rows[i] for i in order], labels[order])


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves 1 when divided by 3; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def score(df: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, held_out, score (0 to 1, higher is better), predicted.

    Only the text decides. Nulls and empty texts score what the bias alone
    gives. Null doc_ids and repeated rows are scored like any other, an empty
    table gives no rows, and other columns are not read. The model has a fixed
    size.
    """
    weights, bias = model.weights, model.bias
    sent = df.sparkSession.sparkContext.broadcast((weights, bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, known = Model(*sent.value), known_words()
        for batch in batches:
            for part in slices(batch, "text"):
                found = [own.score(t, known) for t in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(found, pa.float64())], ["doc_id", "score"]
                )

    scored = texts(df, id_col, text_col).mapInArrow(run, "doc_id long, score double")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def keep_good(df: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows, with all their columns, whose text scores a half or more. Nothing is shuffled."""
    importable(df.sparkSession)
    sent = df.sparkSession.sparkContext.broadcast((model.weights, model.bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, known = Model(*sent.value), known_words()
        for batch in batches:
            for part in slices(batch, text_col):
                good = [own.score(t or "", known) >= 0.5 for t in part.column(text_col).to_pylist()]
                yield part.filter(pa.array(good, pa.bool_()))

    return df.mapInArrow(run, df.schema)
