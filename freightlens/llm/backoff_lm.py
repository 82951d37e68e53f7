"""Stupid-backoff language-model scores from n-gram counts of the whole corpus.

The n-gram count tables are partitioned by the n-gram's hash, of 64 bits. Each block of
documents joins them with its exploded n-grams, as packed rows (see blocks.py), and sums
the scores of each document. Words and bigrams are counted first. From three words on, an
n-gram can occur in another document only if both its shorter ends do, so only such
n-grams are asked for; the count of any other is what its own document holds.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlens.llm.blocks import Blocks, blocks, cuts
from freightlens.llm.common import saved

REQUEST = (
    "n int, bucket int, block int, first long, size int, hash_bytes int, "
    "hashes binary, count_bytes int, counts binary"
)
ANSWER = "n int, bucket int, block int, size int, count_bytes int, counts binary"
SCORED = "doc_id long, n_words long, log_sum double, n_single long, n_backoffs long"
_LEFT, _RIGHT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_MIX = np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53)
_IS_SPACE = np.isin(np.arange(256), list(b" \t\n\r\x0b\x0c"))
#: Words of up to this many bytes are hashed together, eight bytes of each at a time.
SHORT = 64


def _mixed(x: np.ndarray) -> np.ndarray:
    for factor in _MIX:
        x = (x ^ (x >> np.uint64(33))) * factor
    return x ^ (x >> np.uint64(33))


def hashed_words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each lower-cased word of all texts, in order, and the number of its text."""
    import xxhash

    data = b" ".join(texts).lower() + b" " * 8
    space = _IS_SPACE[np.frombuffer(data, np.uint8)]
    edges = np.flatnonzero(np.diff(space, prepend=True))
    starts, ends = edges[0::2], edges[1::2]
    sizes = ends - starts
    eights = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    hashes = sizes.astype(np.uint64) * _LEFT
    open_ = np.arange(len(starts))
    for at in range(0, SHORT, 8):
        left = sizes[open_] - at
        unused = np.uint64(8) * np.maximum(8 - left, 0).astype(np.uint64)
        hashes[open_] = _mixed(hashes[open_] ^ (eights[starts[open_] + at] << unused))
        open_ = open_[left > 8]
    for i in open_.tolist():
        hashes[i] = xxhash.xxh64_intdigest(data[starts[i] : ends[i]])
    borders = np.cumsum([len(t) + 1 for t in texts])
    return hashes, np.searchsorted(borders, starts, side="right")


class Grams:
    """The n-grams of a block: for each n, their hashes and the document of each."""

    def __init__(self, texts: list[bytes], order: int) -> None:
        single, docs = hashed_words(texts)
        self.sizes = np.bincount(docs, minlength=len(texts))
        starts = np.repeat(np.cumsum(self.sizes) - self.sizes, self.sizes)
        place = np.arange(len(docs)) - starts
        self.docs, self.place = docs, place
        self.hashes, self.ends = {1: single}, {1: np.arange(len(docs))}
        whole = single
        for n in range(2, order + 1):
            # whole[i] is the n-gram that ends at word i, where it does not cross documents.
            longer = np.zeros_like(whole)
            longer[1:] = (whole[:-1] ^ (whole[:-1] >> np.uint64(31))) * _LEFT + single[1:] * _RIGHT
            longer ^= longer >> np.uint64(29)
            whole = longer
            self.ends[n] = np.flatnonzero(place >= n - 1)
            self.hashes[n] = whole[self.ends[n]]


def _bytes_for(x: np.ndarray) -> int:
    return max(1, (int(x.max()).bit_length() + 7) // 8) if len(x) else 1


def squeezed(x: np.ndarray, n_bytes: int) -> bytes:
    """The low ``n_bytes`` of unsigned integers, all first bytes first, compressed."""
    planes = x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :n_bytes].T
    return pa.compress(np.ascontiguousarray(planes).tobytes(), "zstd", asbytes=True)


def spread(data: bytes, size: int, n_bytes: int) -> np.ndarray:
    """The ``size`` integers that were squeezed."""
    flat = pa.decompress(data, size * n_bytes, "zstd", asbytes=True) if size else b""
    wide = np.zeros((size, 8), np.uint8)
    wide[:, :n_bytes] = np.frombuffer(flat, np.uint8).reshape(n_bytes, size).T
    return wide.view("<u8").ravel()


_KINDS = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "double": pa.float64()}
_ASK, _ANSWER, _SCORED = (
    pa.schema([(n, _KINDS[k]) for n, k in (x.split() for x in ddl.split(", "))])
    for ddl in (REQUEST, ANSWER, SCORED)
)


def _requests(block: int, n: int, hashes: np.ndarray, n_buckets: int) -> list[dict]:
    """One row for each bucket, with the distinct hashes and how often the block has them."""
    found, counts = np.unique(hashes, return_counts=True)
    rows = []
    for bucket, i, j in cuts(found, n_buckets):
        steps = np.diff(found[i:j])
        wide, deep = _bytes_for(steps), _bytes_for(counts[i:j])
        rows.append(
            {
                "n": n, "bucket": bucket, "block": block, "size": j - i,
                "first": int(found[i : i + 1].view(np.int64)[0]), "hash_bytes": wide,
                "hashes": squeezed(steps, wide), "count_bytes": deep,
                "counts": squeezed(counts[i:j], deep),
            }
        )
    return rows


def _ask(b: Blocks, order: int) -> DataFrame:
    """Requests for the words and, if ``order`` allows, the bigrams of each block."""
    n_buckets = b.n_buckets

    def run(table: pa.Table) -> pa.Table:
        block = table.column("block")[0].as_py()
        grams = Grams(table.column("text").to_pylist(), min(order, 2))
        rows = [r for n, h in grams.hashes.items() for r in _requests(block, n, h, n_buckets)]
        return pa.Table.from_pylist(rows, schema=_ASK)

    return b.docs.groupBy("block").applyInArrow(run, REQUEST)


def _ask_longer(b: Blocks, answers: DataFrame, n: int) -> DataFrame:
    """Requests for the n-grams whose first and last n - 1 words occur in another document."""
    n_buckets = b.n_buckets

    def run(docs: pa.Table, found: pa.Table) -> pa.Table:
        rows = []
        if docs.num_rows and found.num_rows:
            grams = Grams(docs.column("text").to_pylist(), n)
            counted = Counted(grams, found, range(2, n))
            asked = grams.hashes[n][counted.shared(n)]
            rows = _requests(docs.column("block")[0].as_py(), n, asked, n_buckets)
        return pa.Table.from_pylist(rows, schema=_ASK)

    return b.docs.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, REQUEST)


def _add_up(table: pa.Table) -> pa.Table:
    """The counts over all blocks, for each hash that a block asked for, in its order."""
    rows = table.to_pylist()
    hashes, counts = [], []
    for r in rows:
        first = np.array([r["first"]], np.int64).view(np.uint64)
        steps = spread(r["hashes"], r["size"] - 1, r["hash_bytes"])
        hashes += [first, first + np.cumsum(steps, dtype=np.uint64)]
        counts.append(spread(r["counts"], r["size"], r["count_bytes"]))
    _, place = np.unique(np.concatenate(hashes), return_inverse=True)
    total = np.bincount(place, weights=np.concatenate(counts)).astype(np.uint64)[place]
    answers, at = [], 0
    for r in rows:
        own = total[at : at + r["size"]]
        at += r["size"]
        deep = _bytes_for(own)
        answers.append(
            {k: r[k] for k in ("n", "bucket", "block", "size")}
            | {"count_bytes": deep, "counts": squeezed(own, deep)}
        )
    return pa.Table.from_pylist(answers, schema=_ANSWER)


class Counted:
    """For each n of ``sizes``, ascending, at the word that ends an n-gram: its count in the
    corpus (``total``) and in its own document (``own``). Both are 0 where no n-gram ends."""

    def __init__(self, grams: Grams, answers: pa.Table, sizes: range) -> None:
        self.grams = grams
        self.total, self.own = {}, {}
        rows = sorted(answers.to_pylist(), key=lambda r: (r["n"], r["bucket"]))
        for n in sizes:
            given = [spread(r["counts"], r["size"], r["count_bytes"]) for r in rows if r["n"] == n]
            ends = grams.ends[n]
            found, place, times = np.unique(
                grams.hashes[n], return_inverse=True, return_counts=True
            )
            own = np.ones(len(ends), np.int64)
            again = np.flatnonzero(times[place] > 1)
            of_doc = place[again] * len(grams.sizes) + grams.docs[ends[again]]
            _, at, here = np.unique(of_doc, return_inverse=True, return_counts=True)
            own[again] = here[at]
            # Where not asked for, no other document has it.
            asked = self.shared(n)
            answered = np.zeros(len(found), bool)
            answered[place[asked]] = True
            total = own.copy()
            if given:
                rank = np.cumsum(answered) - 1
                total[asked] = np.concatenate(given).astype(np.int64)[rank[place[asked]]]
            self.total[n], self.own[n] = (np.zeros(len(grams.docs), np.int64) for _ in "to")
            self.total[n][ends], self.own[n][ends] = total, own

    def shared(self, n: int) -> np.ndarray:
        """The places in the n-grams of those that are asked for."""
        ends = self.grams.ends[n]
        if n <= 2:
            return np.arange(len(ends))
        elsewhere = self.total[n - 1] > self.own[n - 1]
        return np.flatnonzero(elsewhere[ends] & elsewhere[ends - 1])


def _score(b: Blocks, answers: DataFrame, order: int, leave_out: bool) -> DataFrame:
    def run(docs: pa.Table, found: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return pa.Table.from_pylist([], schema=_SCORED)
        grams = Grams(docs.column("text").to_pylist(), order)
        n_docs, n_words = docs.num_rows, len(grams.docs)
        counted = Counted(grams, found, range(1, order + 1))
        counts = {
            n: (total - counted.own[n] if leave_out else total).astype(np.float64)
            for n, total in counted.total.items()
        }
        # From the longest n-gram down; a word is done at the first that occurs elsewhere.
        logs, backoffs = np.zeros(n_words), np.zeros(n_words, np.int64)
        open_ = np.ones(n_words, bool)
        for n in range(order, 1, -1):
            here = open_ & (grams.place >= n - 1)
            hit = here & (counts[n] > 0)
            context = np.roll(counts[n - 1], 1)
            logs[hit] = np.log(counts[n][hit]) - np.log(context[hit])
            backoffs[here & ~hit] += 1
            open_ &= ~hit
        logs[open_] = np.log(np.maximum(counts[1][open_], 0.5))
        per_doc = lambda x: np.bincount(grams.docs, weights=x, minlength=n_docs)
        return pa.Table.from_arrays(
            [
                docs.column("doc_id").combine_chunks(),
                pa.array(grams.sizes),
                pa.array(per_doc(logs)),
                pa.array(per_doc(open_).astype(np.int64)),
                pa.array(per_doc(backoffs).astype(np.int64)),
            ],
            schema=_SCORED,
        )

    return (
        b.docs.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, SCORED)
    )


def _answered(requests: DataFrame) -> DataFrame:
    """The answers, exchanged by block, so that each later pass reads the same exchange."""
    return requests.groupBy("n", "bucket").applyInArrow(_add_up, ANSWER).repartition("block")


def score(
    df: DataFrame,
    order: int = 3,
    discount: float = 0.4,
    leave_out: bool = True,
    id_col: str = "doc_id",
    text_col: str = "text",
    **block_sizes: int,
) -> DataFrame:
    """One row per input row: doc_id, n_words, n_backoffs, log_score, mean_log_score.

    Words are runs of other than ASCII white space, A-Z lower-cased. A word's score is
    count(n-gram) / count(its first n - 1 words) for the longest n-gram, of at
    most ``order`` words, that occurs; each step to a shorter one costs a factor
    ``discount``. A single word scores its count, a half at least, among all
    words. With ``leave_out`` a document's own n-grams are not counted when it
    is scored, since a text always predicts itself. Counts cover all documents.

    Documents without words, nulls among them, have score 0 and a null mean.
    Null doc_ids and repeated rows are documents like any other, so a repeated
    row is predicted by its copy. An empty table gives no rows. Other columns are not read.
    """
    b = blocks(df, id_col, text_col, **block_sizes)
    answers = _answered(_ask(b, order))
    for n in range(3, order + 1):
        answers = answers.union(_answered(_ask_longer(b, answers, n)))
    scored = saved(_score(b, answers, order, leave_out), "scores")
    total = float(scored.agg(F.sum("n_words")).first()[0] or 0)
    all_words = F.lit(total) - (F.col("n_words") if leave_out else F.lit(0))
    log_score = (
        F.col("log_sum")
        + F.col("n_backoffs") * F.log(F.lit(discount))
        - F.col("n_single") * F.log(F.greatest(all_words, F.lit(1.0)))
    )
    return scored.select(
        "doc_id",
        "n_words",
        "n_backoffs",
        log_score.alias("log_score"),
        F.when(F.col("n_words") > 0, log_score / F.col("n_words")).alias("mean_log_score"),
    )
