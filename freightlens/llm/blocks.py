"""Counting over a corpus in packed form: blocks of documents ask buckets of hashes.

Tens of billions of n-grams do not fit a shuffle as rows. So documents are dealt
over blocks by their id, a block sends each bucket of hashes one row with
all its distinct entries packed into arrays, and the bucket answers each block
with one row of as many answers. Both are hash partitioned, whatever is common
reaches a bucket at most once from each block, and the exchange of the documents
is the same in each pass, so that Spark reuses it.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from freightlens.llm.common import texts

#: Text of a block, and text for each bucket, in bytes.
BLOCK_BYTES, BUCKET_BYTES = 6 << 20, 10 << 20


@dataclass(frozen=True)
class Blocks:
    docs: DataFrame  # block int, doc_id long, text binary
    n_blocks: int
    n_buckets: int


def blocks(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
    bucket_bytes: int = BUCKET_BYTES,
) -> Blocks:
    """The documents dealt over blocks of about ``block_bytes`` of text.

    Rows with the same doc_id share a block; null ids are dealt by their text.
    A row is only ever split from its block's other rows, never in itself, so a
    block is as large as its longest text at least.
    """
    docs = texts(df, id_col, text_col)
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, -(-total // block_bytes))
    block = F.pmod(F.coalesce(F.xxhash64("doc_id"), F.xxhash64("text")), F.lit(n_blocks))
    return Blocks(
        docs.select(
            block.cast("int").alias("block"), "doc_id", F.col("text").cast("binary").alias("text")
        ),
        n_blocks,
        max(1, -(-total // bucket_bytes)),
    )


def bucket_of(hashes: np.ndarray, n_buckets: int) -> np.ndarray:
    """The bucket of each hash, rising with the hash."""
    return ((hashes >> np.uint64(32)) * np.uint64(n_buckets) >> np.uint64(32)).astype(np.int64)


def cuts(sorted_hashes: np.ndarray, n_buckets: int) -> list[tuple[int, int, int]]:
    """(bucket, start, end) of the runs of sorted hashes that fall into each bucket."""
    found = bucket_of(sorted_hashes, n_buckets)
    at = [0, *(np.flatnonzero(found[1:] != found[:-1]) + 1).tolist(), len(found)]
    return [(int(found[a]), a, b) for a, b in zip(at, at[1:]) if b > a]


def packed(x: np.ndarray, n_bytes: int) -> bytes:
    """The low ``n_bytes`` of each unsigned 64-bit integer."""
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :n_bytes]).tobytes()


def unpacked(data: bytes, n_bytes: int) -> np.ndarray:
    wide = np.zeros((len(data) // n_bytes, 8), np.uint8)
    wide[:, :n_bytes] = np.frombuffer(data, np.uint8).reshape(-1, n_bytes)
    return wide.view("<u8").ravel()
