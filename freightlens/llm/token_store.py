"""Token ids in binary shards whose document boundaries are Elias-Fano encoded.

A shard is one row of a Parquet file, so that any store Spark can write to holds
it and half-written files never count. Its columns:

- ``part``, ``seq``: place of the shard; shards in this order are in doc_id order
- ``n_docs``, ``n_tokens``: documents and ids in it
- ``doc_ids``: the doc_ids, little-endian signed 64-bit, one for each document,
  with ``no_ids``, the number of leading documents whose doc_id is null
- ``ids``: the concatenated ids, little-endian unsigned, ``id_bytes`` (2 or 4) each
- ``low_bits``, ``low``, ``high``: the ends of the documents, Elias-Fano encoded
- ``marks``: bit position in ``high`` of every 64th end

An end e is split into its ``low_bits`` lowest bits, packed one after the other
in ``low``, and the rest h, for which bit h + i of ``high`` is set (i counts the
ends from 0). That is at most 2 + log2(n_tokens / n_docs) bits for a document. The end of
document i is found with select(i): start at mark i // 64 and count set bits.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from freightlens.llm.chunks import LONGEST, Memory, parts
from freightlens.llm.common import partitions, slices, texts
from freightlens.session import new_run_dir

EVERY = 64
SHARDS = (
    "part int, seq int, n_docs long, n_tokens long, no_ids long, doc_ids binary, id_bytes int, "
    "ids binary, low_bits int, low binary, high binary, marks binary"
)
DOCUMENTS = "part int, seq int, doc_id long, local_start long, n_tokens long, ids_crc32 long"
#: Up to so many shards, of some megabytes each, their sizes are broadcast.
FEW_SHARDS = 100_000


class EliasFano:
    """A non-falling sequence of ends; ``of`` encodes, ``select`` reads one."""

    def __init__(self, n: int, low_bits: int, low: bytes, high: bytes, marks: bytes) -> None:
        self.n, self.low_bits, self.low, self.high, self.marks = n, low_bits, low, high, marks
        self._high = np.frombuffer(high, np.uint8)
        self._marks = np.frombuffer(marks, "<u4")

    @classmethod
    def of(cls, ends: np.ndarray) -> EliasFano:
        ends = np.asarray(ends, np.int64)
        n = len(ends)
        if n == 0:
            return cls(0, 0, b"", b"", b"")
        low_bits = max(0, int(ends[-1] // n).bit_length() - 1)
        tails = (ends[:, None] >> np.arange(low_bits)) & 1
        low = np.packbits(tails.astype(np.uint8).ravel(), bitorder="little").tobytes()
        ones = (ends >> low_bits) + np.arange(n)
        bits = np.zeros(int(ones[-1]) + 1, np.uint8)
        bits[ones] = 1
        high = np.packbits(bits, bitorder="little").tobytes()
        return cls(n, low_bits, low, high, ones[::EVERY].astype("<u4").tobytes())

    def select(self, i: int) -> int:
        """The i-th end, from its mark on."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        at = int(self._marks[i // EVERY])
        left = i % EVERY
        byte = at >> 3
        word = int(self._high[byte]) & (0xFF << (at & 7))
        while (found := word.bit_count()) <= left:
            left -= found
            byte += 1
            word = int(self._high[byte])
        for _ in range(left):
            word &= word - 1
        at = (byte << 3) + (word & -word).bit_length() - 1
        first = i * self.low_bits
        window = int.from_bytes(self.low[first >> 3 : ((first + self.low_bits) >> 3) + 1], "little")
        tail = (window >> (first & 7)) & ((1 << self.low_bits) - 1)
        return ((at - i) << self.low_bits) | tail


def _byte_letters() -> dict[int, str]:
    """How byte-level vocabularies spell bytes: visible ones as they are, others from 256 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in visible]
    return {b: chr(b) for b in visible} | {b: chr(256 + n) for n, b in enumerate(hidden)}


_SPELLED = _byte_letters()


#: ASCII marks: behind letters they are a piece of their own for the pre-tokenizer.
_MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())


class _Remembered(Memory):
    """``Memory`` in one call for a piece that is not known yet, as most new words are."""

    def __missing__(self, piece: str) -> bytes:
        found = self.old.get(piece)
        if found is None:
            found = self.encode(piece)
        if len(piece) <= LONGEST:
            if len(self) >= self.size:
                self.old = dict(self)
                self.clear()
            self[piece] = found
        return found


@lru_cache(maxsize=4)
def _encoder(file: str, id_bytes: int) -> Callable[[str], bytes]:
    """text → its ids as bytes; one encoder and its memories for each worker process.

    The library's pre-tokenizer and model encode each part of a text that is not
    remembered. A text that holds an added token goes to the library whole.
    """
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(file)
    split, merge = tokenizer.pre_tokenizer.pre_tokenize_str, tokenizer.model.tokenize
    code = {2: "<H", 4: "<I"}[id_bytes]
    one = {i: struct.pack(code, i) for i in tokenizer.get_vocab(with_added_tokens=True).values()}
    added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]

    def of_word(word: str) -> bytes:
        return b"".join([one[t.id] for t in merge(word)])

    words = _Remembered(of_word, 200_000)

    def of_any(part: str) -> bytes:
        return b"".join([words[w] for w, _ in split(part)])

    def spelled(stem: str) -> str | None:
        """Letters as the vocabulary spells them; None for what needs a search for words."""
        if stem.isalpha():
            if stem.isascii():
                return stem
            if max(stem) < "\u0100":
                return stem.encode().decode("latin-1").translate(_SPELLED)
        return None

    def of_line(line: str) -> bytes:
        stem = line.rstrip(_MARKS)
        word = spelled(stem)
        if word is None:
            return of_any(line)
        return words[word] if stem == line else words[word] + words[line[len(stem) :]]

    def after_space(part: str) -> bytes:
        """Most parts are a word and perhaps some marks, which need no search for words.

        A line feed without other white space beside it is a word of its own.
        """
        stem = part.rstrip(_MARKS)
        word = spelled(stem)
        if word is not None:
            return of_word("Ġ" + word) if stem == part else known[stem] + words[part[len(stem) :]]
        line, feed, more = part.partition("\n")
        if line and more and not (line[-1].isspace() or more[0].isspace()):
            return known[line] + words["Ċ"] + of_line(more)
        return of_any(" " + part)

    known = _Remembered(after_space, 600_000)

    def encode(text: str) -> bytes:
        if not text:
            return b""
        if any(x in text for x in added):
            return b"".join([one[i] for i in tokenizer.encode(text, add_special_tokens=False).ids])
        first, *rest = parts(text)
        return of_any(first) + b"".join([known[p] for p in rest])

    return encode


def write_shards(
    df: DataFrame,
    path: str,
    tokenizer_file: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    id_bytes: int = 2,
    shard_bytes: int = 8 << 20,
) -> None:
    """Encode every text, add ``end_id``, and write the shards in ascending doc_id order.

    Each partition holds a range of doc_ids and is read, encoded and written as
    a stream of shards of about ``shard_bytes``. Texts are encoded at places where the byte-level
    pre-tokenizer must split them (see chunks.py), so ``tokenizer_file`` must
    name a byte-level BPE with the usual pattern. A text that names an added token of the
    tokenizer has that token's id, as from the library. Null and empty texts hold the
    end id alone. Null doc_ids come first; rows with the same doc_id follow each
    other in the order of their texts. Other columns are not read.
    """
    id_type = {2: "<u2", 4: "<u4"}[id_bytes]
    end = np.array([end_id], id_type).tobytes()
    docs = texts(df, id_col, text_col)
    ranged = docs.repartitionByRange(partitions(df.sparkSession), "doc_id")

    def shard(part: int, seq: int, ids: list[bytes], doc_ids: list[int | None]) -> pa.RecordBatch:
        ends = np.cumsum([len(x) // id_bytes for x in ids])
        code = EliasFano.of(ends)
        empty = sum(x is None for x in doc_ids)
        row = {
            "part": part, "seq": seq, "n_docs": len(ids), "n_tokens": int(ends[-1]),
            "no_ids": empty, "doc_ids": np.array(doc_ids[empty:], "<i8").tobytes(),
            "id_bytes": id_bytes, "ids": b"".join(ids), "low_bits": code.low_bits,
            "low": code.low, "high": code.high, "marks": code.marks,
        }
        return pa.RecordBatch.from_pylist([row], schema=_arrow(SHARDS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = _encoder(tokenizer_file, id_bytes)
        ids, doc_ids, size, seq, part = [], [], 0, 0, None
        for batch in batches:
            for cut in slices(batch, "text"):
                part = cut.column("part")[0].as_py()
                for doc_id, text in zip(
                    cut.column("doc_id").to_pylist(), cut.column("text").to_pylist()
                ):
                    ids.append(encode(text) + end)
                    doc_ids.append(doc_id)
                    size += len(ids[-1])
                    if size >= shard_bytes:
                        yield shard(part, seq, ids, doc_ids)
                        ids, doc_ids, size, seq = [], [], 0, seq + 1
        if ids:
            yield shard(part, seq, ids, doc_ids)

    (
        ranged.withColumn("part", F.spark_partition_id())
        .sortWithinPartitions("doc_id", "text")
        .mapInArrow(run, SHARDS)
        .write.parquet(path)
    )


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
    return pa.schema([(n, kinds[k]) for n, k in (x.split() for x in ddl.split(", "))])


def read_documents(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """One row per document of the shards: doc_id, start, n_tokens, ids_crc32, and its ids as bytes.

    ``start`` is the number of ids in all documents before it. ``ids_crc32`` is
    the unsigned CRC-32 of the ids as little-endian unsigned 32-bit integers.
    Only the sizes of the shards, one short row for each some megabytes, are
    added up in one place; they are broadcast while they are few.
    """
    shards = spark.read.schema(SHARDS).parquet(path)
    order = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    before = shards.select(
        "part", "seq", F.coalesce(F.sum("n_tokens").over(order), F.lit(0)).alias("before")
    )
    if shards.count() <= FEW_SHARDS:
        before = F.broadcast(before)
    schema = DOCUMENTS + (", ids binary" if with_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                (s,) = batch.slice(i, 1).to_pylist()
                code = EliasFano(s["n_docs"], s["low_bits"], s["low"], s["high"], s["marks"])
                ids = np.frombuffer(s["ids"], f"<u{s['id_bytes']}")
                ends = [code.select(i) for i in range(code.n)]
                cuts = list(zip([0, *ends[:-1]], ends))
                found = {
                    "part": [s["part"]] * code.n,
                    "seq": [s["seq"]] * code.n,
                    "doc_id": [None] * s["no_ids"] + np.frombuffer(s["doc_ids"], "<i8").tolist(),
                    "local_start": [a for a, _ in cuts],
                    "n_tokens": [b - a for a, b in cuts],
                    "ids_crc32": [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in cuts],
                }
                if with_ids:
                    found["ids"] = [ids[a:b].tobytes() for a, b in cuts]
                yield pa.RecordBatch.from_pydict(found, schema=_arrow(schema))

    documents = shards.mapInArrow(run, schema).join(before, ["part", "seq"])
    start = (F.col("before") + F.col("local_start")).alias("start")
    return documents.select(
        "doc_id", start, "n_tokens", "ids_crc32", *(["ids"] if with_ids else [])
    )


def stored(
    df: DataFrame, tokenizer_file: str, end_id: int, with_ids: bool = True, **options
) -> DataFrame:
    """The documents written as shards to the shared folder and read back from them."""
    path = f"{new_run_dir(df.sparkSession, 'token-shards')}.parquet"
    write_shards(df, path, tokenizer_file, end_id, **options)
    return read_documents(df.sparkSession, path, with_ids)
