"""Byte-level BPE: exact merges from longest matches of an Aho-Corasick automaton.

A sequence of tokens is the encoding of its bytes exactly if every two
neighbours are compatible, that is, if no merge across their border comes before
the merges that made them. The encoder walks from left to right over the longest
matches, takes a token only if it is compatible with the one before, and turns
back where none is. A prefix has one encoding, so a place that has failed once
fails for good, and each place is visited a bounded number of times.
"""

from __future__ import annotations

import base64
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from freightlens.llm.chunks import Memory, parts
from freightlens.llm.common import slices, texts

SCHEMA = "doc_id long, n_tokens long, ids array<int>, decoded binary"
_NEVER = 1 << 31
#: The pattern of byte-level vocabularies, for which a word and the marks behind it need no search.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Marks, all but the apostrophe, which may begin a match with letters.
_MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum() and c != "'")


class BytePairs:
    """The encoder of a rank file; ``pattern`` splits a text before the merges."""

    def __init__(self, rank_file: str, pattern: str, remembered_pairs: int = 300_000) -> None:
        import ahocorasick
        import regex

        with open(rank_file, "rb") as f:
            lines = [line.split() for line in f if line.strip()]
        self.ranks = {base64.b64decode(a): int(b) for a, b in lines}
        self.tokens = {b: a for a, b in self.ranks.items()}
        self.find = regex.compile(pattern).findall
        #: Whether a space with letters and a run of marks are matches of their own.
        self.plain = pattern == _PATTERN
        self.parts: dict[int, tuple[int, int] | None] = {}
        self.edges: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
        self.automaton = ahocorasick.Automaton()
        for token, rank in self.ranks.items():
            self.automaton.add_word(token.decode("latin-1"), rank)
        self.automaton.make_automaton()
        self.sizes = {rank: len(token) for token, rank in self.ranks.items()}
        #: The longest other token that a token starts with; None for a single byte.
        self.shorter = {
            rank: next((self.ranks[x] for n in range(len(t) - 1, 0, -1) if (x := t[:n]) in self.ranks), None)
            for t, rank in self.ranks.items()
        }
        self.fits = Memory(self._compatible, remembered_pairs)
        self.words = Memory(self._packed, 150_000)
        self.known = Memory(self._after_space, 600_000)
        #: The tokens by rank, to gather the bytes of many ids at once.
        self.by_rank = pa.array([self.tokens.get(i, b"") for i in range(max(self.tokens) + 1)], pa.large_binary())

    def _split(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge makes this one; None for a single byte."""
        if token not in self.parts:
            piece = [self.ranks[bytes([b])] for b in self.tokens[token]]
            while len(piece) > 2:
                best, at = _NEVER, -1
                for i, pair in enumerate(zip(piece, piece[1:])):
                    rank = self._merged(*pair)
                    if rank < best:
                        best, at = rank, i
                piece[at : at + 2] = [best]
            self.parts[token] = tuple(piece) if len(piece) == 2 else None
        return self.parts[token]

    def _merged(self, left: int, right: int) -> int:
        return self.ranks.get(self.tokens[left] + self.tokens[right], _NEVER)

    def _edge(self, token: int, side: int) -> list[tuple[int, int, int]]:
        """(node, first rank at which it is there, rank at which it is swallowed) at one edge.

        ``side`` is 0 for the left edge and 1 for the right one.
        """
        if (token, side) not in self.edges:
            found, node, until = [], token, _NEVER
            while (parts := self._split(node)) is not None:
                found.append((node, node, until))
                node, until = parts[side], node
            found.append((node, -1, until))
            self.edges[token, side] = found
        return self.edges[token, side]

    def _compatible(self, pair: tuple[int, int]) -> bool:
        """Whether merges leave the border between two tokens alone.

        Equal ranks are merged from the left, so a merge across the border loses
        to one of the left token and wins against one of the right token.
        """
        for x, from_x, until_x in self._edge(pair[0], 1):
            for y, from_y, until_y in self._edge(pair[1], 0):
                if from_x < until_y and from_y < until_x:
                    across = self._merged(x, y)
                    if across < until_x and across <= until_y:
                        return False
        return True

    def encode_word(self, word: str) -> tuple[int, ...]:
        """The tokens of one match of the pattern."""
        data = word.encode("utf-8")
        if data in self.ranks:
            return (self.ranks[data],)
        fits, sizes, shorter = self.fits, self.sizes, self.shorter
        find = self.automaton.iter_long
        text = data.decode("latin-1")
        greedy = [token for _, token in find(text)]
        if all([fits[pair] for pair in zip(greedy, greedy[1:])]):
            return tuple(greedy)
        failed = bytearray(len(data) + 1)
        # Up to the first two that do not fit, the walk takes the longest matches.
        good = next(i for i, pair in enumerate(zip(greedy, greedy[1:])) if not fits[pair])
        taken = greedy[: good + 1]
        at, token = sum([sizes[x] for x in taken]), greedy[good + 1]
        while True:
            after = at + sizes[token]
            if not failed[after] and (not taken or fits[taken[-1], token]):
                taken.append(token)
                at = after
                if at == len(data):
                    return tuple(taken)
                token = next(find(text, at))[1]
                continue
            token = shorter[token]
            while token is None:
                failed[at] = 1
                token = taken.pop()
                at -= sizes[token]
                token = shorter[token]

    def _packed(self, word: str) -> bytes:
        return array("i", self.encode_word(word)).tobytes()

    def _encode_piece(self, piece: str) -> bytes:
        words = self.words
        return b"".join([words[w] for w in self.find(piece)])

    def _simple(self, stem: str) -> bool:
        return self.plain and stem.isalpha() and (stem.isascii() or max(stem) < "\u0100")

    def _line(self, line: str) -> bytes:
        stem = line.rstrip(_MARKS)
        if not self._simple(stem):
            return self._encode_piece(line)
        found = self.words[stem]
        return found if stem == line else found + self.words[line[len(stem) :]]

    def _after_space(self, part: str) -> bytes:
        """Most parts are a word and perhaps some marks, which need no search for matches.

        A line feed without other white space beside it is a match of its own.
        """
        stem = part.rstrip(_MARKS)
        if self._simple(stem):
            if stem == part:
                return self._packed(" " + part)
            return self.known[stem] + self.words[part[len(stem) :]]
        line, feed, more = part.partition("\n")
        if self.plain and line and more and not (line[-1].isspace() or more[0].isspace()):
            return self.known[line] + self.words[feed] + self._line(more)
        return self._encode_piece(" " + part)

    def packed(self, text: str) -> bytes:
        """The ids of a text as 32-bit integers of this machine."""
        if not text:
            return b""
        known = self.known
        first, *rest = parts(text)
        return self._encode_piece(first) + b"".join([known[p] for p in rest])

    def encode(self, text: str) -> list[int]:
        return np.frombuffer(self.packed(text), np.int32).tolist()

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def decode_all(self, flat: np.ndarray, ends: np.ndarray) -> pa.Array:
        """The bytes of each row of ids; ``ends`` has a 0 and the end of each row in ``flat``."""
        taken = self.by_rank.take(pa.array(flat))
        _, offsets, data = taken.buffers()
        starts = np.frombuffer(offsets, np.int64)[: len(flat) + 1] if offsets else np.zeros(1, np.int64)
        rows = pa.py_buffer(starts[ends].astype(np.int32))
        return pa.BinaryArray.from_buffers(pa.binary(), len(ends) - 1, [None, rows, data])


@lru_cache(maxsize=2)
def encoder(rank_file: str, pattern: str) -> BytePairs:
    """One encoder for each worker process."""
    return BytePairs(rank_file, pattern)


def encode_and_decode(
    df: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: doc_id, n_tokens, ids, and the bytes they decode to.

    The ids are those of the plain merge loop over each match of ``pattern``,
    without special tokens, so a special token's name is ordinary text. Nulls
    and empty texts have no ids and decode to no bytes. Null doc_ids and
    repeated rows are encoded like any other row, an empty table gives no rows,
    and other columns are not read. ``rank_file`` must lie at the same place on
    every executor. Nothing is shuffled; what is remembered has a fixed bound.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(rank_file, pattern)
        for batch in batches:
            for part in slices(batch, "text"):
                ids = [coder.packed(t) for t in part.column("text").to_pylist()]
                sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // 4
                ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                flat = np.frombuffer(b"".join(ids), np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array(sizes),
                        pa.ListArray.from_arrays(pa.array(ends), pa.array(flat)),
                        coder.decode_all(flat, ends),
                    ],
                    names=["doc_id", "n_tokens", "ids", "decoded"],
                )

    return texts(df, id_col, text_col).mapInArrow(run, SCHEMA)
