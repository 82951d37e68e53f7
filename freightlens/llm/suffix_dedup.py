"""Removal of repeated passages, decided by suffix arrays.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts in a
document with a smaller doc_id. A window of that length is known by its anchor,
the k-gram with the lowest hash in it, so equal windows have equal anchors.
Neighbouring windows with one anchor form a segment.

1. Blocks of documents send each bucket of anchors their distinct segments, as
   hashes. A segment that a smaller document also has is repeated as a whole.
   Where an anchor has different segments, parts of them may be.
2. The texts of these, a small part of the corpus, are sent by anchor. Each
   bucket sorts the suffixes of its segments in two stages, compares neighbours, and
   finds the smallest document of every window.
3. The blocks take the repeated windows out of their texts.

Packed rows and the reuse of the documents' exchange are described in blocks.py.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from freightlens.llm.blocks import Blocks, blocks, cuts, packed, unpacked

LENGTH = 50
GRAM = 20
#: Bytes of an anchor's hash and of a segment's that are sent.
ANCHOR_BYTES, SEGMENT_BYTES = 6, 6
_NO_ID = np.iinfo(np.int64).max

ASK = (
    "bucket int, block int, size int, first long, step_bytes int, steps binary, segments binary, "
    "doc_bytes int, docs binary, doc_ids binary"
)
VERDICT = "bucket int, block int, verdicts binary"
CASE = "bucket int, block int, text binary, sizes binary, doc_ids binary"
FINDING = "bucket int, block int, windows binary"
KEPT = (
    "doc_id long, n_bytes long, n_removed long, n_spans long, "
    "span_starts array<long>, span_ends array<long>, kept binary"
)
_KINDS = {
    "int": pa.int32(),
    "long": pa.int64(),
    "binary": pa.binary(),
    "array<long>": pa.list_(pa.int64()),
}
_ASK, _VERDICT, _CASE, _FINDING, _KEPT = (
    pa.schema([(n, _KINDS[k]) for n, k in (x.split() for x in ddl.split(", "))])
    for ddl in (ASK, VERDICT, CASE, FINDING, KEPT)
)
ALONE, REPEATED, OPEN = 0, 1, 2

_BASE = 0x9E3779B97F4A7C15
_WORD = (1 << 64) - 1


def _gram_hashes(x: np.ndarray, k: int) -> np.ndarray:
    """A mixed hash of every ``k`` bytes, by doubling."""
    power, span, at = _BASE, 1, 0
    part = x.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(1)
    n = len(x) - k + 1
    whole = None
    while True:
        if k & span:
            piece = part[at : at + n]
            whole = piece if whole is None else whole * np.uint64(power) + piece
            at += span
        if 2 * span > k:
            break
        part = part[:-span] * np.uint64(power) + part[span:]
        power, span = power * power & _WORD, 2 * span
    whole = (whole ^ (whole >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return whole ^ (whole >> np.uint64(32))


def _window_minima(v: np.ndarray, w: int) -> np.ndarray:
    low, span = v, 1
    while span * 2 <= w:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    n = len(v) - w + 1
    return np.minimum(low[:n], low[w - span : w - span + n])


def segments(text: bytes, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first window, end of windows) of each segment of a text."""
    x = np.frombuffer(text, np.uint8)
    if len(x) < length:
        none = np.zeros(0, np.int64)
        return none.astype(np.uint64), none, none
    low = _window_minima(_gram_hashes(x, GRAM), length - GRAM + 1)
    change = np.flatnonzero(low[1:] != low[:-1]) + 1
    starts = np.concatenate([[0], change])
    # Minima crowd together at small values; mixed once more they fill all buckets alike.
    anchors = low[starts] * np.uint64(_BASE)
    return anchors ^ (anchors >> np.uint64(32)), starts, np.concatenate([change, [len(low)]])


class Segments:
    """The segments of a block's documents, and the distinct ones among them.

    Documents come in the order of their ids, null ids last. Distinct segments
    are sorted by anchor and belong to their first document.
    """

    def __init__(self, docs: pa.Table, length: int) -> None:
        import xxhash

        ids = [_NO_ID if x is None else x for x in docs.column("doc_id").to_pylist()]
        texts = docs.column("text").to_pylist()
        order = sorted(range(len(ids)), key=ids.__getitem__)
        self.real_ids = [None if ids[i] == _NO_ID else ids[i] for i in order]
        self.ids = np.array([ids[i] for i in order], np.int64)
        self.texts = [texts[i] for i in order]
        self.length = length
        found = [segments(t, length) for t in self.texts]
        n = [len(f[0]) for f in found]
        self.doc = np.repeat(np.arange(len(n)), n)
        self.anchor, self.start, self.end = (
            np.concatenate([f[i] for f in found]) if found else np.zeros(0, np.int64)
            for i in range(3)
        )
        cut = length - 1
        digest = xxhash.xxh64_intdigest
        codes = [
            digest(t[a : b + cut])
            for t, f in zip(self.texts, found)
            for a, b in zip(f[1].tolist(), f[2].tolist())
        ]
        self.anchor = self.anchor >> np.uint64(64 - 8 * ANCHOR_BYTES)
        self.code = np.array(codes, np.uint64) & np.uint64((1 << 8 * SEGMENT_BYTES) - 1)
        # One sort, unless segments that differ agree in the bits that fit beside the anchor.
        order = np.argsort(self.anchor << np.uint64(16) | self.code & np.uint64(0xFFFF))
        new, unsorted = self._starts(order)
        if unsorted:
            order = np.lexsort((self.code, self.anchor))
            new, _ = self._starts(order)
        #: For every segment its place among the distinct ones, and of these the first segment.
        self.place = np.empty(len(order), np.int64)
        self.place[order] = np.cumsum(new) - 1
        first = np.flatnonzero(new)
        self.first = np.minimum.reduceat(order, first) if len(first) else order

    def _starts(self, order: np.ndarray) -> tuple[np.ndarray, bool]:
        """Where distinct segments start, and whether one may start more than once."""
        a, c = self.anchor[order], self.code[order]
        same, low = a[1:] == a[:-1], np.uint64(0xFFFF)
        new = np.ones(len(order), bool)
        new[1:] = ~same | (c[1:] != c[:-1])
        return new, bool((same & new[1:] & ((c[1:] & low) == (c[:-1] & low))).any())

    def buckets(self, n_buckets: int) -> list[tuple[int, int, int]]:
        wide = self.anchor[self.first] << np.uint64(64 - 8 * ANCHOR_BYTES)
        return cuts(wide, n_buckets) if len(wide) else []


def _bytes_for(x: np.ndarray) -> int:
    return max(1, (int(x.max()).bit_length() + 7) // 8) if len(x) else 1


def _ask(b: Blocks, length: int) -> DataFrame:
    n_buckets = b.n_buckets

    def run(docs: pa.Table) -> pa.Table:
        s = Segments(docs, length)
        block = docs.column("block")[0].as_py()
        anchors, codes, doc = s.anchor[s.first], s.code[s.first], s.doc[s.first]
        rows = []
        for bucket, i, j in s.buckets(n_buckets):
            steps = np.diff(anchors[i:j])
            table, place = np.unique(doc[i:j], return_inverse=True)
            wide, deep = _bytes_for(steps), _bytes_for(place)
            rows.append(
                {
                    "bucket": bucket, "block": block, "size": j - i, "first": int(anchors[i]),
                    "step_bytes": wide, "steps": packed(steps, wide),
                    "segments": packed(codes[i:j], SEGMENT_BYTES), "doc_bytes": deep,
                    "docs": packed(place, deep), "doc_ids": s.ids[table].tobytes(),
                }
            )
        return pa.Table.from_pylist(rows, schema=_ASK)

    return b.docs.groupBy("block").applyInArrow(run, ASK)


def _judge(table: pa.Table) -> pa.Table:
    """For each segment whether it is alone, repeats a smaller document, or may do so in part."""
    rows = table.to_pylist()
    anchors, codes, docs = [], [], []
    for r in rows:
        steps = np.cumsum(unpacked(r["steps"], r["step_bytes"]), dtype=np.uint64)
        anchors.append(np.concatenate([[np.uint64(0)], steps]) + np.uint64(r["first"]))
        codes.append(unpacked(r["segments"], SEGMENT_BYTES))
        ids = np.frombuffer(r["doc_ids"], np.int64)
        docs.append(ids[unpacked(r["docs"], r["doc_bytes"]).astype(np.int64)])
    anchor, code, doc = (np.concatenate(x) for x in (anchors, codes, docs))
    order = np.lexsort((doc, code, anchor))
    a, c, d = anchor[order], code[order], doc[order]
    new_anchor = np.ones(len(a), bool)
    new_anchor[1:] = a[1:] != a[:-1]
    new = new_anchor.copy()
    new[1:] |= c[1:] != c[:-1]
    segment, of = np.cumsum(new) - 1, np.cumsum(new_anchor) - 1
    smallest = d[new]  # of each distinct segment
    repeated = d > smallest[segment]
    # An anchor is open if it has different segments, not all of one document.
    firsts = np.flatnonzero(new_anchor[new])
    low = np.minimum.reduceat(smallest, firsts)
    high = np.maximum.reduceat(smallest, firsts)
    verdict = np.where(repeated, REPEATED, np.where((high > low)[of], OPEN, ALONE))
    verdicts = np.empty(len(a), np.uint8)
    verdicts[order] = verdict
    answers, at = [], 0
    for r in rows:
        own = verdicts[at : at + r["size"]].tobytes()
        answers.append({"bucket": r["bucket"], "block": r["block"], "verdicts": own})
        at += r["size"]
    return pa.Table.from_pylist(answers, schema=_VERDICT)


def _joined(table: pa.Table, column: str) -> bytes:
    """The answers of all buckets to a block, in the order of the buckets."""
    found = zip(table.column("bucket").to_pylist(), table.column(column).to_pylist())
    return b"".join(x for _, x in sorted(found))


def _cases(b: Blocks, verdicts: DataFrame, length: int) -> DataFrame:
    """The texts of the open segments, each from its smallest document."""
    n_buckets = b.n_buckets

    def run(docs: pa.Table, found: pa.Table) -> pa.Table:
        if not docs.num_rows:
            return pa.Table.from_pylist([], schema=_CASE)
        s = Segments(docs, length)
        verdict = np.frombuffer(_joined(found, "verdicts"), np.uint8)
        block = docs.column("block")[0].as_py()
        rows = []
        for bucket, i, j in s.buckets(n_buckets):
            chosen = s.first[i:j][verdict[i:j] == OPEN]
            if len(chosen):
                texts = [
                    s.texts[d][a : e + length - 1]
                    for d, a, e in zip(s.doc[chosen], s.start[chosen], s.end[chosen])
                ]
                rows.append(
                    {
                        "bucket": bucket, "block": block, "text": b"".join(texts),
                        "sizes": np.array([len(t) for t in texts], np.int32).tobytes(),
                        "doc_ids": s.ids[s.doc[chosen]].tobytes(),
                    }
                )
        return pa.Table.from_pylist(rows, schema=_CASE)

    return b.docs.groupBy("block").cogroup(verdicts.groupBy("block")).applyInArrow(run, CASE)


class SuffixArray:
    """The suffixes of a text in the order of their first 56 bytes at least.

    Only suffixes smaller than their successors (S) are sorted directly. A scan
    over the buckets of first bytes, from small to large, then puts each other
    suffix (L) behind those of its bucket whose successors came before its own. Beyond
    its end the text counts as 0xFF.

    ``wanted`` marks the suffixes to sort, all by default. What the scan needs
    for them is each S that a wanted suffix is or comes to first, and the L between.
    """

    DEPTH = 56

    def __init__(self, text: np.ndarray, wanted: np.ndarray | None = None) -> None:
        n = self.n = len(text)
        padded = np.concatenate([text, np.full(self.DEPTH + 8, 0xFF, np.uint8)])
        words, bits = padded.astype(np.uint64), 8
        for span in (1, 2, 4):
            words = (words[:-span] << np.uint64(bits)) | words[span:]
            bits *= 2
        self.words = words  # the 8 bytes from each place on, as one number
        self.text = text.astype(np.int16)
        if not n or wanted is not None and not wanted.any():
            self.order = np.zeros(0, np.int64)
            return
        smaller = self._smaller()
        if wanted is None:
            self.order = self._induced(smaller, np.ones(n, bool))
            return
        next_smaller = np.where(smaller, np.arange(n), n - 1)
        next_smaller = np.minimum.accumulate(next_smaller[::-1])[::-1]
        reach = np.bincount(np.flatnonzero(wanted), minlength=n + 1).astype(np.int64)
        reach -= np.bincount(next_smaller[wanted] + 1, minlength=n + 1)
        order = self._induced(smaller, np.cumsum(reach[:n]) > 0)
        self.order = order[wanted[order]]

    def _smaller(self) -> np.ndarray:
        """Which suffixes are smaller than their successors."""
        step = np.diff(self.text, append=np.int16(0x100))
        decided = np.where(step != 0, np.arange(self.n), self.n - 1)
        decided = np.minimum.accumulate(decided[::-1])[::-1]  # where a run of equal bytes ends
        return step[decided] > 0

    def _induced(self, smaller: np.ndarray, needed: np.ndarray) -> np.ndarray:
        text = self.text
        own = np.flatnonzero(smaller & needed)
        keys = [self.words[own + at] for at in range(self.DEPTH - 8, -1, -8)]
        own = own[np.lexsort(keys)]
        starts = np.searchsorted(text[own], np.arange(257))
        larger: list[list[np.ndarray]] = [[] for _ in range(256)]
        order = []
        for byte in range(256):
            bucket = []
            ready = larger[byte]
            while ready:
                # Predecessors with the same byte are larger too and come next.
                got = np.concatenate(ready)
                bucket.append(got)
                before = got[got > 0] - 1
                before = before[(text[before] == byte) & needed[before]]
                ready = [before] if len(before) else []
            bucket.append(own[starts[byte] : starts[byte + 1]])
            full = np.concatenate(bucket)
            order.append(full)
            before = full[full > 0] - 1
            first = text[before]
            larger_too = (first > byte) & needed[before]
            before, first = before[larger_too], first[larger_too]
            by = np.argsort(first, kind="stable")
            before, first = before[by], first[by]
            cut = np.searchsorted(first, np.arange(257))
            for b in np.unique(first):
                larger[b].append(before[cut[b] : cut[b + 1]])
        return np.concatenate(order)

    def common_prefixes(self, order: np.ndarray, most: int) -> np.ndarray:
        """How many bytes each suffix of ``order`` shares with the one before, up to ``most``."""
        shared = np.zeros(len(order), np.int64)
        going = np.ones(len(order), bool)
        going[:1] = False
        for at in range(0, min(most + 7, self.DEPTH) // 8 * 8, 8):
            i = np.flatnonzero(going)
            differ = self.words[order[i] + at] ^ self.words[order[i - 1] + at]
            same = np.full(len(i), 8)
            for k in range(8):
                same[differ >= np.uint64(1 << (8 * k))] = 7 - k
            shared[i] += same
            going[i[same < 8]] = False
        return np.minimum(shared, most)


def repeated_windows(text: bytes, sizes: np.ndarray, ids: np.ndarray, length: int) -> np.ndarray:
    """For each place of the joined segments whether its window is in a smaller document too."""
    ends = np.repeat(np.cumsum(sizes), sizes)
    doc = np.repeat(ids, sizes)
    whole = np.arange(len(text)) + length <= ends  # the window lies in its segment
    array = SuffixArray(np.frombuffer(text, np.uint8), whole)
    order = array.order
    runs = np.flatnonzero(array.common_prefixes(order, length) < length)
    found = np.zeros(len(text), bool)
    if len(order):
        smallest = np.minimum.reduceat(doc[order], runs)
        of = np.repeat(smallest, np.diff(np.append(runs, len(order))))
        found[order] = doc[order] > of
    return found


def _sorted_cases(length: int):
    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        sizes = [np.frombuffer(r["sizes"], np.int32) for r in rows]
        found = repeated_windows(
            b"".join(r["text"] for r in rows),
            np.concatenate(sizes),
            np.concatenate([np.frombuffer(r["doc_ids"], np.int64) for r in rows]),
            length,
        )
        findings, at = [], 0
        for r in rows:
            own = found[at : at + len(r["text"])].astype(np.uint8).tobytes()
            at += len(r["text"])
            findings.append({"bucket": r["bucket"], "block": r["block"], "windows": own})
        return pa.Table.from_pylist(findings, schema=_FINDING)

    return run


def _take_out(b: Blocks, answers: DataFrame, length: int) -> DataFrame:
    def run(docs: pa.Table, found: pa.Table) -> pa.Table:
        s = Segments(docs, length)
        verdict, windows = (
            np.frombuffer(_joined(found.filter(found[c].is_valid()), c), np.uint8)
            for c in ("verdicts", "windows")
        )
        chosen = s.first[verdict == OPEN]
        widths = s.end[chosen] - s.start[chosen] + length - 1
        at_window = np.full(len(s.first), -1, np.int64)
        if len(chosen):
            at_window[verdict == OPEN] = np.cumsum(widths) - widths
        # A segment goes as a whole if its document is not the first with it.
        mine = s.place
        whole = (s.ids[s.doc] > s.ids[s.doc[s.first[mine]]]) | (verdict[mine] == REPEATED)
        part = ~whole & (verdict[mine] == OPEN)
        marks = [np.zeros(len(t) + 1, np.int64) for t in s.texts]
        for d, a, e in zip(s.doc[whole], s.start[whole], s.end[whole]):
            marks[d][a] += 1
            marks[d][e + length - 1] -= 1
        for d, a, e, i in zip(s.doc[part], s.start[part], s.end[part], at_window[mine[part]]):
            hits = np.flatnonzero(windows[i : i + e - a])
            if len(hits):
                np.add.at(marks[d], a + hits, 1)
                np.add.at(marks[d], a + hits + length, -1)
        rows = []
        for doc_id, text, mark in zip(s.real_ids, s.texts, marks):
            gone = np.cumsum(mark[:-1]) > 0
            edge = np.diff(gone.astype(np.int8), prepend=0, append=0)
            kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
            starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
            rows.append(
                {
                    "doc_id": doc_id, "n_bytes": len(text), "n_removed": len(text) - len(kept),
                    "n_spans": len(starts), "span_starts": starts, "span_ends": ends, "kept": kept,
                }
            )
        return pa.Table.from_pylist(rows, schema=_KEPT)

    return b.docs.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, KEPT)


def without_repeats(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    **block_sizes: int,
) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, the spans, and the bytes kept.

    Every byte goes that a ``length``-byte string covers which also starts in a
    document with a smaller doc_id; the input decides, not what is left. Matches
    never cross documents. ``span_starts`` and ``span_ends`` are the maximal
    removed runs.

    Nulls and empty texts have no bytes, and texts shorter than ``length`` stay.
    Rows with the same doc_id do not remove from each other. Null doc_ids count
    as larger than all others and do not remove from each other. An empty table
    gives no rows; other columns are not read.

    Segments count as equal when 48 bits of their anchor's hash and 48 of their
    own agree; all other matches are compared byte by byte.
    """
    if not GRAM < length <= SuffixArray.DEPTH:
        raise ValueError(f"length must lie between {GRAM + 1} and {SuffixArray.DEPTH}")
    b = blocks(df, id_col, text_col, **block_sizes)
    verdicts = _ask(b, length).groupBy("bucket").applyInArrow(_judge, VERDICT)
    cases = _cases(b, verdicts, length)
    findings = cases.groupBy("bucket").applyInArrow(_sorted_cases(length), FINDING)
    answers = verdicts.unionByName(findings, allowMissingColumns=True)
    return _take_out(b, answers, length)
