"""Exact, near and passage duplicates against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from odd_rows import rows_of
from hypothesis import given, settings
from hypothesis import strategies as st

from freightlens.llm import components, exact_dedup, multi_index, simhash, suffix_dedup

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def union(n, pairs):
    """The smallest index connected to each."""
    root = list(range(n))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in pairs:
        p, q = top(a), top(b)
        root[max(p, q)] = min(p, q)
    return [top(i) for i in range(n)]


def key(x):
    return tuple((v is None, v if v is not None else 0) for v in x)


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_exact(spark, odd_pairs, keep):
    groups: dict[str, list] = {}
    for i, t in odd_pairs:
        groups.setdefault((t or "").translate(LOWER), []).append(i)
    best = {"smallest": min, "largest": max}[keep]
    want = []
    for i, t in odd_pairs:
        text = (t or "").translate(LOWER)
        ids = [x for x in groups[text] if x is not None]
        stays = best(ids) if ids else None
        want.append((i, stays, len(groups[text]), i == stays, hashlib.sha256(text.encode()).hexdigest()))
    df = rows_of(spark, odd_pairs)
    got = [tuple(r) for r in exact_dedup.exact_duplicates(df, keep=keep).collect()]
    assert sorted(got, key=key) == sorted(want, key=key)
    kept = exact_dedup.without_duplicates(df, keep=keep)
    assert kept.columns == df.columns
    assert sorted((r.text or "").translate(LOWER) for r in kept.collect()) == sorted(groups)


def test_exact_merges_runs_in_rounds(spark):
    pairs = [(i, "hot" if i % 3 else f"text {i}") for i in range(600)]
    groups = exact_dedup.exact_groups(rows_of(spark, pairs), runs=27, fan_in=3)
    assert groups.agg({"group_size": "max"}).first()[0] == 400 and groups.count() == 201


def test_components(spark):
    r = random.Random(2)
    links = [(i, i + 1) for i in range(40)] + [(r.randint(50, 300), r.randint(50, 300)) for _ in range(150)]
    links += [(400, 400), (None, 7)] + [(500, i) for i in range(501, 560)]
    got = {x.node: x.root for x in components.components(spark.createDataFrame(links, "a long, b long")).collect()}
    real = [(a, b) for a, b in links if a is not None and a != b]
    want = union(600, real)
    assert got == {i: want[i] for pair in real for i in pair}


def brute_fingerprint(text: str) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", text.translate(LOWER))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def test_simhash(spark, odd_pairs):
    r = random.Random(7)
    words = [f"w{i}" for i in range(300)]
    base = [[r.choice(words) for _ in range(400)] for _ in range(12)]
    pairs = list(odd_pairs)
    for k in range(90):
        text = list(r.choice(base))
        for _ in range(r.randint(0, 3)):
            text[r.randrange(len(text))] = r.choice(words)
        pairs.append((100 + k, " ".join(text)))
    fps = [brute_fingerprint(t or "") for _, t in pairs]
    near = [(a, b) for a in range(len(fps)) for b in range(a) if (fps[a] ^ fps[b]).bit_count() <= 4]
    roots = union(len(fps), near)
    smallest: dict[int, int] = {}
    for (i, _), root in zip(pairs, roots):
        if i is not None:
            smallest[root] = min(smallest.get(root, i), i)
    want = [(i, f"{f:016x}", smallest.get(root)) for (i, _), f, root in zip(pairs, fps, roots)]
    got = [tuple(x) for x in simhash.near_duplicates(rows_of(spark, pairs)).collect()]
    assert sorted(got, key=key) == sorted(want, key=key)
    assert simhash.near_duplicates(rows_of(spark, [])).collect() == []


def test_simhash_links_with_many_blocks(spark, monkeypatch):
    r = np.random.default_rng(3)
    base = r.integers(0, 1 << 63, 20, dtype=np.uint64)
    fps = np.unique([int(b) ^ (1 << int(i)) ^ (1 << int(j)) for b in base for i, j in r.integers(0, 64, (40, 2))])
    fps = fps.astype(np.uint64)
    monkeypatch.setattr(simhash, "BLOCK", 16)
    nodes = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    place = {int(x): i for i, x in enumerate(fps.view(np.int64))}
    got = [(place[x.a], place[x.b]) for x in simhash.links(nodes).collect()]
    near = [(a, b) for a in range(len(fps)) for b in range(a) if int(fps[a] ^ fps[b]).bit_count() <= 4]
    assert all(int(fps[a] ^ fps[b]).bit_count() <= 4 for a, b in got)
    assert union(len(fps), got) == union(len(fps), near)


@settings(max_examples=150, deadline=None)
@given(st.binary(max_size=300) | st.text("ab", max_size=300).map(str.encode))
def test_suffix_array(text):
    array = suffix_dedup.SuffixArray(np.frombuffer(text, np.uint8))
    padded = text + b"\xff" * 64
    sorted_ = [padded[i : i + 56] for i in array.order]
    assert sorted(array.order.tolist()) == list(range(len(text)))
    assert sorted_ == sorted(sorted_)
    for k, shared in enumerate(array.common_prefixes(array.order, 50)):
        if k:
            a, b = sorted_[k - 1], sorted_[k]
            assert shared == next((j for j in range(50) if a[j] != b[j]), 50)


@settings(max_examples=150, deadline=None)
@given(st.text("ab", min_size=1, max_size=200).map(str.encode), st.randoms())
def test_suffixes_that_are_wanted(text, r):
    letters = np.frombuffer(text, np.uint8)
    wanted = np.array([r.random() < 0.3 for _ in text])
    whole = suffix_dedup.SuffixArray(letters)
    some = suffix_dedup.SuffixArray(letters, wanted)
    padded = text + b"\xff" * 64
    want = [padded[i : i + 56] for i in whole.order if wanted[i]]
    assert [padded[i : i + 56] for i in some.order] == want
    assert sorted(some.order.tolist()) == np.flatnonzero(wanted).tolist()


def brute_passages(pairs, length=50):
    first: dict[bytes, float] = {}
    place = [float("inf") if i is None else i for i, _ in pairs]
    data = [(t or "").encode() for _, t in pairs]
    for p, b in zip(place, data):
        for a in range(len(b) - length + 1):
            w = b[a : a + length]
            first[w] = min(first.get(w, p), p)
    found = []
    for (i, _), p, b in zip(pairs, place, data):
        gone = bytearray(len(b))
        for a in range(len(b) - length + 1):
            if first[b[a : a + length]] < p:
                gone[a : a + length] = b"\x01" * length
        spans = sum(1 for j, g in enumerate(gone) if g and not (j and gone[j - 1]))
        found.append((i, len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return found


@pytest.mark.parametrize("block_bytes", [2_000, 10_000_000])
def test_passages(spark, odd_pairs, block_bytes):
    r = random.Random(5)
    shared = ["".join(r.choice("ab cd") for _ in range(r.randint(30, 200))) for _ in range(10)]
    shared += ["aé漢" * 40, "x" * 300]
    pairs = [(i, t if t is None else t[:2000]) for i, t in odd_pairs]
    for i in range(150):
        bits = [
            r.choice(shared)[r.randint(0, 20) :] if r.random() < 0.5
            else "".join(r.choice("abcdefgh ") for _ in range(60))
            for _ in range(r.randint(0, 4))
        ]
        pairs.append((r.choice([1000 + i, 1000 + i, None, 7]), "".join(bits)))
    found = suffix_dedup.without_repeats(
        rows_of(spark, pairs), block_bytes=block_bytes, bucket_bytes=2 * block_bytes
    ).collect()
    got = [(x.doc_id, x.n_bytes, x.n_removed, x.n_spans, bytes(x.kept)) for x in found]
    assert sorted(got, key=key) == sorted(brute_passages(pairs), key=key)
    assert all(sum(b - a for a, b in zip(x.span_starts, x.span_ends)) == x.n_removed for x in found)
    assert suffix_dedup.without_repeats(rows_of(spark, [])).collect() == []


def vectors():
    r = np.random.default_rng(0)
    rows = []
    for _ in range(40):
        base = r.normal(size=16)
        rows += [(base + r.normal(size=16) * s).tolist() for s in (0, 0.05, 0.12, 0.2)]
    rows += [rows[0], rows[0], [0.0] * 16, [float("nan")] + [1.0] * 15, None, [1.0, 2.0], [2.0, 4.0], []]
    rows += [[None] + [1.0] * 15, [float("inf")] + [1.0] * 15, [1e300] * 16, [2e300] * 16]
    return [(i, v, None if i % 29 == 3 else i % 2) for i, v in enumerate(rows)] + [(None, rows[0], 0)]


@pytest.mark.parametrize("block", [2048, 4])
def test_embeddings(spark, monkeypatch, block):
    monkeypatch.setattr(multi_index, "BLOCK", block)
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    usable = [
        i is not None and y is not None and bool(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)
        for i, v, y in rows
    ]
    unit = [np.array(v) / np.abs(v).max() if ok else None for (_, v, _), ok in zip(rows, usable)]
    unit = [u if u is None else u / np.linalg.norm(u) for u in unit]
    links = [
        (a, b)
        for a in range(len(rows))
        for b in range(a)
        if usable[a] and usable[b] and rows[a][2] == rows[b][2] and len(unit[a]) == len(unit[b])
        and unit[a] @ unit[b] >= 0.93
    ]
    roots = union(len(rows), links)
    n = np.bincount(np.array(links).ravel(), minlength=len(rows))
    want = [(i, int(n[k]), None if i is None else rows[roots[k]][0], i is None or roots[k] == k) for k, (i, _, _) in enumerate(rows)]
    found = multi_index.near_duplicates(df, cells_per_half=4, target_recall=1.0)
    got = [(x.vec_id, x.n_links, x.component_id, x.kept) for x in found.collect()]
    assert sorted(got, key=key) == sorted(want, key=key)
    assert multi_index.near_duplicates(df.limit(0)).collect() == []


def test_target_recall(spark):
    r = np.random.default_rng(1)
    base = r.normal(size=(300, 16))
    rows = np.concatenate([base, base + r.normal(size=base.shape) * 0.12])
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(rows)], "vec_id long, embedding array<double>, label int")
    unit = rows / np.linalg.norm(rows, axis=1)[:, None]
    all_links = (unit @ unit.T >= 0.93).sum() - len(rows)
    found = multi_index.near_duplicates(df, target_recall=0.95).agg({"n_links": "sum"}).first()[0]
    assert 0.9 * all_links <= found <= all_links
    whole = multi_index.near_duplicates(df).agg({"n_links": "sum"}).first()[0]
    assert whole >= 0.999 * all_links
