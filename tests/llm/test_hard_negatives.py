"""Hard negatives against brute force in plain Python."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from freightlens.llm import hard_negatives as hn


def brute(rows, ask, n_positives=5, n_negatives=3, lowest=50, highest=95):
    """rows: (id, vector, label); of repeated ids the one with the smallest (label, vector) counts."""
    whole = {}
    for i, v, label in rows:
        if None in (i, v, label) or any(x is None or not math.isfinite(x) for x in v):
            continue
        x = (label, [math.floor(256 * float(x)) for x in v])
        whole[i] = min(whole.get(i, x), x)

    def score(a, b):
        return sum(x * y for x, y in zip(whole[a][1], whole[b][1]))

    found = []
    for a in filter(ask, whole):
        ranked = sorted((b for b in whole if b != a), key=lambda b: (-score(a, b), b))
        for p in [b for b in ranked if whole[b][0] == whole[a][0]][:n_positives]:
            own = score(a, p)
            hard = [
                b
                for b in ranked
                if whole[b][0] != whole[a][0] and lowest * own <= 100 * score(a, b) <= highest * own
            ]
            found += [(a, p, r + 1, b, own, score(a, b)) for r, b in enumerate(hard[:n_negatives])]
    return sorted(found)


def mined(spark, rows, every=5, **options):
    names = "id long, c long, a long, v string, row string, asks string, planes binary"
    df = spark.createDataFrame(
        [(*r, *[None] * 7) for r in rows],
        f"vec_id long, embedding array<float>, label int, {names}",
    )
    found = hn.mine(df, anchor=F.expr(f"vec_id % {every} = 0"), **options)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, found.collect()))


def vectors(n, dims, seed, hot=0.0, spread=1.0):
    r = np.random.default_rng(seed)
    centre = r.normal(size=dims)
    rows = []
    for i in range(n):
        v = (centre + spread * r.normal(size=dims)).astype(np.float32).tolist()
        rows.append((i, v, 1 if r.random() < hot else int(r.integers(4))))
    return rows


@pytest.mark.parametrize("rows_a_block, anchors_a_block", [(4096, 2048), (16, 7)])
def test_blocks_of_any_size(spark, rows_a_block, anchors_a_block):
    """A label with a third of the rows, and 13 dimensions, which do not fill the last byte."""
    rows = vectors(160, 13, 1, hot=0.33, spread=1.5)
    want = brute(rows, lambda i: i % 5 == 0)
    assert len(want) > 100
    assert mined(spark, rows, rows_a_block=rows_a_block, anchors_a_block=anchors_a_block) == want


def test_odd_rows(spark):
    """Nulls, odd components, empty and zero vectors, other lengths, ties, repeated ids, negative ids."""
    r = random.Random(3)
    rows = vectors(60, 9, 2, spread=0.7)
    rows += [(100 + i, rows[0][1], i % 3) for i in range(12)]
    rows += [(5, rows[1][1], 0), (5, rows[2][1], 0), (5, rows[2][1], 0), (7, rows[3][1], None)]
    rows += [(-10, rows[4][1][:5], 2), (-20, [*rows[5][1], 1.0, 2.0, -3.0, 4.0, 5.0, 6.0, 7.0, 8.0], 1)]
    rows += [(200, [], 0), (205, [0.0] * 9, 1), (None, rows[6][1], 1), (210, None, 1)]
    rows += [(215, [None] * 9, 1), (220, [math.nan] * 9, 1), (225, [math.inf] * 9, 2), (230, [1e4] * 9, 3)]
    r.shuffle(rows)
    for size in (4096, 8):
        assert mined(spark, rows, rows_a_block=size, anchors_a_block=size) == brute(rows, lambda i: i % 5 == 0)


def test_no_rows_no_anchors_no_positives(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 0), (2, [1.0], 0), (3, [0.9], 1)]) == []
    assert mined(spark, [(0, [1.0], 0), (2, [1.0], 1), (3, [0.9], 2)]) == []


def test_the_whole_given_table(spark, folder):
    df = spark.read.parquet(f"{folder}/embeddings.parquet")
    label = F.expr("if(vec_id % 7 = 0, (label + 1) % 10, label)")
    rows = [tuple(r) for r in df.select("vec_id", "embedding", label).collect()]
    got = hn.mine(df, anchor=F.expr("vec_id % 50 = 0"), label=label, rows_a_block=300)
    assert sorted(map(tuple, got.collect())) == brute(rows, lambda i: i % 50 == 0)


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 40), st.integers(1, 20), st.integers(0, 40), st.integers(0, 2**32 - 1))
def test_looked_up_sums_are_inner_products(n, dims, bits, seed):
    r = np.random.default_rng(seed)
    a, b = (r.integers(-(2**s), 2**s, (m, dims)) for s, m in ((bits // 2, 3), (bits, n)))
    found = hn.scores(hn.subset_sums(a, np.int64), hn.bit_planes(b).astype(np.intp))
    assert (found == b @ a.T).all()
