"""The manifest against a tree built level by level in plain Python."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from freightlens.llm import merkle

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def h(*inputs):
    return hashlib.sha256("".join(inputs).encode()).hexdigest()


def leaf_of(row):
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree(nodes):
    found = [nodes]
    while len(found[-1]) > 1:
        below = found[-1]
        found.append([h(*below[i : i + 2]) for i in range(0, len(below), 2)])
    return found


def path(levels, i):
    """(sibling, whether it is left) by level, None where there is none."""
    found = []
    for level in levels[:-1]:
        at = i ^ 1
        found.append((level[at], at < i) if at < len(level) else None)
        i >>= 1
    return found


def brute(rows):
    """(doc_id, leaf, subroot, root, proof, folded_root, verified) of each (doc_id, source, lang, n_chars, text)."""
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    groups = {}
    for lang in langs:
        own = [(r, leaf_of(r)) for r in rows if r[2] == lang]
        own.sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        groups[lang] = own, tree([leaf for _, leaf in own])
    top = tree([groups[lang][1][-1][0] for lang in langs]) if langs else [[None]]
    root, found = top[-1][0], []
    for g, lang in enumerate(langs):
        own, levels = groups[lang]
        for i, (r, leaf) in enumerate(own):
            steps = path(levels, i) + path(top, g)
            cur = leaf
            if r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0:
                cur = leaf_of((*r[:3], r[3] + 1, r[4]))
            for s in steps:
                cur = h(cur) if s is None else h(s[0], cur) if s[1] else h(cur, s[0])
            proof = "".join(s[0] for s in steps if s)
            found.append((r[0], leaf, levels[-1][0], root, proof, cur, cur == root))
    return found


def manifest(df, **options):
    struck = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    shown = F.when(struck, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    return merkle.manifest(df, FIELDS, tampered={"n_chars": shown}, **options)


def checked(spark, rows, extra="", **options):
    more = extra.split(", ") if extra else []
    df = spark.createDataFrame(
        [(*r, *[None] * len(more)) for r in rows],
        ", ".join(["doc_id long, source string, lang string, n_chars long, text string", *more]),
    )
    got = manifest(df, **options).select(
        "doc_id", "leaf", "subroot", "root", "proof", "folded_root", "verified"
    )
    key = lambda r: tuple((v is None, v if v is not None else 0) for v in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(brute(rows), key=key)


@pytest.mark.parametrize("bits", [1, 3, 12])
def test_several_levels_of_superblocks(spark, bits):
    """One hot group, groups of 1 to 9 rows, and sizes that leave single nodes over."""
    rows = [(i, f"s{i % 3}", "en", i * 7 % 100, f"text {i}") for i in range(75)]
    rows += [(1000 + 10 * n + i, "s", f"l{n}", 5, "x" * i) for n in range(1, 10) for i in range(n)]
    checked(spark, rows, block_bits=bits)


def test_odd_rows(spark):
    """Nulls everywhere, repeated ids and rows, empty and long texts, other scripts, clashing names."""
    long = "très long 漢字 " * 40_000
    rows = [
        (None, None, None, None, None), (None, None, None, None, None), (7, "a", None, 3, ""),
        (7, "a", "", 3, ""), (5, "a", "é", None, long), (5, "a", "é", None, long), (5, "b", "z", 1, "t"),
        (-3, "a", "é", 0, "-"), (9, "1:x", "zz", 2, "5:a"), (14, None, "zz", 2, "\x00"),
    ]
    rows += [(8, "same", "hot", 1, "equal rows")] * 40
    names = "g long, pos long, n string, digest string, tampered int, block int, name string, proof string"
    checked(spark, rows, names, block_bits=2)


def test_one_row_and_none(spark):
    checked(spark, [(14, "a", "en", 2, "t")])
    checked(spark, [])


def test_any_change_is_noticed(spark):
    """A leaf folds to the root only with the values it was made of."""
    df = spark.range(200).selectExpr(
        "id AS doc_id", "'s' AS source", "if(id % 3 = 0, 'de', 'en') AS lang", "id AS n_chars", "'t' AS text"
    )
    for field, other in (("text", F.lit("T")), ("source", F.lit(None)), ("doc_id", F.col("doc_id") + 1)):
        found = merkle.manifest(df, FIELDS, tampered={field: F.when(F.expr("n_chars % 2 = 0"), other).otherwise(F.col(field))}, block_bits=4)
        wrong = {r.place for r in found.filter("NOT verified").collect()}
        assert wrong and found.filter("NOT verified").count() == 100
    assert merkle.manifest(df, FIELDS).filter("NOT verified").isEmpty()
