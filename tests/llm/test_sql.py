"""The SQL counterparts on rows that the given tables lack: wrapped notices, null and unknown values."""

from __future__ import annotations

import textwrap

import duckdb
import pytest
from oracle_check import difference
from test_text import MIT

from freightlens.llm import exact_dedup, nbsvm, simhash
from freightlens.llm.oracles import ORACLES
from freightlens.llm.queries import QUERIES

GPL = (
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
    "Public License as published by the Free Software Foundation, either version 3 of the License, or (at your "
    "option) any later version.\n\nThis program is distributed in the hope that it will be useful, but WITHOUT ANY "
    "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE."
)


def wrapped(text):
    return "\n".join("\n".join(textwrap.wrap(p, 72)) for p in text.split("\n"))


@pytest.fixture()
def odd_folder(spark, tmp_path):
    texts = [
        MIT, wrapped(MIT), GPL, wrapped(GPL), "x\n" + wrapped(MIT) + "\ny", "All rights reserved.",
        "Licensed under CC BY 4.0\nLicensed under the MIT License.", "~ license ~~ all rights reserved ~", None, "",
        "a b c d a b c d a b x", "a b c e", "b c", "License: all\nrights reserved; spdx license identifier: MIT",
    ]
    langs = ["en", None, "zz", "de", "fr", "es", "it"]
    sources = ["src0", "src1", None, "src2"]
    rows = [(i, t, langs[i % 7], sources[i % 4], 1) for i, t in enumerate(texts * 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    df.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents.parquet/*.parquet')")
    return str(tmp_path), con


@pytest.mark.parametrize(
    "name", ["op1_source_mixing", "op5_licence_scan", "op9_backoff_lm", "op10_exact_dedup", "op13_merkle_manifest"]
)
def test_operators_and_sql_agree(spark, odd_folder, name):
    folder, con = odd_folder
    assert difference(QUERIES[name](spark, folder), con, ORACLES[name]) is None


def test_no_column_is_lost(spark):
    rows = [(1, "same text here now", 7, "a"), (2, "same text here now", 8, "b"), (3, "other words are here", 9, "c")]
    df = spark.createDataFrame(rows, "doc_id long, text string, __kept int, __KEPT_ string")
    for found in (exact_dedup.without_duplicates(df), simhash.without_near_duplicates(df)):
        assert found.columns == df.columns
        assert sorted(map(tuple, found.collect())) == [rows[0], rows[2]]


def test_the_sample_is_bounded_by_ids(spark, monkeypatch):
    """Rows that repeat an id neither reach the driver nor count."""
    rows = [(i, f"good words number {i} are here" if i % 2 else f"bad !!! {i} junk") for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    many = df.unionAll(spark.range(3000).selectExpr("id % 40 AS doc_id", "'a copy' AS text"))
    seen = []
    plain = nbsvm.fit
    monkeypatch.setattr(nbsvm, "fit", lambda x, y: seen.append(len(x)) or plain(x, y))
    nbsvm.train(many, labels, most_rows=10)
    assert seen == [10]
