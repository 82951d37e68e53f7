"""Quality scores, licences, language-model scores, mixing and the pipeline."""

from __future__ import annotations

import textwrap
import zlib

import numpy as np
import pytest
from odd_rows import rows_of
from pyspark.sql import functions as F

import corpus_pipeline
from freightlens.llm import backoff_lm, licences, mixing, nbsvm, queries
from freightlens.llm.oracles import ORACLES
from oracle_check import connect, difference

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", ORACLES)
def test_same_result_as_sql(spark, duck, name):
    assert difference(queries.QUERIES[name](spark, FOLDER), duck, ORACLES[name]) is None


def test_licences(spark, odd_pairs):
    apache = (
        "Licensed under the Apache License, Version 2.0. You may not use this file except in "
        "compliance with the License. You may obtain a copy of the License at:\nhttp://x"
    )
    texts = {
        1: (apache, ["Apache-2.0"], 0),
        2: ("Some words. Released under the MIT License.\nMore.", ["MIT"], 0),
        3: ("Licensed under CC BY-NC 4.0.\n" + apache, ["Apache-2.0", "CC-BY-NC-4.0"], 0),
        4: ("All rights reserved.", [], 1),
        5: ("Redistributions of source code must retain the above copyright notice, this list of "
            "conditions and the following disclaimer.", [], 1),
        6: ("He licensed the MIT license to us", [], 0),
    }
    df = rows_of(spark, [(i, t) for i, (t, _, _) in texts.items()] + [(i, t) for i, t in odd_pairs])
    found = [r for r in licences.scan(df).collect()]
    assert len(found) == len(texts) + len(odd_pairs)
    hits = {r.doc_id: (r.licences, r.n_unmatched) for r in found if r.licences or r.n_unmatched}
    assert hits == {i: (l, n) for i, (_, l, n) in texts.items() if l or n}
    assert licences.scan(rows_of(spark, [])).collect() == []
    with pytest.raises(ValueError):
        licences.scan(df, sentences={"Not Normal license": "x"})


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE."""
BSD_2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
BSD_3 = BSD_2 + """

3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."""
GPL = """This program is free software{0} you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation{1} either version {2} of the License, or (at your option) any later version.

This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the GNU General Public License for more details."""
NOTICES = [
    ("MIT", MIT, 3),
    ("BSD-2-Clause", BSD_2, 3),
    ("BSD-3-Clause", BSD_3, 4),
    ("GPL-3.0-or-later", GPL.format(":", ",", 3), 2),
    ("GPL-2.0-or-later", GPL.format(";", ";", 2), 2),
]


def test_verbatim_notices_as_they_are_wrapped(spark):
    def wrapped(text, width, before):
        lines = [line for block in text.split("\n\n") for line in [*textwrap.wrap(block, width), ""]]
        return "\n".join(before + line for line in lines)

    cases = [(name, f"Some words.\n\n{wrapped(text, width, before)}\nint main;", n)
             for name, text, n in NOTICES for width in (40, 72, 80, 10_000) for before in ("", "# ", " * ")]
    df = rows_of(spark, [(i, text) for i, (_, text, _) in enumerate(cases)])
    found = {r.doc_id: r for r in licences.scan(df).collect()}
    for i, (name, _, n) in enumerate(cases):
        r = found[i]
        assert (r.licences, len(r.sentence_ids), r.n_unmatched) == ([name], n, 0), cases[i]


def test_a_sentence_does_not_run_on_over_hard_ends(spark):
    texts = ["Released under the\n\nMIT License", "Released under the. MIT License", "Released under the~MIT License", "Released under the MIT License, or not", "He released under the\nMIT License"]
    found = licences.scan(rows_of(spark, list(enumerate(texts)))).collect()
    assert sorted(r.doc_id for r in found if r.licences) == [2]


def test_rules_keep_their_order():
    assert all(i in licences.SENTENCES.values() for _, ids in licences.RULES for i in ids)
    for k, (_, ids) in enumerate(licences.RULES):
        assert not any("".join(f"<{x}>" for x in ids) in "".join(f"<{x}>" for x in later) for _, later in licences.RULES[k + 1 :])


def test_quality_learns_and_never_sees_what_is_held_out(spark):
    clean = "the quick brown fox walks over some calm fields and rests"
    junk = "BUY!! NOW!! CHEAP!! BUY!! NOW!! CHEAP!!"
    docs = rows_of(spark, [(i, f"{clean if i % 2 else junk} {i}") for i in range(300)] + [(None, None), (900, "")])
    labels = spark.createDataFrame([(i, i % 2, "x") for i in range(300)] + [(None, 1, "x"), (5, None, "x")], "doc_id long, quality int, text string")
    model = nbsvm.train(docs, labels, most_rows=80)
    found = nbsvm.score(docs, model).collect()
    assert len(found) == 302 and all(0 <= r.score <= 1 for r in found)
    for r in found:
        held_out = r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1
        assert r.held_out == held_out
        if r.doc_id is not None and r.doc_id < 300:
            assert r.predicted == r.doc_id % 2
    wrong = labels.withColumn("quality", F.when(nbsvm.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    again = nbsvm.train(docs, wrong, most_rows=80)
    assert np.array_equal(model.weights, again.weights) and model.bias == again.bias
    assert nbsvm.keep_good(docs, model).columns == docs.columns
    nothing = nbsvm.train(docs, labels.limit(0))
    assert nothing.score("x", nbsvm.known_words()) == pytest.approx(0.5)
    assert nbsvm.score(docs.limit(0), model).collect() == []


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    found = queries.op4_quality_classifier(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id")
    held = found.filter("held_out").agg(F.avg((F.col("predicted") == F.col("quality")).cast("int"))).first()[0]
    assert held > 0.95


def brute_scores(pairs, order, discount=0.4):
    docs = [(t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")).encode().split() for _, t in pairs]
    grams = lambda w: [tuple(w[i : i + n]) for n in range(1, order + 1) for i in range(len(w) - n + 1)]
    total: dict = {}
    for w in docs:
        for g in grams(w):
            total[g] = total.get(g, 0) + 1
    words = sum(map(len, docs))
    out = []
    for w in docs:
        own: dict = {}
        for g in grams(w):
            own[g] = own.get(g, 0) + 1
        count = lambda g: total[g] - own[g]  # noqa: E731,B023
        score = 0.0
        for i in range(len(w)):
            for n in range(min(order, i + 1), 0, -1):
                g = tuple(w[i - n + 1 : i + 1])
                if n == 1:
                    score += np.log(max(count(g), 0.5) / max(words - len(w), 1))
                elif count(g) > 0:
                    score += np.log(count(g) / count(g[:-1]))
                    break
                else:
                    score += np.log(discount)
        out.append((len(w), score))
    return out


def test_hashed_words(odd_pairs):
    texts = [(t or "").encode() for _, t in odd_pairs] + [b"x" * k + b" " + b"X" * k for k in (7, 8, 9, 63, 64, 65, 500)]
    texts += [b"a\x0bB\x0cc\td\xa0e\r\n f", b"a\x00 a", b"a\x00", b"\x00", b"\x00\x00"]
    hashes, place = backoff_lm.hashed_words(texts)
    words = [w for t in texts for w in t.lower().split()]
    assert np.bincount(place, minlength=len(texts)).tolist() == [len(t.split()) for t in texts]
    assert len(set(words)) == len(set(hashes.tolist())) == len(set(zip(words, hashes.tolist(), strict=True)))
    assert backoff_lm.hashed_words([])[0].size == backoff_lm.hashed_words([b"", b" "])[0].size == 0


@pytest.mark.parametrize("order, block_bytes", [(1, 1000), (2, 1000), (3, 1000), (4, 1000), (3, 100_000_000)])
def test_backoff(spark, odd_pairs, order, block_bytes):
    found = backoff_lm.score(rows_of(spark, odd_pairs), order=order, block_bytes=block_bytes, bucket_bytes=block_bytes).collect()
    got = sorted((r.n_words, round(r.log_score, 6)) for r in found)
    assert got == [(n, pytest.approx(s, abs=1e-5)) for n, s in sorted((n, round(s, 6)) for n, s in brute_scores(odd_pairs, order))]
    assert all((r.mean_log_score is None) == (r.n_words == 0) for r in found)
    assert backoff_lm.score(rows_of(spark, [])).collect() == []


def test_raking_meets_the_targets(spark):
    cells = [(s, l, 100 * (i + 1) * (j + 2)) for i, s in enumerate("abc") for j, l in enumerate("xy")]
    cells.append(("d", "x", 0))
    df = spark.createDataFrame(cells, "source string, lang string, tokens long")
    raked = mixing.rake(df, {"source": {"a": 0.5}, "lang": {"x": 0.7, "missing": 0.1}}).toPandas()
    assert raked.weight.sum() == pytest.approx(1)
    assert raked[raked.source == "a"].weight.sum() == pytest.approx(0.5)
    by_lang = raked.groupby("lang").weight.sum()
    assert by_lang["x"] == pytest.approx(0.7 / 0.9)
    assert "d" not in set(raked.source)


def test_few_and_many_cells_agree(spark, monkeypatch):
    cells = [(s, l, 10 * (i + 1) + j) for i, s in enumerate("abcd") for j, l in enumerate("xyz")]
    df = spark.createDataFrame(cells, "source string, lang string, tokens long")
    targets = {"source": {"a": 0.4, "b": 0.1}, "lang": {"x": 0.5}}
    few = mixing.rake(df, targets).toPandas().sort_values(["source", "lang"])
    monkeypatch.setattr(mixing, "FEW_CELLS", 3)
    many = mixing.rake(df, targets, rounds=4).toPandas().sort_values(["source", "lang"])
    assert np.allclose(few.weight, many.weight, atol=1e-6)


def test_mix(spark, odd_pairs):
    pairs = odd_pairs + [(1000 + i, "one two three four") for i in range(400)]
    df = rows_of(spark, pairs).withColumn("lang", F.when(F.col("doc_id") % 4 > 0, "en"))
    targets = {"lang": {"en": 0.5, "(none)": 0.5}}
    marginals = {"lang": F.col("lang")}
    found = mixing.mix(df, targets, marginals, size=0.5)
    total = found.agg(F.sum("tokens"), F.sum(F.col("probability") * F.col("tokens"))).first()
    assert total[1] == pytest.approx(0.5 * total[0])
    rows = found.collect()
    assert len(rows) == len(pairs)
    assert all(int(r.probability) <= r.copies <= int(r.probability) + 1 for r in rows)
    kept = mixing.sample(df, targets, marginals, size=0.5)
    assert kept.columns == df.columns
    assert kept.count() == sum(r.copies > 0 for r in rows)
    assert mixing.mix(df.limit(0), targets, marginals).collect() == []


def test_sample_meets_the_marginals(spark):
    pairs = [(i, "one two three four" + " five" * (i % 3)) for i in range(6000)]
    df = rows_of(spark, pairs).withColumns(
        {"source": F.when(F.col("doc_id") % 20 == 0, "rare").otherwise("web"), "lang": F.when(F.col("doc_id") % 7 == 0, "de").otherwise("en")}
    )
    targets = {"source": {"rare": 0.3}, "lang": {"de": 0.4}}
    marginals = {"source": F.col("source"), "lang": F.col("lang")}
    out = mixing.sample(df, targets, marginals)
    assert out.columns == df.columns
    wanted = {r.doc_id: r.copies for r in mixing.mix(df, targets, marginals).collect()}
    assert max(wanted.values()) > 4
    rows = out.select("doc_id", "source", "lang", "text").collect()
    got: dict = {}
    for r in rows:
        got[r.doc_id] = got.get(r.doc_id, 0) + 1
    assert got == {i: n for i, n in wanted.items() if n}
    tokens = {i: len(t.split()) for i, t in pairs}
    total = sum(tokens[r.doc_id] for r in rows)
    assert total == pytest.approx(sum(tokens.values()), rel=0.02)
    assert sum(tokens[r.doc_id] for r in rows if r.source == "rare") / total == pytest.approx(0.3, abs=0.01)
    assert sum(tokens[r.doc_id] for r in rows if r.lang == "de") / total == pytest.approx(0.4, abs=0.01)


def test_unnamed_languages_keep_a_share(spark, tmp_path):
    given = spark.read.parquet(f"{FOLDER}/documents.parquet")
    lang = F.when(F.col("doc_id") % 5 == 0, F.lit(None)).when(F.col("doc_id") % 5 == 1, F.lit("it")).otherwise(F.col("lang"))
    docs = given.withColumn("lang", lang)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.op1_source_mixing(spark, str(tmp_path)).toPandas()
    other = found[~found.lang.isin(list(queries.TARGETS["lang"])) & (found.tokens > 0)]
    assert set(other.lang) == {"(none)", "it"}
    assert (other.probability > 0).all() and (other.weight > 0).all() and other.copies.sum() > 0
    langs = corpus_pipeline.mixed(spark, docs, FOLDER).select("lang").distinct().collect()
    assert {None, "it"} <= {r.lang for r in langs}


def test_wanted_shares_with_nothing_left_over(spark):
    cells = spark.createDataFrame([("en", 60), ("de", 20), ("it", 15), ("(none)", 5), ("x", 0)], "lang string, tokens long")
    want = lambda targets: {r.lang: r.want for r in mixing.wanted_shares(cells, "lang", targets).collect()}
    assert want({"en": 0.5, "de": 0.5}) == pytest.approx({"en": 0.4, "de": 0.4, "it": 0.15, "(none)": 0.05})
    assert want({"en": 0.5, "de": 0.3, "fr": 0.2}) == pytest.approx({"en": 0.5, "de": 0.3, "it": 0.15, "(none)": 0.05})
    assert want({"en": 1.0, "it": 0.0, "(none)": 0.0}) == pytest.approx({"en": 0.8, "de": 0.2, "it": 0, "(none)": 0})
    assert want({"fr": 1.0, "en": 0.0, "de": 0.0}) == pytest.approx({"en": 0, "de": 0, "it": 0.75, "(none)": 0.25})
    assert want({"en": 0.5, "de": 0.3}) == pytest.approx({"en": 0.5, "de": 0.3, "it": 0.15, "(none)": 0.05})


def test_near_keeps_one_row_of_each_group(spark):
    a, b = (" ".join(f"{p}{i}" for i in range(300)) for p in "xy")
    alone = " ".join(f"z{i}" for i in range(300))
    pairs = [(1, a), (7, a + " more"), (7, alone), (3, b), (3, b + " more"), (3, b), (None, b + " again"),
             (None, "one text of few words"), (None, "One text of few words")]
    found = corpus_pipeline.near(spark, rows_of(spark, pairs), FOLDER)
    assert found.columns == rows_of(spark, []).columns
    got = [(r.doc_id, r.text) for r in found.collect()]
    assert sorted((i or 0, t[0].lower()) for i, t in got) == [(0, "o"), (1, "x"), (3, "y"), (7, "z")]
    assert (7, alone) in got


def test_pipeline(spark, odd_pairs):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        after = stage(spark, docs, FOLDER)
        path = f"{spark.conf.get('spark.checkpoint.dir')}/test-{name.replace(' ', '-')}"
        after.write.mode("overwrite").parquet(path)
        after = spark.read.parquet(path)
        kept[name] = {r.doc_id for r in after.select("doc_id").collect()}
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.columns == docs.columns
        assert kept[name] <= {r.doc_id for r in docs.select("doc_id").collect()}
        docs = after
    assert {r.doc_id for r in corpus_pipeline.run(spark, FOLDER).collect()} == kept["byte-level bpe"]


def test_stages_take_odd_rows(spark, odd_pairs):
    df = rows_of(spark, odd_pairs)
    for _, stage in corpus_pipeline.STAGES:
        stage(spark, df, FOLDER).collect()
        assert stage(spark, df.limit(0), FOLDER).collect() == []
