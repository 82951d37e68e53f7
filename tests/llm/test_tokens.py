"""Byte-level BPE and the token store against the libraries."""

from __future__ import annotations

import base64
import random
import zlib
from functools import lru_cache
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pytest
import tiktoken
import tokenizers
from odd_rows import rows_of
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from freightlens.llm import byte_bpe, queries, token_store
from freightlens.llm.chunks import parts


@pytest.fixture(scope="module")
def reference():
    with open(queries.RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=queries.PATTERN, mergeable_ranks=ranks, special_tokens={})


@lru_cache
def library():
    tokenizer = Tokenizer.from_file(queries.TOKENIZER)
    return tokenizer


@pytest.fixture(scope="module")
def coder():
    return byte_bpe.encoder(queries.RANKS, queries.PATTERN)


@settings(max_examples=400, deadline=None)
@given(st.text())
def test_any_text(coder, reference, text):
    ids = coder.encode(text)
    assert ids == reference.encode_ordinary(text)
    assert coder.decode(ids) == text.encode()


def test_tokens_side_by_side(coder, reference):
    r = random.Random(1)
    tokens = list(coder.tokens.values())
    for _ in range(3000):
        text = b"".join(r.choice(tokens) for _ in range(r.randint(1, 6))).decode("utf-8", "ignore")
        assert coder.encode(text) == reference.encode_ordinary(text)


@pytest.mark.parametrize("text", ["a" * 4000, "ab" * 2000, " " * 3000, "\n " * 900, "!" * 3000])
def test_long_runs(coder, reference, text):
    assert coder.encode(text) == reference.encode_ordinary(text)


@settings(max_examples=300, deadline=None)
@given(text=st.text(st.sampled_from([*"ab.,'é1", *(c for c in map(chr, range(0x3001)) if c.isspace()), " ", " "])))
def test_spaces_of_all_kinds(coder, reference, text):
    assert " ".join(parts(text)) == text
    assert coder.encode(text) == reference.encode_ordinary(text)


@settings(max_examples=300, deadline=None)
@given(text=st.text() | st.text(st.sampled_from("abéµßĀ漢 .,'\nﬁ’")))
def test_store_encodes_as_the_library(text):
    tokenizer = library()
    found = token_store._encoder(queries.TOKENIZER, 4)(text)
    want = tokenizer.encode(text, add_special_tokens=False).ids
    assert np.frombuffer(found, "<u4").tolist() == want


_PIECES = st.sampled_from(
    ["", " ", "a b", "word***", "é###, x", "it's'", "a'll.", "<|endoftext|>", "ab <|endoftext|> cd", "x<|endoftext|>\n", "<|endoftext"]
)


@settings(max_examples=400, deadline=None)
@given(pieces=st.lists(_PIECES | st.text(st.sampled_from("ab.,'*#&é1 \n\t\u2003\x85漢"))))
def test_store_encodes_odd_pieces_and_added_tokens_as_the_library(pieces):
    text = "".join(pieces)
    want = library().encode(text, add_special_tokens=False).ids
    assert np.frombuffer(token_store._encoder(queries.TOKENIZER, 2)(text), "<u2").tolist() == want


def test_added_tokens_are_the_library_s():
    found = token_store._encoder(queries.TOKENIZER, 2)("ab <|endoftext|> cd")
    assert np.frombuffer(found, "<u2").tolist() == [397, 220, 50256, 22927]


def test_encode_and_decode(spark, odd_pairs, reference):
    found = byte_bpe.encode_and_decode(rows_of(spark, odd_pairs), queries.RANKS, queries.PATTERN)
    got = sorted((r.doc_id is None, r.doc_id or 0, r.n_tokens, r.ids, bytes(r.decoded)) for r in found.collect())
    want = []
    for i, t in odd_pairs:
        ids = reference.encode_ordinary(t or "")
        want.append((i is None, i or 0, len(ids), ids, (t or "").encode()))
    assert got == sorted(want)
    assert byte_bpe.encode_and_decode(rows_of(spark, []), queries.RANKS, queries.PATTERN).collect() == []


@pytest.mark.parametrize("id_bytes, shard_bytes", [(2, 1 << 20), (4, 300)])
def test_token_store(spark, odd_pairs, id_bytes, shard_bytes):
    tokenizer = Tokenizer.from_file(queries.TOKENIZER)
    found = token_store.stored(
        rows_of(spark, odd_pairs), queries.TOKENIZER, 2, id_bytes=id_bytes, shard_bytes=shard_bytes
    ).collect()
    order = sorted(odd_pairs, key=lambda p: (p[0] is not None, p[0] or 0, p[1] or ""))
    start, want = 0, []
    for i, t in order:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        crc = zlib.crc32(np.array(ids, "<u4").tobytes())
        want.append((i, start, len(ids), crc, np.array(ids, f"<u{id_bytes}").tobytes()))
        start += len(ids)
    got = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32, bytes(r.ids)) for r in found]
    assert sorted(got, key=lambda r: r[1]) == want


def test_empty_store(spark):
    assert token_store.stored(rows_of(spark, []), queries.TOKENIZER, 2).collect() == []


@given(st.lists(st.integers(0, 100_000), min_size=1, max_size=400))
def test_elias_fano(sizes):
    ends = np.cumsum(sizes)
    code = token_store.EliasFano.of(ends)
    assert [code.select(i) for i in range(code.n)] == ends.tolist()
    bits = 8 * (len(code.low) + len(code.high))
    assert bits <= len(sizes) * (2 + np.log2(max(1, ends[-1] / len(sizes))) + 1) + 24
    with pytest.raises(IndexError):
        code.select(code.n)


def test_pattern_is_the_library_s():
    assert queries.PATTERN == public_tokenizers.PATTERN


#: Words with marks and line feeds, for which no search for matches is needed.
_LINES = "x thon, thon. thon!\nAneses thon;\ninwhé über, hé.\nÜber (x) ed"


def test_words_and_lines_need_no_search_for_matches(reference):
    coder = byte_bpe.BytePairs(queries.RANKS, queries.PATTERN)
    searched, find = [], coder.find
    coder.find = lambda piece: searched.append(piece) or find(piece)
    assert coder.encode(_LINES) == reference.encode_ordinary(_LINES)
    assert searched == ["x", " (x)"]


def test_store_needs_no_search_for_words_and_lines(monkeypatch):
    tokenizer, searched = library(), []
    split = tokenizer.pre_tokenizer.pre_tokenize_str

    def counted(part):
        searched.append(part)
        return split(part)

    proxy = SimpleNamespace(
        pre_tokenizer=SimpleNamespace(pre_tokenize_str=counted),
        model=tokenizer.model,
        get_vocab=tokenizer.get_vocab,
        get_added_tokens_decoder=tokenizer.get_added_tokens_decoder,
    )
    monkeypatch.setattr(tokenizers, "Tokenizer", SimpleNamespace(from_file=lambda file: proxy))
    found = token_store._encoder.__wrapped__(queries.TOKENIZER, 2)(_LINES)
    want = tokenizer.encode(_LINES, add_special_tokens=False).ids
    assert np.frombuffer(found, "<u2").tolist() == want
    assert searched == ["x", " (x)"]


_LINE_PIECES = st.sampled_from(["a", "thon", "é", "漢", "ª", "'s", "'", ",", ".'", "\n", "\n", " ", " ", "\x1c", "\u3000", "1"])


@settings(max_examples=600, deadline=None)
@given(pieces=st.lists(_LINE_PIECES, max_size=14))
def test_lines_with_marks_of_all_kinds(coder, reference, pieces):
    text = "".join(pieces)
    assert coder.encode(text) == reference.encode_ordinary(text)
    want = library().encode(text, add_special_tokens=False).ids
    assert np.frombuffer(token_store._encoder(queries.TOKENIZER, 2)(text), "<u2").tolist() == want


@given(rows=st.lists(st.lists(st.integers(0, 40_000), max_size=5), max_size=6))
def test_bytes_of_many_rows_of_ids(coder, rows):
    ends = np.cumsum([0, *map(len, rows)]).astype(np.int32)
    flat = np.array([i for row in rows for i in row], np.int32)
    assert coder.decode_all(flat, ends).to_pylist() == [coder.decode(row) for row in rows]
