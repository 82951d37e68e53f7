from __future__ import annotations

import random

import pytest


@pytest.fixture(scope="session")
def odd_pairs():
    """Nulls, empty and white texts, ties, repeated rows, long texts, other scripts."""
    r = random.Random(4)
    words = ["alpha", "beta", "Gamma", "delta's", "é", "漢字", "x1", "12,5", "end.\nNext", "A\tB"]
    prose = [" ".join(r.choice(words) for _ in range(n)) for n in (3, 8, 40, 90)]
    long = " ".join(r.choice(words) for _ in range(30_000))
    texts = [None, "", " ", "\n\n", "  two  spaces ", "a b c d", "A B C D", *prose, prose[2].upper(), long, long + " x"]
    texts += ["a" * 3000, " " * 500, "no-break space x", "\x00\x01", "<|endoftext|> is text"]
    pairs = list(enumerate(texts))
    return pairs + [(5, "a b c d"), (None, "a b c d"), (None, None), (40, prose[1]), (41, prose[1])]
