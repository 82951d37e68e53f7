"""HTML trees, boosted trees, decoding and main texts, against brute force, html.parser and known pages."""

from __future__ import annotations

import itertools
import random
from collections import Counter
from html.parser import HTMLParser

import numpy as np
import pytest

from freightlens.llm import html_main, page_samples, queries
from freightlens.llm.dom import TEXT, parse

PROSE = "Thaninhe thhewh of the andinst. Erinhe by anan stenre it are or. "


def texts(html):
    return [t for t in parse(html).text if t]


def test_borders_of_text():
    assert texts("<p>a <b>b</b>\n c<br>d<p>e&amp;&nbsp;f &lt;g&gt;</div>h") == ["a b c d", "e& f <g>h"]
    assert texts("x<ul><li>a<li>b<ul><li>c</ul>d</ul>y") == ["x", "a", "b", "c", "d", "y"]
    assert texts("<table><tr><td>1<td>2<tr><th>3</table>4") == ["1", "2", "3", "4"]
    assert texts("3 < 4 & 5 > 2<!-- <p>no --> <!doctype x>y") == ["3 < 4 & 5 > 2 y"]
    assert texts("a<script>if (a<b) '</p>'</SCRIPT>b<style>p{}</style><title>t</title>c") == ["abc"]
    assert texts("a<button>no</button><select><option>no</select> b<textarea>no</textarea>") == ["a b"]
    assert texts('<p title="a>b" don\'t>x</p><p class="open>y') == ["x", "y"]
    assert texts("") == texts("<p>") == texts("<!-- open") == texts("<scr") == texts("<script>open") == []
    assert texts("a<scr") == ["a"] and texts("&#x41;&eacute;&amp;amp;") == ["Aé&amp;"]


def test_deep_and_long_pages_take_linear_time():
    deep = "<div>" * 20_000 + "x" + "</div>" * 20_000
    assert len(parse(deep).tag) == 20_002
    assert len(texts("<p>" + "a b " * 500_000 + "</p>" + "<" * 20_000)[0]) > 1_000_000
    assert len(texts("<b>" * 50_000 + "y" + "<p a='" * 50)) == 1


def test_attribute_words():
    page = parse('<div class="postContent article__text" id=main-1 aria-label=\'Cookie Notice\' data-class="no">x')
    assert set(page.tokens[1]) == {"post", "content", "article", "text", "main", "cookie", "notice"}
    assert "~hidden" in parse('<div style="display: none">x').tokens[1]


def test_links_are_counted_up_to_their_end():
    page = parse("<p>ab <a href=x>cd</a> e</p><div><a>unclosed</div><p>fg</p>")
    assert [n for n, t in zip(page.linked, page.tag) if t == TEXT] == [2, 8, 0]


def test_decoding_is_the_best_choice():
    """Against all choices that contain every accepted node's parent."""
    r = random.Random(5)
    for _ in range(40):
        page = parse("x")
        n = r.randint(1, 11)
        page = type(page)()
        for i in range(n):
            page.add(-1 if i == 0 else r.randrange(i), "div" if i else "#root")
        # Children follow their parents in page order.
        odds = np.array([r.gauss(0, 1) for _ in range(n)])
        got = html_main.accepted(html_main.Forest.of([page]), odds)
        assert got[0] and all(got[page.parent[i]] for i in range(1, n) if got[i])
        value = lambda c: sum(odds[i] for i in range(1, n) if c[i])
        closed = (
            (True, *c)
            for c in itertools.product((False, True), repeat=n - 1)
            if all((True, *c)[page.parent[i]] for i in range(1, n) if (True, *c)[i])
        )
        assert value(got) == pytest.approx(max(map(value, closed)))


def test_boosted_trees_learn_what_one_split_cannot():
    r = np.random.default_rng(1)
    x = r.normal(size=(3000, 4)).astype(np.float32)
    y = ((x[:, 0] > 0) ^ (x[:, 2] > 0.5)).astype(float)
    trees = html_main.boosted(x[:2000], y[:2000], n_trees=25, depth=3)
    assert ((trees.log_odds(x[2000:]) > 0) == (y[2000:] > 0)).mean() > 0.92
    constant = html_main.boosted(np.ones((50, 2), np.float32), np.ones(50), n_trees=3)
    assert (constant.log_odds(np.ones((3, 2), np.float32)) > 0).all()
    # The first split is the best one that brute force finds.
    one = html_main.boosted(x[:300], y[:300], n_trees=1, depth=1)
    g, h = y[:300] - y[:300].sum() / 300, 0.25
    share = (y[:300].sum() + 1) / 302
    g, h = y[:300] - share, share * (1 - share)

    def gain(f, limit):
        left = x[:300, f] <= limit
        both = [(g[s].sum() ** 2) / (h * s.sum() + 1) for s in (left, ~left)]
        return sum(both) if min(left.sum(), (~left).sum()) * h >= 5 else 0

    cuts = [(f, q) for f in range(4) for q in np.quantile(x[:300, f], np.linspace(0, 1, 32)[1:-1], method="lower")]
    best = max(cuts, key=lambda c: gain(*c))
    assert gain(one.feature[0][0], one.limit[0][0]) == pytest.approx(gain(*best))


@pytest.fixture(scope="module")
def given(spark, folder):
    return spark.read.parquet(f"{folder}/pages.parquet")


@pytest.fixture(scope="module")
def model(given):
    return html_main.train(given)


class Article(HTMLParser):
    """The blocks within <article>, by another parser."""

    def __init__(self, html):
        super().__init__()
        self.inside, self.blocks = False, [""]
        self.feed(html)
        self.close()

    def handle_starttag(self, tag, attrs):
        self.inside = self.inside or tag == "article"
        if tag in ("p", "h1"):
            self.blocks.append("")
        if tag == "br":
            self.handle_data(" ")

    def handle_endtag(self, tag):
        self.inside = self.inside and tag != "article"
        if tag in ("p", "h1"):
            self.blocks.append("")

    def handle_data(self, data):
        if self.inside:
            self.blocks[-1] += data

    def text(self):
        plain = (" ".join(b.split()) for b in self.blocks)
        return "\n\n".join(b for b in plain if b)


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_the_whole_given_tables(spark, scale):
    df = spark.read.parquet(f"/root/testdata/{scale}/pages.parquet")
    want = {r.page_id: (r.url, Article(r.html).text()) for r in df.collect()}
    got = queries.op12_html_main_text(spark, f"/root/testdata/{scale}").collect()
    assert {r.page_id: (r.url, r.text) for r in got} == want and len(got) == len(want)
    assert all(r.n_chars == len(r.text) for r in got)


def test_held_out_layouts(given, model):
    """Layouts of other pages, a fourth of whose parts have no telling name: letters found and letters right."""
    rows = given.collect()[-60:]
    pages = [p for r in rows for p in page_samples.samples(r.html, 10**6 + r.page_id, 6)[1:]]
    right = found = wanted = 0
    for blocks, page in zip(model.main_blocks(pages), pages):
        got = Counter(blocks)
        want = Counter(t for t, m in zip(page.text, page.main) if t and m)
        right += sum(len(t) * k for t, k in (got & want).items())
        found += sum(len(t) * k for t, k in got.items())
        wanted += sum(len(t) * k for t, k in want.items())
    assert right / found > 0.9 and right / wanted > 0.9


@pytest.mark.parametrize(
    "html",
    [
        f"<header><h1>Site</h1><p>Slogan</p></header><nav><a href=/>home</a> <a href=/b>blog</a></nav><main>"
        f"<h1>KEEP the title</h1><p>KEEP {PROSE * 3}</p><p>KEEP short.</p><ul><li>KEEP one</li><li>KEEP two</li></ul></main>"
        f"<aside><h3>Related</h3><p>{PROSE}</p></aside><section class='comments'><h2>Comments</h2><p>{PROSE * 4}</p></section>"
        "<form><label>Name <input></label><button>Send</button></form><footer>&copy; 2020 rights reserved</footer>",
        f"<div id=cookie-banner>We use cookies. {PROSE}<button>ok</button></div><div id=menu><ul><li><a href=1>a</a>"
        f"<li><a href=2>b</a></ul></div><div class='post-content'><h2>KEEP the head</h2><p>KEEP {PROSE * 5}<p>KEEP {PROSE}"
        f"<div class='ad-slot'>Buy now! {PROSE}</div><p>KEEP {PROSE * 2}</div><div class=sidebar><p>{PROSE}</p></div>"
        f"<div id=comments><div class=comment><p>{PROSE * 3}</p></div></div><div id=footer>{PROSE}</div>",
        f"<body><nav><ul><li><a href='/x'>x</a></li></ul></nav><div class='ad'>{PROSE}</div><article><h1>KEEP Th.</h1>"
        f"<p>KEEP Th.</p></article><footer>&copy; a.example.com &middot; {PROSE}</footer></body>",
        "<nav><a href=1>a</a></nav><footer>&copy;</footer>",
    ],
)
def test_pages_of_other_sites(model, html):
    assert model.main_blocks([parse(html)]) == [[t for t in texts(html) if t.startswith("KEEP")]]


def test_odd_rows(spark, model):
    """Null, empty, blank, broken and very long pages, repeated and null ids, clashing names."""
    long = "<nav><a href=x>menu</a></nav><article><h1>Head of it</h1>" + f"<p>{PROSE * 30}</p>" * 1500 + "</article>"
    htmls = [None, "", "  \n", "<!-- ", "<p", long, long, "\x00<article><p>a\x00b", "no tags at all", "<div>" * 3000 + "x"]
    rows = [(None if i == 3 else i % 7, f"u{i}", h, None, None, None, None) for i, h in enumerate(htmls)]
    extra = "id string, c0 long, text int, n_blocks string"
    df = spark.createDataFrame(rows, f"page_id long, url string, html string, {extra}")
    got = {r.url: r for r in html_main.extract(df, model).collect()}
    assert len(got) == len(rows) and got["u3"].page_id is None
    assert [got[f"u{i}"].text for i in range(5)] == [""] * 5
    want = "\n\n".join(["Head of it", *[" ".join((PROSE * 30).split())] * 1500])
    assert got["u5"].text == got["u6"].text == want and got["u5"].n_chars == len(want)
    assert html_main.extract(df.limit(0), model).isEmpty()
    # Learning from such rows, and from none.
    assert html_main.extract(df, html_main.train(df, layouts=1)).count() == len(rows)
    none = html_main.extract(df, html_main.train(df.limit(0)))
    assert {r.text for r in none.collect()} == {""}


def test_the_sample_is_bounded_and_the_same_each_time(spark, given):
    row = given.first()
    many = spark.range(300).selectExpr("1L AS page_id").join(given.filter(f"page_id = {row.page_id}").select("html"))
    assert html_main.train(many, most_pages=5, layouts=1).weights
    assert html_main.train(given, most_pages=20).to_json() == html_main.train(given, most_pages=20).to_json()
