"""HTML as a flat tree: block-level elements and the runs of text between their borders."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from functools import lru_cache
from html import unescape

# Element names of HTML by how they take part in the tree.
INLINE = frozenset(
    "a abbr acronym area b base bdi bdo big cite code data del dfn em font i img ins kbd label link map "
    "mark meta nobr output picture q rb rp rt ruby s samp small source span strike strong sub sup time "
    "track tt u var wbr html head col param".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
LEFT_OUT = frozenset(
    "button select svg object canvas audio video noscript template datalist applet math".split()
)
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer "
    "form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre section summary table ul li dd dt".split()
)
#: A start tag closes the first of these that is open, unless one of the others is in between.
CLOSES = {
    "li": ("li", "ul ol menu dir"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"),
    "tr": ("tr", "table"), "td": ("td th", "tr table"), "th": ("td th", "tr table"),
    "thead": ("thead tbody tfoot", "table"), "tbody": ("thead tbody tfoot", "table"),
    "tfoot": ("thead tbody tfoot", "table"), "option": ("option", "select"),
}
CLOSES = {tag: tuple(frozenset(x.split()) for x in both) for tag, both in CLOSES.items()}
TABLE_PARTS = frozenset("table caption colgroup thead tbody tfoot tr td th".split())
CELLS = frozenset("td th caption table".split())
NO_P = frozenset(["p"]), CELLS

_TAG = re.compile(
    r"<(?:!--.*?(?:--!?>|\Z)"
    r"|(/?)([A-Za-z][^\s/>]*+)((?:[^>=]++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|=)*+)>?"
    r"|[!?/][^>]*+>?)",
    re.DOTALL,
)
_NAMED = re.compile(
    r"(?<![\w-])(class|id|role|itemprop|aria-label)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I
)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_HIDDEN = re.compile(r"(?<![\w-])hidden(?![\w-])|display\s*:\s*none|aria-hidden\s*=\s*\"?true", re.I)
_MARKS = re.compile(r"[.,;:!?。、]")
TEXT, ROOT = "#text", "#root"
#: Marks the parts of a page made for training that are main text.
TRUTH = "data-main"


@lru_cache(maxsize=4096)
def attribute_tokens(attributes: str) -> tuple[str, ...]:
    """The words in an element's class, id, role and label, each once."""
    found = [next(filter(None, m.groups()[1:]), "") for m in _NAMED.finditer(attributes)]
    words = [w.lower() for x in found for w in _WORD.findall(x)]
    if _HIDDEN.search(attributes):
        words.append("~hidden")
    return tuple(dict.fromkeys(words))


@dataclass
class Page:
    """The nodes of a page in page order; node 0 is the root. Text nodes have no children."""

    parent: list[int] = field(default_factory=list)
    tag: list[str] = field(default_factory=list)
    tokens: list[tuple[str, ...]] = field(default_factory=list)
    text: list[str] = field(default_factory=list)
    #: Letters of the text within links, its punctuation, tags and fields inside it.
    linked: list[int] = field(default_factory=list)
    marks: list[int] = field(default_factory=list)
    tags: list[int] = field(default_factory=list)
    fields: list[int] = field(default_factory=list)
    main: list[bool] = field(default_factory=list)

    def add(self, parent: int, tag: str, tokens: tuple[str, ...] = (), main: bool = False) -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.tokens.append(tokens)
        self.text.append("")
        for counts in (self.linked, self.marks, self.tags, self.fields):
            counts.append(0)
        self.main.append(main)
        return len(self.parent) - 1


class _Builder:
    def __init__(self) -> None:
        self.page = Page()
        self.open, self.names = [self.page.add(-1, ROOT)], [ROOT]
        self.count: dict[str, int] = {}
        self.pieces: list[str] = []
        self.linked: list[str] = []
        self.inside = self.fields = 0
        #: Number of open elements when the open link began; 0 without one.
        self.link = 0

    def data(self, text: str) -> None:
        if "&" in text:
            text = unescape(text)
        self.pieces.append(text)
        if self.link:
            self.linked.append(text)

    def end_block(self) -> None:
        """What has been read since the last border becomes a text node."""
        if self.pieces:
            text = " ".join("".join(self.pieces).split())
            if text:
                i = self.page.add(self.open[-1], TEXT, (), self.page.main[self.open[-1]])
                self.page.text[i] = text
                self.page.linked[i] = min(len(text), len(" ".join("".join(self.linked).split())))
                self.page.marks[i] = len(_MARKS.findall(text))
                self.page.tags[i], self.page.fields[i] = self.inside, self.fields
                self.inside = self.fields = 0
            self.pieces, self.linked = [], []

    def start(self, tag: str, attributes: str) -> None:
        self.end_block()
        parent = self.open[-1]
        main = self.page.main[parent] or TRUTH in attributes
        i = self.page.add(parent, tag, attribute_tokens(attributes) if attributes else (), main)
        self.page.tags[i] = 1
        self.open.append(i)
        self.names.append(tag)
        self.count[tag] = self.count.get(tag, 0) + 1

    def close(self, wanted: frozenset[str], borders: frozenset[str]) -> None:
        """Close the innermost open element of these names, and all in it, unless a border is met first."""
        if not any(self.count.get(x) for x in wanted):
            return
        for at in range(len(self.names) - 1, 0, -1):
            if self.names[at] in wanted:
                self.end_block()
                for name in self.names[at:]:
                    self.count[name] -= 1
                del self.open[at:], self.names[at:]
                if self.link > at:
                    self.link = 0
                return
            if self.names[at] in borders:
                return


def parse(html: str) -> Page:
    """The tree of a page, as forgiving as browsers are about tags left open or cut off.

    Paragraphs, list items, cells and the like end where the next one begins. Scripts,
    styles, comments, fields and graphics are left out. The white space of a text node is single spaces.
    """
    b, at, end = _Builder(), 0, len(html)
    while at < end:
        m = _TAG.search(html, at)
        if m is None:
            b.data(html[at:])
            break
        if m.start() > at:
            b.data(html[at : m.start()])
        at = m.end()
        closing, tag, attributes = m.group(1, 2, 3)
        if tag is None:
            continue
        tag = tag.lower()
        if closing:
            if tag == "a":
                b.link = 0
            elif tag not in INLINE and tag != "body":
                b.close(frozenset((tag,)), frozenset() if tag in TABLE_PARTS else CELLS)
        elif tag in RAW or tag in LEFT_OUT:
            if tag in ("textarea", "button", "select"):
                b.fields += 1
            found = _end_of(tag).search(html, at)
            if found or tag in RAW:
                at = found.end() if found else end
        elif tag in INLINE:
            b.inside += 1
            if tag == "a":
                b.link = len(b.open)
        elif tag == "br":
            b.data("\n")
        elif tag == "input":
            b.fields += 1
        elif tag == "hr":
            b.close(*NO_P)
            b.end_block()
        elif tag not in VOID:
            if tag in CLOSES_P:
                b.close(*NO_P)
            if tag in CLOSES:
                b.close(*CLOSES[tag])
            b.start(tag, attributes)
    b.end_block()
    return b.page


@lru_cache(maxsize=64)
def _end_of(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*+>?", re.I)
