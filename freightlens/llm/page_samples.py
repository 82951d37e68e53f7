"""Pages with known main text, to learn from: texts of given pages laid out anew.

A table of pages says nowhere what its main texts are. So the texts of sampled pages
are put into layouts drawn at random, whose main text is known: other names
for the same parts, or none, parts in other places, tags left open, wrappers,
tables. The given page itself is kept as one more sample where it names its article.
"""

from __future__ import annotations

import random
from html import escape

from freightlens.llm.dom import TEXT, TRUTH, Page, parse

# How sites name the parts of a page.
MAIN_NAMES = (
    "article content main post entry story body text article-body post-content entry-content "
    "main-content page-content article__text blog-post story-body post-body richtext prose"
).split()
HEADING_NAMES = "title headline post-title entry-title article-title page-title".split()
WRAPPER_NAMES = "wrapper container page site layout row inner grid outer wrap column columns".split()
PART_NAMES = {
    "menu": "nav menu navbar navigation topnav main-menu breadcrumb breadcrumbs pagination site-nav toc links",
    "header": "header masthead topbar site-header branding logo banner page-header tagline top",
    "footer": "footer site-footer bottom copyright colophon legal page-footer imprint foot",
    "sidebar": "sidebar aside widget rail related recommended trending popular also-read teaser side tags author-box",
    "notice": "cookie cookies consent gdpr notice alert popup modal overlay subscribe newsletter paywall banner message",
    "advert": "ad ads advert advertisement sponsor sponsored promo ad-slot adsbox banner-ad dfp promotion",
    "form": "search login signup contact-form search-form register form newsletter-form",
    "comments": "comments comment comment-list replies reply discussion respond responses comments-area feedback",
    "share": "share social sharing share-buttons follow social-links tools meta",
}
PART_NAMES = {part: names.split() for part, names in PART_NAMES.items()}
PART_TAGS = {
    "menu": "nav nav div ul", "header": "header header div", "footer": "footer footer div",
    "sidebar": "aside aside div section", "notice": "div section aside dialog",
    "advert": "div div aside section", "form": "form", "comments": "section div section ol",
    "share": "div ul aside",
}
PART_TAGS = {part: tags.split() for part, tags in PART_TAGS.items()}
NEUTRAL = "box block col c1 x item panel el section-2 unit area cell".split()


class Composer:
    def __init__(self, page: Page, seed: int) -> None:
        self.r = random.Random(seed)
        texts = [t for t in page.text if t] or ["text"]
        long = [t for t in texts if len(t) > 60] or texts
        self.sentences = [s.strip() for t in long for s in t.split(". ") if s.strip()] or texts
        self.words = [w for t in texts for w in t.split()][:4000]

    def words_of(self, low: int, high: int) -> str:
        return escape(" ".join(self.r.choice(self.words) for _ in range(self.r.randint(low, high))))

    def sentence(self) -> str:
        return escape(self.r.choice(self.sentences).rstrip(".") + ".")

    def prose(self, low: int, high: int) -> str:
        return " ".join(self.sentence() for _ in range(self.r.randint(low, high)))

    def names(self, names: list[str], certain: float = 0.75) -> str:
        """Attributes with one of these names, a neutral one, or none."""
        kind = self.r.random()
        if kind < certain:
            name = self.r.choice(names)
            if self.r.random() < 0.2:
                name = f"{self.r.choice(NEUTRAL)} {name}"
            return f' {self.r.choice(("class", "class", "id", "role"))}="{name}"'
        return f' class="{self.r.choice(NEUTRAL)}"' if kind < certain + 0.12 else ""

    def link(self, low: int = 1, high: int = 4) -> str:
        return f'<a href="/{self.r.randint(1, 999)}">{self.words_of(low, high)}</a>'

    def links(self, low: int, high: int) -> str:
        found = [self.link() for _ in range(self.r.randint(low, high))]
        if self.r.random() < 0.7:
            return "<ul>" + "".join(f"<li>{x}</li>" for x in found) + "</ul>"
        return self.r.choice((" | ", " ", "<br>")).join(found)

    def part(self, part: str) -> str:
        r = self.r
        if part in ("menu", "share"):
            body = self.links(2, 12) if r.random() < 0.85 else self.words_of(3, 12)
        elif part == "header":
            body = r.choice((f"<h1>{self.words_of(1, 3)}</h1>", f"<p>{self.words_of(2, 6)}</p>", self.words_of(1, 4), self.link()))
            body += self.links(2, 6) if r.random() < 0.3 else ""
        elif part == "footer":
            body = r.choice((f"&copy; {self.words_of(1, 3)} &middot; {self.sentence()}", f"<p>&copy; {self.prose(1, 2)}</p>", self.links(2, 8), f"<p>{self.prose(1, 2)}</p>"))
        elif part == "sidebar":
            body = f"<h3>{self.words_of(1, 4)}</h3>" if r.random() < 0.7 else ""
            body += r.choice((self.links(2, 8), f"<p>{self.prose(1, 2)}</p>{self.link()}", "".join(f"<p>{self.link(3, 8)}</p>" for _ in range(r.randint(1, 5))), f"<p>{self.prose(1, 3)}</p>"))
        elif part == "notice":
            hidden = r.choice(("", "", " <button>ok</button>", f" {self.link()}"))
            body = f"{self.sentence()}{hidden}" if r.random() < 0.5 else f"<p>{self.prose(1, 2)}{hidden}</p>"
        elif part == "advert":
            body = r.choice((self.sentence(), self.sentence(), f"<p>{self.prose(1, 2)}</p>", self.link(3, 9), f"<p>{self.link(2, 6)} {self.sentence()}</p>"))
        elif part == "form":
            body = "".join(f"<label>{self.words_of(1, 3)} <input></label> " for _ in range(r.randint(1, 4)))
            body += r.choice(("<button>go</button>", f"<p>{self.sentence()}</p>", ""))
        else:
            tag = "li" if r.random() < 0.3 else "div"
            body = f"<h3>{self.words_of(1, 3)}</h3>" if r.random() < 0.6 else ""
            for _ in range(r.randint(1, 6)):
                who = f"<{r.choice(('p', 'div', 'span'))}>{self.words_of(1, 3)}" if r.random() < 0.6 else ""
                body += f"<{tag}{self.names(PART_NAMES['comments'], 0.5)}>{who}<p>{self.prose(1, 4)}</p></{tag}>"
        tag = r.choice(PART_TAGS[part])
        named = self.names(PART_NAMES[part])
        hidden = ' style="display:none"' if part == "notice" and r.random() < 0.2 else ""
        return f"<{tag}{named}{hidden}>{body}</{tag}>"

    def main_blocks(self) -> str:
        """The blocks of the main text, with what often stands between them."""
        r = self.r
        found = []
        if r.random() < 0.8:
            heading = f"<h1{self.names(HEADING_NAMES, 0.4)} {TRUTH}>{self.words_of(1, 10)}</h1>"
            found.append(f"<header {TRUTH}>{heading}</header>" if r.random() < 0.15 else heading)
        open_p, plain = r.random() < 0.3, r.random() < 0.1
        for _ in range(r.choice((1, 2, 3, 4, 6, 9, 15))):
            text, kind = self.prose(1, r.choice((1, 3, 8))), r.random()
            if plain:
                found.append(f"<div {TRUTH}>{text}</div>")
            elif kind < 0.72:
                start = r.choice(("", "", "", "<b>", "<em>"))
                found.append(f"<p {TRUTH}>{start}{text}" + ("<br>" if start and open_p else "" if open_p else "</p>"))
            elif kind < 0.8:
                found.append(f"<h{r.choice('234')} {TRUTH}>{self.words_of(1, 8)}</h{r.choice('2')}>")
            elif kind < 0.88:
                items = "".join(f"<li {TRUTH}>{r.choice((self.sentence(), self.words_of(2, 9)))}</li>" for _ in range(r.randint(2, 6)))
                found.append(f"<ul {TRUTH}>{items}</ul>")
            elif kind < 0.92:
                found.append(f"<{r.choice(('blockquote', 'pre'))} {TRUTH}>{text}</{r.choice(('blockquote', 'pre'))}>")
            elif kind < 0.95:
                cells = "".join(f"<tr><td>{self.words_of(1, 3)}<td>{self.words_of(1, 9)}" for _ in range(r.randint(1, 4)))
                found.append(f"<table {TRUTH}>{cells}</table>")
            else:
                found.append(f"<p {TRUTH}>{text} {self.link()} {self.sentence()}</p>")
        for part, share in (("advert", 0.25), ("share", 0.25), ("sidebar", 0.15), ("notice", 0.1)):
            if r.random() < share:
                found.insert(r.randint(min(1, len(found)), len(found)), self.part(part))
        return "".join(found)

    def page(self) -> str:
        r = self.r
        tag = r.choice(("article", "article", "main", "div", "div", "div", "section"))
        core = f"<{tag}{self.names(MAIN_NAMES, 0.7)}>{self.main_blocks()}"
        comments = self.part("comments") if r.random() < 0.35 else ""
        core = f"{core}{comments}</{tag}>" if r.random() < 0.3 else f"{core}</{tag}>{comments}"
        if r.random() < 0.12:
            core = r.choice((self.main_blocks(), f"<div {TRUTH}>{self.prose(1, 9)}</div>"))
            if r.random() < 0.4:
                return core
        shares = (("menu", 0.8), ("header", 0.6), ("notice", 0.4), ("advert", 0.5), ("form", 0.3))
        before = [self.part(p) for p, share in shares if r.random() < share]
        shares = (("sidebar", 0.5), ("advert", 0.3), ("form", 0.2), ("notice", 0.2), ("share", 0.2), ("footer", 0.8))
        after = [self.part(p) for p, share in shares if r.random() < share]
        if r.random() < 0.2:
            before.append(self.part("sidebar"))
        if r.random() < 0.1:
            cells = "".join(f"<td>{x}</td>" for x in ("".join(before[:1]), core))
            body = f"<table><tr>{cells}</tr></table>" + "".join(before[1:] + after)
        else:
            for _ in range(r.choice((0, 0, 1, 1, 2, 3))):
                core = f"<div{self.names(WRAPPER_NAMES, 0.6)}>{core}</div>"
                if before and r.random() < 0.2:
                    core = before.pop() + core
            body = "".join(before) + core + "".join(after)
        if r.random() < 0.3:
            tag = "form" if r.random() < 0.2 else "div"
            body = f"<{tag}{self.names(WRAPPER_NAMES, 0.6)}>{body}</{tag}>"
        return f"<html><head><style>p{{}}</style></head><body>{body}</body></html>"


#: Elements that say what they are, for the given pages themselves.
_ARTICLE = {"article", "main"}
_OTHER = {"nav", "aside", "footer", "form"}


def told_by_names(page: Page) -> Page | None:
    """The page with its main text marked, if it has an element for it."""
    if not _ARTICLE.intersection(page.tag):
        return None
    other = {t for part in ("advert", "comments", "notice", "share", "sidebar") for t in PART_NAMES[part]}
    for i in range(1, len(page.tag)):
        up = page.parent[i]
        inside = page.main[up] or page.tag[i] in _ARTICLE
        page.main[i] = inside and page.tag[i] not in _OTHER and not other.intersection(page.tokens[i])
    return page


def samples(html: str, seed: int, layouts: int) -> list[Page]:
    """The given page, if it names its article, and some layouts of its texts."""
    given = parse(html)
    composer = Composer(given, seed)
    told = told_by_names(given)
    found = [told] if told else []
    return found + [parse(composer.page()) for _ in range(layouts)]


def truth(page: Page) -> list[bool]:
    """For each node, whether there is main text in it."""
    found = [m and t == TEXT for m, t in zip(page.main, page.tag)]
    for i in range(len(found) - 1, 0, -1):
        if found[i]:
            found[page.parent[i]] = True
    return found
