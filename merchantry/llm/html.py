"""Main text of web pages, by a linear-chain conditional random field over the blocks of the document tree.

A page is parsed into leaf blocks: runs of text between the edges of block elements, in page order, with the tags and class words of all their ancestors. Each block is main text or not; the field scores
features of a block (ancestors, own tag, link density, length, punctuation, signs such as the copyright sign) and of neighbouring labels, is trained by maximum likelihood on labelled pages and
decoded by Viterbi. White space inside a block becomes one space, blocks are joined by one space.

Training pages are written by :func:`labelled_pages`: layouts that sites use (semantic elements, plain divisions with telling class names, tables for layout), with menus, banners, notices, adverts, forms, sidebars,
comments and footers around and inside the article. Their number is the bound of the training. Own labelled pages can be given instead.

What a browser doesn't show (scripts, styles, templates, comments in the source, the head) is no block. An open head ends where the body starts: at its tag, at any other that can't stand in a head,
or at text; drawings and formulas may end at the slash of their tag. Character references are decoded, also broken ones, as browsers do.

Defined cases: null, empty and text-free pages have the empty text; a page cut off in the middle gives what is there; text without any element is a block like others; repeated rows are handled each; an empty table gives an
empty result; other columns pass through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("head script style template noscript iframe object svg math canvas".split())
#: Start tags that leave an open head open.
IN_HEAD = frozenset("base basefont bgsound head html link meta noframes noscript script style template title".split())
FOREIGN = frozenset(("svg", "math"))
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()
)
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "option": ({"option"}, {"select"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"table", "tr"}), "th": ({"td", "th"}, {"table", "tr"}),
}
SPACE = re.compile(r"\s+")
PARTS = re.compile(r"[a-z]+")


@dataclass
class Block:
    text: str
    tags: tuple[str, ...]
    names: frozenset[str]
    linked: int
    hidden: bool = False


@dataclass
class _Open:
    tag: str
    names: frozenset[str] = field(default_factory=frozenset)
    hidden: bool = False


class Leaves(HTMLParser):
    """Collects leaf blocks."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.open: list[_Open] = []
        self.blocks: list[Block] = []
        self.pieces: list[str] = []
        self.linked = 0

    def flush(self) -> None:
        if self.pieces:
            text = SPACE.sub(" ", "".join(self.pieces)).strip()
            if text:
                outer = [x for x in self.open if x.tag not in INLINE]
                names = frozenset().union(*(x.names for x in outer)) if outer else frozenset()
                self.blocks.append(Block(text, tuple(x.tag for x in outer), names, self.linked))
        self.pieces, self.linked = [], 0

    def _drop_to(self, i: int) -> None:
        if any(x.tag not in INLINE for x in self.open[i:]):
            self.flush()
        del self.open[i:]

    def _end_head(self) -> None:
        for i, x in enumerate(self.open):
            if x.tag == "head":
                self._drop_to(i)
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "body" and not any(x.tag == "template" for x in self.open):
            self._end_head()
        elif self.open and self.open[-1].tag == "head" and tag not in IN_HEAD:
            self._end_head()
        if tag in CLOSES_P:
            for i in range(len(self.open) - 1, -1, -1):
                if self.open[i].tag == "p":
                    self._drop_to(i)
                    break
                if self.open[i].tag in ("table", "td", "th", "button", "object"):
                    break
        if tag in CLOSES:
            same, fence = CLOSES[tag]
            for i in range(len(self.open) - 1, -1, -1):
                if self.open[i].tag in same:
                    self._drop_to(i)
                    break
                if self.open[i].tag in fence:
                    break
        if tag not in INLINE:
            self.flush() if tag != "br" else self.pieces.append(" ")
        if tag in VOID:
            return
        words: set[str] = set()
        hidden = tag in HIDDEN
        for k, v in attrs:
            if k in ("class", "id", "role", "itemprop", "aria-label") and v:
                words.update(w[:-1] if len(w) > 3 and w.endswith("s") else w for w in PARTS.findall(v.lower()))
            elif k == "hidden" or (k == "style" and v and re.search(r"display\s*:\s*none", v)):
                hidden = True
        self.open.append(_Open(tag, frozenset(words), hidden or bool(self.open and self.open[-1].hidden)))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        # Browsers ignore the slash, except on drawings and formulas and inside them.
        if tag not in VOID and any(x.tag in FOREIGN for x in self.open):
            self._drop_to(len(self.open) - 1)

    def handle_endtag(self, tag: str) -> None:
        if tag == "br":
            self.pieces.append(" ")
        for i in range(len(self.open) - 1, -1, -1):
            if self.open[i].tag == tag:
                if tag not in INLINE:
                    self._drop_to(i)
                elif all(x.tag in INLINE for x in self.open[i:]):
                    del self.open[i]
                return
            if tag in INLINE and self.open[i].tag not in INLINE:
                return

    def handle_data(self, data: str) -> None:
        if self.open and self.open[-1].tag == "head" and data.strip():
            self._end_head()
        if self.open and self.open[-1].hidden:
            return
        self.pieces.append(data)
        if any(x.tag == "a" for x in self.open):
            self.linked += len(data.strip())


def blocks(page: str | None) -> list[Block]:
    if not page:
        return []
    parser = Leaves()
    parser.feed(page)
    parser.close()
    parser.flush()
    return parser.blocks


def features(page: list[Block]) -> list[list[str]]:
    """The features of each block, as strings."""
    out = []
    counts = {"h1": False}
    for i, b in enumerate(page):
        tags, n = b.tags, len(b.text)
        own = tags[-1] if tags else "none"
        words = b.text.count(" ") + 1
        share = b.linked / n
        length = "1" if words == 1 else "4" if words <= 4 else "10" if words <= 10 else "25" if words <= 25 else "60" if words <= 60 else "more"
        links = "all" if share > 0.8 else "many" if share > 0.35 else "some" if share > 0 else "none"
        end = "stop" if b.text[-1] in ".!?…\"”»。" else "colon" if b.text[-1] == ":" else "open"
        f = [f"own={own}", f"len={length}", f"link={links}", f"end={end}", f"own,len={own},{length}", f"link,len={links},{length}", f"end,len={end},{length}"]
        f += [f"in={t}" for t in set(tags)]
        f.append(f"own={own},{'article' if 'article' in tags else 'main' if 'main' in tags else 'elsewhere'}")
        f += [f"name={w}" for w in b.names]
        if counts["h1"]:
            f.append("after h1")
        counts["h1"] = counts["h1"] or own == "h1"
        if "©" in b.text or "(c)" in b.text.lower():
            f.append("copyright")
        if b.text[0] in "·|>»•":
            f.append("starts with mark")
        if i == 0:
            f.append("first")
        if i == len(page) - 1:
            f.append("last")
        f.append("same path" if i and page[i - 1].tags == tags and page[i - 1].names == b.names else "other path")
        out.append(f)
    return out


class Field:
    """A chain over two labels: weights by feature and label, and by pair of labels."""

    def __init__(self, weights: dict[str, tuple[float, float]], moves: np.ndarray) -> None:
        self.weights, self.moves = weights, [[float(x) for x in row] for row in moves]

    def decode(self, rows: list[list[str]]) -> list[int]:
        back: list[tuple[int, int]] = []
        s0 = s1 = 0.0
        (m00, m01), (m10, m11) = self.moves
        get = self.weights.get
        for i, names in enumerate(rows):
            e0 = e1 = 0.0
            for f in names:
                if (w := get(f)) is not None:
                    e0 += w[0]
                    e1 += w[1]
            if i:
                a = (0, s0 + m00) if s0 + m00 >= s1 + m10 else (1, s1 + m10)
                b = (0, s0 + m01) if s0 + m01 > s1 + m11 else (1, s1 + m11)
                back.append((a[0], b[0]))
                s0, s1 = a[1] + e0, b[1] + e1
            else:
                s0, s1 = e0, e1
        if not rows:
            return []
        out = [int(s1 > s0)]
        for a, b in reversed(back):
            out.append(b if out[-1] else a)
        return out[::-1]


def train(pages: list[tuple[list[list[str]], list[int]]], *, rounds: int = 80, decay: float = 1e-3) -> Field:
    """Maximum likelihood by Adam on all pages at once; pages are padded to a grid, so a round is a handful of array operations."""
    pages = [p for p in pages if p[0]]
    index: dict[str, int] = {}
    seen: dict[str, int] = {}
    for rows, _ in pages:
        for r in rows:
            for f in r:
                seen[f] = seen.get(f, 0) + 1
    for f, n in sorted(seen.items()):
        if n >= 3:
            index[f] = len(index)
    longest = max(len(rows) for rows, _ in pages)
    n = len(pages)
    real, gold = np.zeros((n, longest), bool), np.zeros((n, longest), np.int64)
    cell, feat = [], []
    for p, (rows, labels) in enumerate(pages):
        real[p, : len(rows)] = True
        gold[p, : len(rows)] = labels
        for i, r in enumerate(rows):
            for f in r:
                if f in index:
                    cell.append(p * longest + i)
                    feat.append(index[f])
    cell, feat = np.array(cell), np.array(feat)
    w, m = np.zeros((len(index), 2)), np.zeros((2, 2))
    moments = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(m), np.zeros_like(m)]
    rows = np.arange(n)
    both = real[:, 1:] & real[:, :-1]
    for step in range(1, rounds + 1):
        e = np.stack([np.bincount(cell, w[feat, k], n * longest) for k in (0, 1)], axis=1).reshape(n, longest, 2)
        ahead, back = e.copy(), np.zeros_like(e)
        for t in range(1, longest):
            ahead[:, t] = np.where(real[:, t, None], np.logaddexp.reduce(ahead[:, t - 1, :, None] + m, axis=1) + e[:, t], ahead[:, t - 1])
        for t in range(longest - 2, -1, -1):
            back[:, t] = np.where(real[:, t + 1, None], np.logaddexp.reduce(m + (e[:, t + 1] + back[:, t + 1])[:, None], axis=2), 0.0)
        total = np.logaddexp.reduce(ahead[:, -1], axis=1)
        de = np.exp(ahead + back - total[:, None, None])
        de[rows[:, None], np.arange(longest), gold] -= 1
        de *= real[:, :, None]
        pair = np.exp(ahead[:, :-1, :, None] + m + (e + back)[:, 1:, None, :] - total[:, None, None, None]) * both[:, :, None, None]
        dm = pair.sum(axis=(0, 1))
        np.add.at(dm, (gold[:, :-1][both], gold[:, 1:][both]), -1.0)
        flat = de.reshape(-1, 2)
        dw = np.stack([np.bincount(feat, flat[cell, k], len(index)) for k in (0, 1)], axis=1)
        for x, g, a, b in ((w, dw / n + decay * w, 0, 1), (m, dm / n + decay * m, 2, 3)):
            moments[a] = 0.9 * moments[a] + 0.1 * g
            moments[b] = 0.99 * moments[b] + 0.01 * g * g
            x -= 0.1 * (moments[a] / (1 - 0.9**step)) / (np.sqrt(moments[b] / (1 - 0.99**step)) + 1e-8)
    return Field({f: (float(w[i, 0]), float(w[i, 1])) for f, i in index.items()}, m)


# ---------------------------------------------------------------- labelled pages

#: Words that name the parts of a page in class and id attributes.
MAIN_NAMES = "content main main-content article post post-content entry entry-content article-body story story-body text body-text page-content post-body blog-post news-article".split()
ASIDE_NAMES = {
    "menu": "nav menu navbar navigation main-menu top-nav breadcrumb breadcrumbs site-nav pagination pager toc".split(),
    "header": "header site-header masthead banner top-bar branding logo topbar page-header".split(),
    "footer": "footer site-footer page-footer bottom copyright colophon legal footer-links".split(),
    "side": "sidebar side aside widget widgets related related-posts recommended popular trending more-links tags tag-list".split(),
    "notice": "cookie cookie-banner cookie-notice notice alert consent gdpr popup modal overlay message announcement".split(),
    "advert": "ad ads advert advertisement adsense sponsored sponsor promo promotion banner-ad ad-box adslot".split(),
    "form": "form search search-box newsletter subscribe signup login contact-form subscription".split(),
    "comments": "comments comment comment-list comments-area responses discussion disqus reply replies comment-body".split(),
    "share": "share social social-links share-buttons author-bio byline-box follow".split(),
}


def labelled_pages(n: int, seed: int) -> list[tuple[str, list[int]]]:
    """``n`` pages and the label of each of their blocks. Main text is written between marks that a first parse turns into labels."""
    r = np.random.Generator(np.random.PCG64(seed))
    syllables = "the an re ti on er en th in ou le que ção sch und der la es no ar ing ed or wh ha".split()
    on, off = "", ""

    def words(low: int, high: int) -> str:
        return " ".join("".join(r.choice(syllables) for _ in range(r.integers(1, 4))) for _ in range(r.integers(low, high + 1)))

    def sentence(low: int = 4, high: int = 18) -> str:
        s = words(low, high).capitalize()
        s += str(r.choice([".", ".", ".", ".", "!", "?", "", "%%%", "***."]))
        return s if r.random() < 0.9 else s + " " + str(r.integers(1, 2030))

    def prose(low: int = 1, high: int = 6) -> str:
        return " ".join(sentence() for _ in range(r.integers(low, high + 1)))

    def link(t: str) -> str:
        return f'<a href="/{t.split()[0]}">{t}</a>'

    def inline(t: str) -> str:
        if r.random() < 0.25:
            i = t.find(" ")
            tag = str(r.choice(["b", "em", "i", "strong", "span", "code"]))
            return f"<{tag}>{t[:i]}</{tag}>{t[i:]}" if i > 0 else t
        if r.random() < 0.15:
            return f"{t} {link(words(1, 3))} {words(1, 3)}."
        return f"<b>{t}<br>" if r.random() < 0.1 else t

    def named(kind: str, names: list[str], body: str, element: str) -> str:
        style = r.random()
        name = str(r.choice(names))
        if style < 0.35 and element:
            return f"<{element}>{body}</{element}>"
        attr = f'class="{name}"' if r.random() < 0.6 else f'id="{name}"' if r.random() < 0.6 else f'class="{words(1, 1)} {name}"'
        if r.random() < 0.08:
            return f"<table><tr><td {attr}>{body}</td></tr></table>"
        tag = element if element and r.random() < 0.4 else str(r.choice(["div", "div", "div", "section"]))
        return f"<{tag} {attr}>{body}</{tag}>"

    def items(low: int, high: int, make) -> str:
        return "<ul>" + "".join(f"<li>{make()}{'</li>' if r.random() < 0.9 else ''}" for _ in range(r.integers(low, high + 1))) + "</ul>"

    def boiler(kind: str) -> str:
        names = ASIDE_NAMES[kind]
        if kind == "menu":
            body = items(2, 8, lambda: link(words(1, 2))) if r.random() < 0.75 else " | ".join(link(words(1, 2)) for _ in range(4))
            return named(kind, names, body, "nav")
        if kind == "header":
            return named(kind, names, f"<{'h1' if r.random() < 0.4 else 'div'}>{words(1, 4)}</{'div'}><p>{words(2, 8)}</p>" + (items(2, 5, lambda: link(words(1, 2))) if r.random() < 0.4 else ""), "header")
        if kind == "footer":
            mark = str(r.choice(["&copy; ", "© ", "(c) ", ""]))
            body = f"{mark}{words(1, 2)}.example.com &middot; {sentence()}" if r.random() < 0.5 else f"<p>{mark}20{r.integers(10, 26)} {words(1, 4)}</p>" + items(1, 5, lambda: link(words(1, 3)))
            return named(kind, names, body, "footer")
        if kind == "side":
            body = f"<h3>{words(1, 3)}</h3>" + (items(2, 6, lambda: link(words(2, 7))) if r.random() < 0.6 else f"<p>{prose(1, 3)}</p>")
            return named(kind, names, body, "aside")
        if kind == "advert":
            return named(kind, names, str(r.choice([sentence(), f"<p>{prose(1, 2)}</p>", link(sentence())])), "")
        if kind == "notice":
            return named(kind, names, f"<p>{prose(1, 3)}</p><button>{words(1, 2)}</button>" if r.random() < 0.6 else prose(1, 2), "")
        if kind == "form":
            body = f"<form><label>{words(1, 3)}</label><input name=q><select><option>{words(1, 1)}<option>{words(1, 1)}</select><button>{words(1, 2)}</button></form>"
            return named(kind, names, (f"<p>{sentence()}</p>" if r.random() < 0.5 else "") + body, "")
        if kind == "comments":
            name = str(r.choice(names))
            one = lambda: f'<div class="{r.choice(["comment", "comment-body", "reply"])}"><b>{words(1, 2)}</b><p>{prose(1, 4) if r.random() < 0.7 else sentence(1, 3)}</p></div>'
            listed = "".join(one() for _ in range(r.integers(1, 5)))
            if r.random() < 0.3:
                listed = "<ol>" + "".join(f"<li><p>{prose(1, 3)}</p></li>" for _ in range(r.integers(1, 4))) + "</ol>"
            tag = str(r.choice(["div", "section"]))
            return f'<{tag} {r.choice(["id", "class"])}="{name}"><h{r.integers(2, 5)}>{words(1, 3)}</h3>{listed}</{tag}>'
        return named(kind, names, items(2, 4, lambda: link(words(1, 1))) if r.random() < 0.6 else f"<p>{sentence()}</p>", "")

    def main_block() -> str:
        u = r.random()
        t = on + inline(prose(1, 7)) + off
        if u < 0.72:
            return f"<p>{t}{'</p>' if r.random() < 0.9 else ''}"
        if u < 0.8:
            return f"<h{r.integers(2, 5)}>{on}{words(1, 9)}{off}</h2>"
        if u < 0.86:
            return f"<blockquote>{'<p>' if r.random() < 0.5 else ''}{t}</blockquote>"
        if u < 0.92:
            return items(2, 5, lambda: on + sentence(1, 12) + off)
        if u < 0.95:
            return f"<pre>{t}</pre>"
        if u < 0.98:
            return "<table>" + "".join(f"<tr><td>{on}{words(1, 3)}{off}<td>{on}{words(1, 5)}{off}</tr>" for _ in range(r.integers(1, 4))) + "</table>"
        return f"<div>{t}</div>"

    out = []
    kinds = list(ASIDE_NAMES)
    for _ in range(n):
        if r.random() < 0.08:  # little more than a text
            bare = "".join(f"{r.choice(['<p>', '<p>', '<br><br>', '<div>', ''])}{on}{inline(sentence(1, 20))}{off}" for _ in range(r.integers(1, 5)))
            out.append((bare.replace(on, "").replace(off, ""), [1] * len(blocks(bare))))
            continue
        body = [f"<h1>{on}{inline(sentence(1 if r.random() < 0.2 else 3, 12))}{off}</h1>"] if r.random() < 0.8 else []
        for _ in range(r.integers(1, 12)):
            body.append(main_block() if r.random() < 0.93 else f"<p>{on}{inline(sentence(1, 2))}{off}</p>")
            if r.random() < 0.06:
                body.append(boiler(str(r.choice(["advert", "share", "side", "form", "notice"]))))
        if r.random() < 0.15:
            body.append(boiler("comments"))
        inner = "".join(body)
        u = r.random()
        if u < 0.4:
            inner = f"<article>{inner}</article>"
        elif u < 0.5:
            inner = f"<main>{inner}</main>"
        elif u < 0.6:
            inner = f'<main><article class="{r.choice(MAIN_NAMES)}">{inner}</article></main>'
        elif u < 0.64:
            inner = f'<table><tr><td class="{r.choice(MAIN_NAMES)}">{inner}</td></tr></table>'
        elif u < 0.95:
            inner = f'<div {r.choice(["id", "class"])}="{r.choice(MAIN_NAMES)}">{inner}</div>'
        if r.random() < 0.3:
            inner = f'<div class="{r.choice(["wrapper", "container", "page", "row", "layout", words(1, 1)])}">{inner}</div>'
        before = [boiler(k) for k in ("notice", "header", "menu", "advert", "form") if r.random() < 0.45]
        after = [boiler(k) for k in ("share", "comments", "side", "menu", "advert", "form", "footer", "notice") if r.random() < 0.4]
        if r.random() < 0.3:
            r.shuffle(before)
        extra = [boiler(str(r.choice(kinds)))] if r.random() < 0.2 else []
        page = f"<html><head><title>{words(2, 8)}</title><script>var t='</p>';</script></head><body>{''.join(before)}{inner}{''.join(extra + after)}</body></html>"
        labels = [int(on in b.text) for b in blocks(page)]
        out.append((page.replace(on, "").replace(off, ""), labels))
    return out


@lru_cache(maxsize=2)
def default_field(pages: int = 450, seed: int = 5) -> Field:
    made = []
    for page, labels in labelled_pages(pages, seed):
        rows = features(blocks(page))
        if len(rows) == len(labels):
            made.append((rows, labels))
    return train(made)


def main_text(page: str | None, model: Field) -> str:
    found = blocks(page)
    return " ".join(b.text for b, keep in zip(found, model.decode(features(found)), strict=True) if keep)


def extract(spark: SparkSession, page: Column, model: Field | None = None) -> Column:
    """The main text of a page. The model's size is that of its features."""
    shared = spark.sparkContext.broadcast(model or default_field())

    @F.pandas_udf("string")
    def text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        use = shared.value
        for batch in batches:
            yield pd.Series([main_text(p, use) for p in batch], dtype=object)

    return text(page)


def with_main_text(pages: DataFrame, *, html: str = "html", into: str = "text", model: Field | None = None) -> DataFrame:
    """``pages`` with the main text of ``html`` in the column ``into``."""
    return pages.withColumn(into, extract(pages.sparkSession, F.col(html), model))
