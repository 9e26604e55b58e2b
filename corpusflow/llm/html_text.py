"""HTML extraction: flat text blocks classified by a decision tree.

A page is cut into flat blocks of text. Each block has its word count, link density, the
same of its neighbours, and what it stands in (an article; a container that is named or
classed as a menu, notice, advert and so on). A name doesn't set apart what holds the page's
article or most of its long text, and a compound with a word of another kind (social-history)
is only a hint. A small decision tree, grown here from a
labelled table of such blocks, says which are main text: of every page with a container that
says what it is, that decides, as one-word paragraphs and long adverts can't be told apart otherwise. Where a page has no article element, or
a name only hints, length, links and neighbours decide: long prose stays, and a short line
stays beside prose but not among menus and other short lines.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from dataclasses import dataclass
from functools import cache, lru_cache
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Element names by role.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("script style noscript template svg math iframe object canvas audio video select textarea button title".split())
#: Of these, the ones whose content is no markup, and the ones that can't hold one of their own.
RAW = frozenset("script style title textarea".split())
FLAT = frozenset("button select noscript iframe".split())
APART = frozenset("nav header footer aside form menu dialog".split())
MAIN = frozenset("article main".split())
#: Elements that hold the article only if they hold all there is of article elements, or if nothing closes them.
NARROW = frozenset("nav header footer menu dialog".split())
#: Names in a class, id or role that mark what isn't main text; a name counts as a whole word of the attribute.
APART_NAMES = frozenset(
    "ad ads advert advertisement adverts advertising alert banner breadcrumb breadcrumbs comment comments commentlist commenter complementary consent contentinfo cookie cookies copyright dialog disclaimer disqus footer form gdpr header legal login masthead menu modal nav navbar navigation newsletter notice notification overlay pagination pager paywall popup promo promoted promotion recommended related reply replies respond rss share sharing sidebar signup social sponsor sponsored subscribe subscription toolbar topbar widget".split()
)
#: Words beside a name that leave it what it is: comment-list, page-header, sidebar-left.
PLAIN_NAMES = frozenset(
    "area bar block body bottom box button buttons container content entry field first group head icon icons inner item items last left link links list main message page panel post posts primary right row secondary section site slot small text title top unit wrap wrapper".split()
)
#: What follows them in a name isn't there, or stands beside: has-comments, with-sidebar, no-sidebar.
BESIDE = frozenset("has no with without".split())
#: A block of so many words and at most this link density is long text.
LONG_WORDS, LONG_LINKED = 15, 0.3
_WORDS = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")

FEATURES = ("words", "link_density", "words_before", "link_before", "words_after", "link_after", "place", "apart")


@dataclass
class Block:
    text: str
    words: int
    linked: int
    in_article: bool
    #: 1 set apart, 2 only a hint in a name, else 0.
    apart: int = 0


@dataclass
class _Mark:
    """An element that a tag, a name or a hint marks, with the blocks and the article and main elements it holds (as ranges)."""

    kind: str
    blocks: int
    mains: int
    #: Whether it is one that may stand around a whole page, as a form does.
    wide: bool = False
    blocks_end: int = -1
    mains_end: int = -1


def _matched(ends: list[bool], flat: bool) -> list[bool]:
    """Of starts and ends (true) in order, which starts are closed: by an end before the next start, or by count."""
    out, open_ = [False] * len(ends), []
    for k, end in enumerate(ends):
        if not end:
            if flat:
                open_.clear()
            open_.append(k)
        elif open_:
            out[open_.pop()] = True
    return out


class _Blocks(HTMLParser):
    """One pass over a page. Containers are tracked leniently: an end tag closes the nearest open one of its name."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        self.open: list[tuple[str, _Mark | None, bool]] = []  # name, mark, main
        #: Places in ``open`` of the elements of each name, and of those with a mark or main.
        self.places: dict[str, list[int]] = {}
        self.holders: list[int] = []
        self.marks: list[_Mark] = []
        self.main = self.mains = self.skipped = 0
        self.links = 0
        self.parts: list[str] = []
        self.link_parts: list[str] = []
        self.skip_name = ""
        #: Where elements of a name that is left out start and end in the page, and which starts are closed, found when first met.
        self.page = ""
        self.edges: dict[str, tuple[list[int], list[bool]]] = {}
        self.lines: list[int] = []

    def _closed(self, tag: str) -> bool:
        """Whether the element that starts here has an end tag: one that comes before the next start, or closes it by count."""
        if tag not in self.edges:
            found = [(m.start(), m.group(1) == "/") for m in re.finditer(rf"<(/?){tag}(?=[\s/>])", self.page, re.I)]
            self.edges[tag] = [k for k, _ in found], _matched([end for _, end in found], tag in FLAT)
            self.lines = self.lines or [0, *(m.end() for m in re.finditer("\n", self.page))]
        at, closed = self.edges[tag]
        line, offset = self.getpos()
        k = bisect_left(at, self.lines[line - 1] + offset)
        return k < len(closed) and closed[k]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if self.skip_name:
            self.skipped += tag == self.skip_name and tag not in VOID
            return
        if tag in SKIPPED:
            if tag not in ("button",):
                self.flush()
            # an element that nothing closes doesn't swallow the page behind it
            if tag in RAW or self._closed(tag):
                self.skip_name, self.skipped = tag, 1
            return
        if tag == "a":
            self.links = 1
            return
        if tag in INLINE:
            if tag in ("br", "wbr"):
                self.parts.append(" " if tag == "br" else "")
            named = _named(attrs, self.main > 0)
            if named and tag not in VOID:
                self.flush()
                self._push(tag, named, False)
            return
        self.flush()
        self.links = 0
        if tag not in VOID:
            main = tag in MAIN
            kind = "tag" if tag in APART and not (tag == "header" and self.main) else _named(attrs, self.main > 0)
            self._push(tag, "" if tag in ("html", "body") else kind, main)

    def _push(self, tag: str, kind: str, main: bool) -> None:
        # an article that is hidden itself stays hidden
        mark = _Mark(kind, len(self.blocks), self.mains + (main and kind == "tag"), tag not in NARROW) if kind else None
        if mark:
            self.marks.append(mark)
        self.places.setdefault(tag, []).append(len(self.open))
        if mark or main:
            self.holders.append(len(self.open))
        self.open.append((tag, mark, main))
        self.main += main
        self.mains += main

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if self.skip_name:
            if tag == self.skip_name:
                self.skipped -= 1
                if not self.skipped:
                    self.skip_name = ""
            return
        if tag == "a":
            self.links = 0
            return
        places = self.places.get(tag)
        if tag in VOID or (tag in INLINE and not places):
            return
        self.flush()
        self.links = 0
        if not places or (tag in ("p", "li", "td", "th", "tr", "dd", "dt") and self.holders and self.holders[-1] > places[-1]):
            return  # a stray end tag doesn't close the container around it
        for _ in range(len(self.open) - places[-1]):
            name, mark, main = self.open.pop()
            self.places[name].pop()
            if mark or main:
                self.holders.pop()
            if mark:
                mark.blocks_end, mark.mains_end = len(self.blocks), self.mains
            self.main -= main

    def handle_data(self, data: str) -> None:
        if not self.skip_name:
            self.parts.append(data)
            if self.links:
                self.link_parts.append(data)

    def flush(self) -> None:
        if not self.parts:
            return
        words = "".join(self.parts).split()
        linked = len(" ".join(self.link_parts).split()) if self.link_parts else 0
        self.parts, self.link_parts = [], []
        if words:
            self.blocks.append(Block(" ".join(words), len(words), min(linked, len(words)), self.main > 0))

    def set_apart(self) -> None:
        """Mark the blocks at the end of the page, when it is known what each marked element holds."""
        for m in self.marks:
            if m.blocks_end < 0:
                m.blocks_end, m.mains_end, m.wide = len(self.blocks), self.mains, True
        n = len(self.blocks)
        long = np.array([b.words if b.words >= LONG_WORDS and b.linked <= LONG_LINKED * b.words else 0 for b in self.blocks], int)
        every = np.concatenate([[0], np.cumsum(long)])

        def around(m: _Mark) -> bool:
            """Whether an element that a tag marks stands around the article, and so sets nothing apart."""
            if self.mains:
                return m.mains == 0 and m.mains_end == self.mains
            return m.wide and 5 * (every[m.blocks_end] - every[m.blocks]) > 4 * every[-1]

        self.marks = [m for m in self.marks if m.kind != "tag" or not around(m)]
        long = long * ~_covered(n, [m for m in self.marks if m.kind == "tag"])
        upto = np.concatenate([[0], np.cumsum(long)])
        upto_main = np.concatenate([[0], np.cumsum(long * np.array([b.in_article for b in self.blocks], bool))])

        def holds_text(m: _Mark) -> bool:
            own, whole = upto[m.blocks_end] - upto[m.blocks], upto[-1]
            all_mains = self.mains > 0 and m.mains == 0 and m.mains_end == self.mains
            if m.kind == "hint":
                return all_mains or 2 * own > whole
            if all_mains and (2 * own > whole or not whole):
                return True
            return 5 * own > 4 * whole and upto_main[m.blocks_end] - upto_main[m.blocks] == upto_main[-1]

        kept = [m for m in self.marks if m.kind == "tag" or not holds_text(m)]
        strong, hint = _covered(n, [m for m in kept if m.kind != "hint"]), _covered(n, [m for m in kept if m.kind == "hint"])
        for b, x, y in zip(self.blocks, strong, hint, strict=True):
            b.apart = 1 if x else 2 if y else 0


def _covered(n: int, marks: list[_Mark]) -> np.ndarray:
    """Which of ``n`` blocks lie in one of the marked elements."""
    step = np.zeros(n + 1, int)
    for m in marks:
        step[m.blocks] += 1
        step[m.blocks_end] -= 1
    return np.cumsum(step)[:n] > 0


@lru_cache(4096)
def _apart_words(value: str) -> tuple[frozenset[str], frozenset[str]]:
    """The names that set apart in a class, id or role: in words of their own or plain compounds, and as hints in other compounds."""
    names, hints = set(), set()
    for token in value.split():
        words = _WORDS.findall(_CAMEL.sub(" ", token).lower())
        words = words[: next((k for k, w in enumerate(words) if w in BESIDE), len(words))]
        (names if APART_NAMES.union(PLAIN_NAMES).issuperset(words) else hints).update(APART_NAMES.intersection(words))
    return frozenset(names), frozenset(hints)


def _named(attrs: list[tuple[str, str | None]], main: bool) -> str:
    """How an element is marked: ``tag`` if it is hidden, ``name`` or ``hint`` by its class, id or role, else empty.

    A header inside of the main element is its heading.
    """
    kind, heading = "", {"header"} if main else set()
    for k, v in attrs:
        if k == "hidden" or (k == "aria-hidden" and v == "true"):
            return "tag"
        if k in ("class", "id", "role") and v:
            names, hints = _apart_words(v)
            if names - heading:
                kind = "name"
            elif hints - heading:
                kind = kind or "hint"
    return kind


def blocks_of(page: str | None) -> list[Block]:
    """The flat blocks of a page; null gives none. A page that ends inside a tag keeps its text before."""
    parser = _Blocks()
    parser.page = page or ""
    parser.feed(page or "")
    parser.close()
    parser.flush()
    parser.set_apart()
    return parser.blocks


def features_of(blocks: list[Block]) -> np.ndarray:
    """A row of ``FEATURES`` for each block; a neighbour that isn't there has no words.

    ``place`` is 0 beside the page's article, 1 where the page has none, 2 in it.
    """
    n = len(blocks)
    words = np.array([b.words for b in blocks], float)
    density = np.array([b.linked / b.words for b in blocks])
    out = np.zeros((n, len(FEATURES)))
    out[:, 0], out[:, 1] = words, density
    out[1:, 2], out[1:, 3] = words[:-1], density[:-1]
    out[:-1, 4], out[:-1, 5] = words[1:], density[1:]
    inside = np.array([b.in_article for b in blocks], bool)
    out[:, 6] = np.where(inside, 2, 0 if inside.any() else 1)
    out[:, 7] = [b.apart for b in blocks]
    return out


#: The labelled table: FEATURES, then 1 for main text. Blocks of pages written for this purpose:
#: articles with short and long paragraphs, menus, notices, adverts, comments, and pages without
#: an article element.
LABELLED = np.array(
    [
        # pages with an article: whatever isn't set apart in it is its text, however short
        [9, 0, 0, 0, 40, 0, 2, 0, 1],
        [40, 0, 9, 0, 1, 0, 2, 0, 1],
        [1, 0, 40, 0, 2, 0, 2, 0, 1],
        [2, 0, 1, 0, 120, 0.05, 2, 0, 1],
        [120, 0.05, 2, 0, 30, 0.4, 2, 0, 1],
        [30, 0.4, 120, 0.05, 6, 1, 2, 0, 1],
        [6, 1, 30, 0.4, 75, 0, 2, 0, 1],
        [1, 1, 60, 0, 60, 0, 2, 0, 1],
        [4, 0.5, 11, 0, 25, 0, 2, 0, 1],
        [300, 0, 1, 0, 1, 0, 2, 0, 1],
        [15, 0.1, 300, 0, 0, 0, 2, 0, 1],
        # in the article but set apart: adverts, forms, comments, share bars
        [12, 0, 80, 0, 90, 0, 2, 1, 0],
        [60, 0, 80, 0, 25, 0, 2, 1, 0],
        [25, 0.2, 60, 0, 110, 0, 2, 1, 0],
        [110, 0, 25, 0.2, 3, 1, 2, 1, 0],
        [3, 1, 110, 0, 0, 0, 2, 1, 0],
        [1, 0, 30, 0, 2, 1, 2, 1, 0],
        # a hint in the name of a part of the article: length and links decide
        [40, 0, 80, 0, 90, 0, 2, 2, 1],
        [110, 0.05, 40, 0, 12, 0, 2, 2, 1],
        [18, 0, 110, 0, 60, 0, 2, 2, 1],
        [70, 0.1, 3, 0, 0, 0, 2, 2, 1],
        [6, 0, 90, 0, 80, 0, 2, 2, 0],
        [10, 0.2, 80, 0, 40, 0, 2, 2, 0],
        [3, 1, 90, 0, 2, 1, 2, 2, 0],
        [25, 0.8, 80, 0, 60, 0, 2, 2, 0],
        # beside the article
        [1, 1, 0, 0, 1, 1, 0, 1, 0],
        [1, 1, 1, 1, 10, 0, 0, 1, 0],
        [10, 0, 1, 1, 9, 0, 0, 1, 0],
        [14, 0, 50, 0, 0, 0, 0, 1, 0],
        [90, 0, 20, 0, 0, 0, 0, 1, 0],
        [70, 0.05, 14, 0, 80, 0, 0, 0, 0],
        [8, 0, 0, 0, 40, 0, 0, 0, 0],
        [35, 0.3, 8, 0, 9, 0, 0, 0, 0],
        [2, 1, 35, 0, 2, 1, 0, 0, 0],
        [45, 0, 8, 0, 60, 0, 0, 2, 0],
        [90, 0.05, 45, 0, 20, 0, 0, 2, 0],
        [20, 0, 90, 0, 0, 0, 0, 2, 0],
        [60, 0.1, 5, 0, 90, 0, 0, 2, 0],
        [45, 0, 30, 0, 20, 0, 0, 0, 0],
        [60, 0.1, 8, 0, 12, 0, 0, 0, 0],
        [25, 0, 0, 0, 60, 0, 0, 0, 0],
        [120, 0, 5, 0, 0, 0, 0, 0, 0],
        [33, 0, 10, 0, 14, 0, 0, 0, 0],
        [9, 0, 50, 0, 20, 0, 0, 0, 0],
        [3, 0, 40, 0, 16, 0, 0, 0, 0],
        # pages without an article: long prose is main text, whatever stands beside it
        [60, 0, 8, 0, 45, 0, 1, 0, 1],
        [45, 0.05, 60, 0, 50, 0, 1, 0, 1],
        [25, 0.1, 45, 0, 33, 0.1, 1, 0, 1],
        [33, 0.1, 25, 0.1, 5, 1, 1, 0, 1],
        [18, 0, 40, 0, 22, 0, 1, 0, 1],
        [30, 0, 2, 1, 3, 1, 1, 0, 1],
        [24, 0, 1, 1, 0, 0, 1, 0, 1],
        [16, 0, 3, 0, 4, 0, 1, 0, 1],
        [12, 0, 2, 1, 5, 0, 1, 0, 1],
        [80, 0.2, 0, 0, 3, 1, 1, 0, 1],
        [50, 0.4, 60, 0.1, 45, 0, 1, 0, 1],
        [38, 0.45, 2, 1, 70, 0, 1, 0, 1],
        # short lines beside it: headings, one-word paragraphs, the last line
        [12, 0, 0, 0, 60, 0, 1, 0, 1],
        [7, 0, 2, 1, 55, 0, 1, 0, 1],
        [3, 0, 30, 0, 40, 0, 1, 0, 1],
        [1, 0, 25, 0, 25, 0, 1, 0, 1],
        [1, 0, 3, 0, 70, 0, 1, 0, 1],
        [2, 0, 40, 0, 1, 0, 1, 0, 1],
        [9, 0, 20, 0, 0, 0, 1, 0, 1],
        [2, 0, 60, 0, 1, 1, 1, 0, 1],
        [4, 0, 14, 0, 3, 0, 1, 0, 1],
        [5, 0, 1, 1, 13, 0, 1, 0, 1],
        [3, 0, 5, 0, 30, 0, 1, 0, 1],
        [9, 0, 3, 0, 25, 0, 1, 0, 1],
        [10, 0, 1, 1, 40, 0.1, 1, 0, 1],
        [6, 0, 4, 0, 25, 0, 1, 0, 1],
        [2, 0, 8, 0, 12, 0, 1, 0, 1],
        [1, 0, 2, 1, 20, 0, 1, 0, 1],
        [5, 0, 2, 0, 80, 0, 1, 0, 1],
        [8, 0, 16, 0, 0, 0, 1, 0, 1],
        [1, 0, 12, 0, 0, 0, 1, 0, 1],
        [6, 0, 30, 0, 5, 0, 1, 0, 1],
        [4, 0, 90, 0, 2, 1, 1, 0, 1],
        [7, 0.2, 45, 0.1, 3, 1, 1, 0, 1],
        # the only block of a page
        [20, 0, 0, 0, 0, 0, 1, 0, 1],
        [6, 0, 0, 0, 0, 0, 1, 0, 1],
        [1, 0, 0, 0, 0, 0, 1, 0, 1],
        # short lines among menus and other short lines
        [4, 0, 2, 1, 3, 1, 1, 0, 0],
        [6, 0, 1, 1, 2, 1, 1, 0, 0],
        [3, 0, 5, 0, 2, 1, 1, 0, 0],
        [8, 0, 2, 1, 0, 0, 1, 0, 0],
        [5, 0, 4, 0, 0, 0, 1, 0, 0],
        [2, 0, 0, 0, 1, 1, 1, 0, 0],
        [3, 0, 0, 0, 4, 0, 1, 0, 0],
        [7, 0, 8, 0, 6, 0, 1, 0, 0],
        [1, 0, 1, 0, 2, 0, 1, 0, 0],
        [9, 0.2, 3, 0, 5, 0, 1, 0, 0],
        [3, 0, 9, 0, 0, 0, 1, 0, 0],
        [2, 0, 7, 0, 6, 0, 1, 0, 0],
        [4, 0, 6, 1, 0, 0, 1, 0, 0],
        [5, 0, 0, 0, 9, 0, 1, 0, 0],
        [1, 0, 0, 0, 7, 0, 1, 0, 0],
        [6, 0, 9, 0, 9, 0, 1, 0, 0],
        [8, 0, 3, 0, 2, 0, 1, 0, 0],
        [2, 0, 4, 0, 8, 1, 1, 0, 0],
        # beside long lists of links
        [7, 0, 60, 0.9, 5, 1, 1, 0, 0],
        [6, 0, 3, 1, 40, 0.8, 1, 0, 0],
        [4, 0, 35, 1, 30, 1, 1, 0, 0],
        [2, 0, 25, 0.95, 6, 0, 1, 0, 0],
        [9, 0, 5, 0, 28, 0.9, 1, 0, 0],
        # links
        [1, 1, 0, 0, 1, 1, 1, 0, 0],
        [2, 1, 1, 1, 2, 1, 1, 0, 0],
        [5, 1, 2, 1, 60, 0, 1, 0, 0],
        [8, 0.75, 60, 0, 6, 1, 1, 0, 0],
        [30, 0.8, 6, 1, 28, 0.9, 1, 0, 0],
        [12, 0.6, 30, 0.8, 0, 0, 1, 0, 0],
        [1, 1, 0, 0, 0, 0, 1, 0, 0],
        [3, 0.7, 50, 0, 60, 0, 1, 0, 0],
        # hints of a name there
        [60, 0, 8, 0, 45, 0, 1, 2, 1],
        [22, 0.05, 60, 0, 50, 0, 1, 2, 1],
        [8, 0, 50, 0, 40, 0, 1, 2, 0],
        [2, 1, 3, 1, 2, 1, 1, 2, 0],
        [30, 0.8, 2, 1, 40, 0, 1, 2, 0],
        [40, 0, 0, 0, 50, 0, 1, 1, 0],
        [6, 0, 50, 0, 0, 0, 1, 1, 0],
        [1, 1, 3, 0, 2, 1, 1, 1, 0],
        [100, 0.1, 60, 0, 20, 0, 1, 1, 0],
    ]
)

#: Where a page has an article, its container says it all: rows of every length, density and neighbourhood, in it, set apart in it, and beside it.
_PLACED = np.array(
    [
        [words, density, before, link_before, after, link_after, place, apart, int(place == 2 and not apart)]
        for words, density in ((1, 0), (2, 1), (4, 0), (8, 0.5), (12, 0), (20, 0.1), (45, 0), (110, 0.05))
        for before, link_before, after, link_after in ((1, 0, 2, 1), (3, 1, 60, 0), (40, 0, 30, 0.1), (75, 0, 0, 0), (0, 0, 9, 0))
        for place, apart in ((2, 0), (2, 1), (0, 0), (1, 1))
    ]
)


def grow(rows: np.ndarray, depth: int = 10, least: int = 1) -> tuple:
    """A CART tree by Gini impurity: ``("leaf", share)`` or ``("split", feature, cut, low, high)``.

    Ties go to the first feature and the smallest cut; cuts lie midway between values.
    """
    y = rows[:, -1]
    share = float(y.mean())
    if depth == 0 or share in (0.0, 1.0) or len(rows) < 2 * least:
        return ("leaf", share)
    best = None
    for f in range(rows.shape[1] - 1):
        values = np.unique(rows[:, f])
        for cut in (values[1:] + values[:-1]) / 2:
            low = rows[:, f] <= cut
            n = low.sum()
            if n < least or len(rows) - n < least:
                continue
            a, b = y[low].mean(), y[~low].mean()
            cost = n * a * (1 - a) + (len(rows) - n) * b * (1 - b)
            if best is None or cost < best[0] - 1e-12:
                best = (cost, f, float(cut), low)
    if best is None:
        return ("leaf", share)
    _, f, cut, low = best
    return ("split", f, cut, grow(rows[low], depth - 1, least), grow(rows[~low], depth - 1, least))


def decide(tree: tuple, x: np.ndarray) -> np.ndarray:
    """Share of main text at the leaf of each row."""
    if tree[0] == "leaf":
        return np.full(len(x), tree[1])
    out, low = np.empty(len(x)), x[:, tree[1]] <= tree[2]
    out[low], out[~low] = decide(tree[3], x[low]), decide(tree[4], x[~low])
    return out


@cache
def default_tree() -> tuple:
    return grow(np.concatenate((LABELLED, _PLACED)))


def main_texts(pages: list[str | None], tree: tuple | None = None) -> list[str]:
    """The main text of each page: its main blocks in page order, one to a line."""
    found = [blocks_of(p) for p in pages]
    rows = [features_of(b) for b in found if b]
    keep = iter((decide(tree or default_tree(), np.concatenate(rows)) >= 0.5).tolist() if rows else [])
    return ["\n".join([b.text for b in blocks if next(keep)]) for blocks in found]


def main_text(page: str | None, tree: tuple | None = None) -> str:
    """The main text of one page."""
    return main_texts([page], tree)[0]


#: Pages whose blocks are classified at once.
_PAGES = 100


@F.pandas_udf(T.StringType())
def _main_text(pages: pd.Series) -> pd.Series:
    texts = [t for k in range(0, len(pages), _PAGES) for t in main_texts(pages.iloc[k : k + _PAGES].tolist())]
    return pd.Series([t.encode("utf-8", "replace").decode("utf-8") for t in texts], dtype=object)


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars (code points).

    Null and empty pages have empty text. Repeated rows give repeated rows, an empty table
    an empty result; other columns are ignored. Pages of any length are read whole, and
    nothing of them is cut; an element that nothing closes ends with the page, and if its
    content would be left out (a button, a list of choices) only its tag is.
    """
    return pages.select("page_id", "url", _main_text(pages["html"]).alias("text")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


