"""Main text of web pages by text-to-tag ratio.

The standard library's parser streams its events. Every block of a page is a line with its text, the
characters of it outside of links, and the number of tags spent on it. Elements that by their tag are
no part of an article give no line (a heading within a header goes with it). The ratio of characters
to tags is smoothed over neighbouring lines with a Gaussian; lines above a threshold, a share of the
mean, are content. Within an article or main element the ratio counts ``PRIOR`` times; that is all
the tag does to the choice of lines.

Forms, and elements whose class, id or role sounds like a menu, an advert or comments, are doubtful, and
their lines more so for each such element around them. The clusters are first made of the lines without
doubt. They stand if they hold a line of some length, or a fair part of the text against the doubtful
lines of the same article (of the page, if none is in one); else the next doubtful lines come in, from
elements that hold at least half as much as the largest one. So a name alone takes out nothing that is
all a page has, whatever it sounds like.

The clusters choose regions. A region is the lines directly within one list, division, cell or the
like, or all of an article or main element. It is content if content lines have at least ``HALF`` of
its characters, and an article only if its own ratio isn't far below (a teaser beside an article is);
an article that isn't is looked at by its inner regions. A region of low lines still
belongs to the text if most of it is outside of links, it stands beside or within a chosen region,
and it lies before the last chosen line and after the first, or has several lines and is no article. On a page with a
chosen article such regions are looked for only in articles. All lines of a chosen region belong to
the text, so that headings and short paragraphs stay.

Defined results: a null or empty page has an empty text; broken or cut-off markup is read as far as
it goes; an end tag closes what stands open inside; left-out end tags are implied as HTML has them, so
a start tag ends the head, an open paragraph, list item, term, option, row or cell; white space is the
ASCII kind; repeated rows get equal results.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from tidemark.llm.common import mapped, unused

# Elements without article text, elements without end tag, elements that end a line.
NEVER = frozenset(
    "script style head title nav footer header aside noscript template iframe svg button select textarea "
    "input menu dialog object audio video canvas".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body br center dd details div dl dt fieldset figcaption figure footer form h1 "
    "h2 h3 h4 h5 h6 header hr html legend li main nav ol option p pre section summary table tbody td tfoot th thead tr ul".split()
)
HOLDER = frozenset("article main section div td th body blockquote ul ol dl".split())
ARTICLE = frozenset({"article", "main"})
LINK = "a href"  # an a element that leads elsewhere
# End tags that may be left out. A start tag ends the open elements of its row, as far out as the scope.
_SCOPE = frozenset("html body table template button object".split())
_ENDS_P = frozenset(
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 header hgroup hr legend main menu nav ol p pre search section summary table ul".split()
)
_LISTS = _SCOPE | frozenset("ul ol dl menu section article main aside nav header footer form blockquote details fieldset td th".split())
_PARTS = frozenset("caption colgroup tbody thead tfoot".split())
_ROWS = frozenset("caption colgroup tbody thead tfoot".split())
ENDED = {
    "li": (frozenset({"li"}), _LISTS),
    "dt": (frozenset({"dt", "dd"}), _LISTS),
    "dd": (frozenset({"dt", "dd"}), _LISTS),
    "option": (frozenset({"option"}), _SCOPE | {"select", "datalist", "optgroup"}),
    "optgroup": (frozenset({"option", "optgroup"}), _SCOPE | {"select", "datalist"}),
    "td": (frozenset({"td", "th"}), _SCOPE | {"tr"}),
    "th": (frozenset({"td", "th"}), _SCOPE | {"tr"}),
    "tr": (frozenset({"tr", "caption", "colgroup"}), _SCOPE | {"tbody", "thead", "tfoot"}),
    **{tag: (_ROWS | {"tr"}, _SCOPE) for tag in _ROWS},
    "rt": (frozenset({"rt", "rp"}), _SCOPE | {"ruby"}),
    "rp": (frozenset({"rt", "rp"}), _SCOPE | {"ruby"}),
    **{tag: (frozenset({"p"}), _SCOPE | {"td", "th", "caption"}) for tag in _ENDS_P},
}
IN_HEAD = frozenset("html head base basefont bgsound link meta title style script noscript template".split())
# Names that sound like no part of an article, and names of a state ("no-ads", "comments-open").
NAMED = re.compile(
    r"^(?:ads?|advert.*|ad[-_].*|.*[-_]ads?|banner|sidebar|side[-_]bar|menu|nav|navbar|navigation|breadcrumbs?|"
    r"(?:site|page|global|main)?[-_]?(?:footer|header)|masthead|cookies?(?:[-_].*)?|consent.*|gdpr.*|notices?|alert|popup|modal|"
    r"promo.*|sponsor.*|related.*|recommend.*|shar(?:e|ing).*|social.*|comments?(?:[-_].*)?|(?:.*[-_])?comments?|respond|repl(?:y|ies)|"
    r"subscribe|newsletter|signup|login|paginat.*|pager|widgets?|toolbar|disclaimer|outbrain|taboola)$",
    re.IGNORECASE,
)
STATE = re.compile(r"^(?:no|not|has|with|without|is|hide)[-_]|[-_](?:open|closed|on|off|enabled|disabled|hidden)$", re.IGNORECASE)
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
SIGMA = 1.0
SHARE = 0.5
PRIOR = 3.0
HALF = 0.5
#: A line of so many characters is text by itself, as is a part of the doubtful text so large.
LONG = 80
PART = 0.1
_WHITE = re.compile(r"[\x20\x09-\x0D]+")

#: Text, characters outside of links, tags, holders around it, doubtful elements around it.
Line = tuple[str, int, int, tuple[int, ...], tuple[int, ...]]


class _Lines(HTMLParser):
    """Collects (text, plain, tags, holders, doubts) for every block outside of what is never an article."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        self.articles: set[int] = set()
        # tag, hidden, number as a holder or 0, tags counted before a doubtful element or -1
        self.open: list[tuple[str, bool, int, int]] = []
        self.places: dict[str, list[int]] = {}  # of open elements in ``open``, by tag
        self.hidden = 0
        self.doubts: list[int] = []  # numbers of the open doubtful elements
        self.doubtful = 0
        self.tags = 0
        self.links = 0
        self.linked = 0
        self.parts: list[str] = []
        self.holders = 0

    def _end_line(self) -> None:
        text = _WHITE.sub(" ", "".join(self.parts)).strip(" ")
        self.parts.clear()
        if text:
            plain = max(len(text) - self.linked, 0)
            holders = tuple(h for _, _, h, _ in self.open if h)
            self.lines.append((text, plain, max(self.tags, 1), holders, tuple(self.doubts)))
            self.tags = 0
        self.linked = 0

    def _close(self, at: int) -> None:
        """End the open element at a place and all within it."""
        while len(self.open) > at:
            tag, hidden, _, before = self.open[-1]
            if before >= 0:
                # The lines around a doubtful element count their own tags alone.
                if not self.hidden:
                    self._end_line()
                self.tags = before
                self.doubts.pop()
            self.open.pop()
            self.hidden -= hidden
            self.places[tag].pop()
            self.links -= tag == LINK

    def _end_implied(self, tag: str) -> None:
        """End what the start of this element ends where end tags are left out."""
        if self.open and self.open[-1][0] == "head" and tag not in IN_HEAD:
            self._close(len(self.open) - 1)
        if tag not in ENDED:
            return
        ended, scope = ENDED[tag]
        if not any(self.places.get(t) for t in ended):
            return
        bound = max((self.places[t][-1] for t in scope if self.places.get(t)), default=-1)
        inside = [p[n] for p in (self.places.get(t, []) for t in ended) if (n := bisect_right(p, bound)) < len(p)]
        if inside:
            self._close(min(inside))

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCK and not self.hidden:
            self._end_line()
        self._end_implied(tag)
        self.tags += not self.hidden
        if tag in VOID:
            return
        if tag == "a" and any(k == "href" for k, _ in attrs):
            tag = LINK
            self.links += 1
        hidden = tag in NEVER
        doubtful = tag == "form"
        if not hidden:
            named = {k: v or "" for k, v in attrs if k in ("class", "id", "role", "hidden", "aria-hidden")}
            hidden = "hidden" in named or named.get("aria-hidden") == "true"
            # An article is judged by its class only after another, as comments and teasers come after.
            if named and tag not in ("html", "body", "main") and (tag != "article" or self.articles):
                words = f"{named.get('class', '')} {named.get('id', '')}".split()
                doubtful |= any(NAMED.match(w) and not STATE.search(w) for w in words)
                doubtful |= named.get("role", "").lower() in ROLES
        doubtful = doubtful and not hidden and not self.hidden
        if (hidden or doubtful) and not self.hidden:
            self._end_line()
        before = -1
        if doubtful:
            before, self.tags = self.tags, 0
            self.doubtful += 1
            self.doubts.append(self.doubtful)
        holder = 0
        if tag in HOLDER:
            self.holders += 1
            holder = self.holders
            if tag in ARTICLE:
                self.articles.add(holder)
        self.hidden += hidden
        self.places.setdefault(tag, []).append(len(self.open))
        self.open.append((tag, hidden, holder, before))

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        self.tags += not self.hidden
        if tag in BLOCK and not self.hidden:
            self._end_line()
        if tag == "a" and self.places.get(LINK):
            tag = LINK
        if self.places.get(tag):
            self._close(self.places[tag][-1])

    def handle_data(self, data: str) -> None:
        if self.open and self.open[-1][0] == "head" and _WHITE.sub("", data):
            self._close(len(self.open) - 1)  # text cannot stand in the head
        if not self.hidden:
            self.parts.append(data)
            if self.links:
                self.linked += len(_WHITE.sub(" ", data))

    def finish(self) -> None:
        self.close()
        self._end_line()


def _smooth(ratios: np.ndarray) -> np.ndarray:
    reach = max(1, math.ceil(2 * SIGMA))
    kernel = np.exp(-(np.arange(-reach, reach + 1) ** 2) / (2 * SIGMA**2))
    weight = np.convolve(np.ones(len(ratios)), kernel, "full")[reach : reach + len(ratios)]
    return np.convolve(ratios, kernel, "full")[reach : reach + len(ratios)] / weight


def main_text(html: str | None) -> str:
    """The article of a page, its blocks joined by one space."""
    if not html:
        return ""
    page = _Lines()
    page.feed(html)
    page.finish()
    # Characters within each doubtful element, and the largest sum at each depth.
    held: dict[int, int] = {}
    largest: dict[int, int] = {}
    for line in page.lines:
        for element in line[4]:
            held[element] = held.get(element, 0) + line[1]
    for line in page.lines:
        for depth, element in enumerate(line[4]):
            largest[depth] = max(largest.get(depth, 0), held[element])
    for doubts in range(len(largest) + 1):
        sure = [
            line
            for line in page.lines
            if len(line[4]) <= doubts and all(held[e] >= HALF * largest[d] for d, e in enumerate(line[4]))
        ]
        kept = [line for line, good in zip(sure, _clusters(sure, page.articles)) if good] if sure else []
        inside = page.articles.intersection(h for line in kept for h in line[3])
        more = sum(line[1] for line in page.lines if len(line[4]) > doubts and not (inside and inside.isdisjoint(line[3])))
        if more == 0 or any(line[1] >= LONG for line in kept) or sum(line[1] for line in kept) >= max(PART * more, 1):
            return " ".join(line[0] for line in kept)
    return ""


def _clusters(lines: list[Line], page_articles: set[int]) -> np.ndarray:
    """Which lines the clusters of smoothed ratios choose."""
    if not any(line[1] for line in lines):  # a page of links alone
        lines = [(text, len(text), tags, holders, doubts) for text, _, tags, holders, doubts in lines]
    prior = [PRIOR if page_articles.intersection(line[3]) else 1.0 for line in lines]
    ratios = _smooth(np.array([p * line[1] / line[2] for p, line in zip(prior, lines)]))
    least = SHARE * ratios.mean()
    content = ratios >= least

    # Characters of each region: outside of links, of these in content lines, and all; tags.
    sums: dict[int, list[int]] = {}
    count: dict[int, int] = {}
    above: dict[int, int] = {}
    homes = []
    for (text, plain, tags, holders, _), good in zip(lines, content):
        home = holders[-1] if holders else 0
        homes.append(home)
        above[home] = holders[-2] if len(holders) > 1 else 0
        count[home] = count.get(home, 0) + 1
        for region in {home, *page_articles.intersection(holders)}:
            one = sums.setdefault(region, [0, 0, 0, 0])
            one[0] += plain
            one[1] += plain if good else 0
            one[2] += len(text)
            one[3] += tags
    chosen = {
        r
        for r, (plain, good, _, tags) in sums.items()
        if good > 0 and good >= HALF * plain and (r not in page_articles or PRIOR * plain >= SHARE * least * tags)
    }
    articles = chosen & page_articles

    kept = np.array([h in chosen or not articles.isdisjoint(line[3]) for h, line in zip(homes, lines)])
    if kept.any():
        first, last = np.flatnonzero(kept)[[0, -1]]
        near = {above[h] for h in chosen if h in above} | chosen
        for n, (home, line) in enumerate(zip(homes, lines)):
            plain, _, size, _ = sums[home]
            holders = line[3]
            if kept[n] or 2 * plain <= size or above[home] not in near:
                continue
            if articles and page_articles.isdisjoint(holders):
                continue
            kept[n] = first < n < last or (count[home] > 1 and home not in page_articles)
    return kept


def extract(pages: DataFrame, html: str = "html", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` of each page, by default all but the markup, and ``main_text``."""
    keep = [c for c in pages.columns if c != html] if keep is None else keep
    keep = [c for c in keep if c.lower() != "main_text"]
    inner = unused(pages, "__html")
    rows = pages.select(*[pages[c] for c in keep], pages[html].alias(inner))
    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1]]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            frame["main_text"] = [main_text(h) for h in frame.pop(inner)]
            yield frame

    return mapped(rows, run, ", ".join([*kinds, "main_text string"]))
