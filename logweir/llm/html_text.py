"""Main text of HTML pages from parser events and the text-to-tag ratio of lines.

The standard library's parser streams its events; block tags end lines, inline tags don't. A line has its text, the
tags that it took, the container it stands in and the nearest part that names itself a menu, form, advert or the like,
by tag, role, class, id or heading. Its ratio of text to tags is smoothed with a Gaussian over the neighbouring lines,
and lines at or above the standard deviation of the smoothed ratios are the content cluster.

The cluster first judges the named parts: one that holds most of the page's cluster is no boilerplate whatever its
name, and inside an article a name that is also an ordinary word needs content made of links. Lines of the other named
parts go. The cluster of the lines left shows the region: an article that holds most of the cluster's text, or else
the deepest container that holds all of it and isn't itself a part of a text, as a table, list, quote or section is.
The text is that region's lines, short ones included; outside an article, lines that are mostly links stay only if
they are in the cluster.

Containers and parts are numbered as they open, so sums over them are single passes: time and memory grow with the page.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

# Element names of HTML.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var wbr nobr label ruby rb rt rp img picture source".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CONTAINERS = frozenset(
    "html body main article section div aside nav header footer form fieldset table ul ol dl figure details center blockquote menu dialog".split()
)
NEVER = frozenset("head script style noscript template svg math iframe object canvas audio video select textarea button option datalist map title".split())
PARTS = frozenset("table ul ol dl blockquote details figure section center fieldset".split())
BOILER = frozenset("nav footer aside menu dialog".split())
ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert menu menubar toolbar form".split())
# Words of class and id names that mark a part which isn't the article.
HINTS = frozenset(
    """ad ads adv advert adverts advertisement advertising adsense banner promo promotion promoted sponsor sponsored sponsors
    cookie cookies consent gdpr notice notices notification notifications alert popup popover modal overlay lightbox newsletter
    subscribe subscription signup login register share sharing social related recommend recommended recommendations trending
    sidebar side aside rail widget widgets menu menus nav navbar navigation breadcrumb breadcrumbs pagination pager toc toolbar
    footer foot copyright comment comments commentlist disqus reply replies respond discussion form search paywall""".split()
)
HEAD_HINTS = frozenset("header masthead topbar".split())
# Names of readers' comments, and names that are also ordinary words of an article.
COMMENTS = frozenset("comment comments commentlist disqus reply replies respond".split())
ORDINARY = frozenset("share sharing social related recommend recommended recommendations trending promotion register side rail widget discussion form search toc".split())
# Headings that name the part they begin, in the languages of the given pages.
HEADINGS = frozenset(
    ["comment", "comments", "reader comments", "leave a comment", "post a comment", "leave a reply", "related articles", "related posts", "related stories",
     "you may also like", "share this", "kommentare", "leserkommentare", "ähnliche artikel", "commentaires", "articles similaires", "comentarios", "artículos relacionados"]
)
HEADED = frozenset("section div ol ul details".split())
# Elements without text of the page that a block tag ends if their own end tag is missing.
ENDED = frozenset("head button select option datalist map".split())

MOST = 0.6
SIGMA = 1.0
LINKS = 0.6

# What a part is: left out always, left out by its name, readers' comments, or named by an ordinary word.
ALWAYS, NAMED, READERS, WORDED = range(4)


class Lines(HTMLParser):
    """Lines of a page as (text, tags, share of text in links, container, part), the containers and the parts.

    Containers and parts are lists by number, 0 is the page itself; what opens later has a greater number.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, float, int, int]] = []
        self.pieces: list[str] = []
        self.tags = 0
        self.linked = 0
        self.in_link = 0
        self.heading = False
        self.never: list[str] = []  # open elements without text of the page
        self.never_open: Counter = Counter()
        self.open: list[tuple[str, int]] = [("", 0)]
        self.tags_open: Counter = Counter()
        self.articles_open = 0
        self.article_seen = False
        # By container: parent, outermost article (0: none), whether it is a part of a text, whether it has a line.
        self.parent, self.article, self.of_text, self.has_line = [0], [0], [False], [False]
        # Open parts with their depth in ``open``. By part: outer part, kind, whether it stands in an article.
        self.parts: list[tuple[int, int]] = []
        self.outer, self.kind, self.within = [0], [NAMED], [False]

    def flush(self) -> None:
        if self.pieces:
            text = " ".join("".join(self.pieces).split())
            if text:
                tag, at = self.open[-1]
                if self.heading and not self.has_line[at] and tag in HEADED and " ".join(re.findall(r"[^\W\d_]+", text.lower())) in HEADINGS:
                    self._begin_part(READERS)
                self.has_line[at] = True
                part = self.parts[-1][0] if self.parts else 0
                self.article_seen |= self.articles_open > 0 and part == 0
                self.lines.append((text, max(1, self.tags), min(1.0, self.linked / len(text)), at, part))
            self.pieces, self.linked = [], 0
        self.tags = 0

    def _begin_part(self, kind: int) -> None:
        self.outer.append(self.parts[-1][0] if self.parts else 0)
        self.kind.append(kind)
        self.within.append(self.articles_open > 0)
        self.parts.append((len(self.kind) - 1, len(self.open)))

    def _close(self) -> None:
        """Closes the innermost container and the parts that began with it."""
        tag, _ = self.open.pop()
        self.tags_open[tag] -= 1
        self.articles_open -= tag in ("article", "main")
        while self.parts and self.parts[-1][1] > len(self.open):
            self.parts.pop()

    def _part(self, tag: str, attrs: list[tuple[str, str | None]]) -> int | None:
        """Kind of the part that an element begins, if any."""
        values = {k: v or "" for k, v in attrs}
        inside = self.articles_open > 0
        if tag in BOILER or tag == "header" and not inside:
            return ALWAYS
        if tag in ("html", "body", "main") or tag == "article" and not self.article_seen:
            return None
        if "hidden" in values or values.get("aria-hidden") == "true" or re.search(r"display\s*:\s*none", values.get("style", "")):
            return ALWAYS
        words = set(re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", f"{values.get('class', '')} {values.get('id', '')}").lower()))
        if words & COMMENTS:
            return READERS
        if tag == "article":
            return None
        if tag == "form" or values.get("role", "").lower() in ROLES or words & (HINTS - ORDINARY) or not inside and words & HEAD_HINTS:
            return NAMED
        return WORDED if words & ORDINARY else None

    def _without_text(self, tag: str) -> bool:
        """Whether a start tag stands in an element without text; ends such elements that lack their end tag."""
        if tag in ("body", "article", "main"):
            self.never.clear()
            self.never_open.clear()
        while self.never and self.never[-1] in ENDED and tag not in INLINE and tag not in VOID and tag != "optgroup":
            if tag == "div" and self.never[-1] == "button":
                break
            self.never_open[self.never.pop()] -= 1
        return bool(self.never)

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in NEVER:
            self.flush()
            self.never.append(tag)
            self.never_open[tag] += 1
            return
        if self._without_text(tag):
            return
        if tag in INLINE:
            self.tags += 1
            self.in_link += tag == "a"
            return
        self.flush()
        self.tags += 1
        if tag in VOID:
            return
        while self.open[-1][0] == "p" or tag == "li" and self.open[-1][0] == "li":
            self._close()
        self.heading = len(tag) == 2 and tag[0] == "h" and tag[1] in "123456"
        kind = self._part(tag, attrs)
        if tag in ("article", "main") and kind is None and not self.article_seen:
            self.parts.clear()  # a part that holds the article was named wrongly or never closed
        if tag in CONTAINERS or kind is not None:
            outer = self.open[-1][1]
            self.parent.append(outer)
            number = len(self.parent) - 1
            self.article.append(self.article[outer] or number * (tag == "article"))
            self.of_text.append(tag in PARTS)
            self.has_line.append(False)
            self.open.append((tag, number))
            self.tags_open[tag] += 1
            if kind is not None:
                self._begin_part(kind)
            self.articles_open += tag in ("article", "main")

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in VOID or tag in INLINE:
            self.handle_starttag(tag, attrs)
            if tag == "a":
                self.in_link = max(0, self.in_link - 1)
        elif tag not in NEVER:
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        if tag in NEVER:
            while self.never_open[tag]:
                last = self.never.pop()
                self.never_open[last] -= 1
                if last == tag:
                    break
            return
        if self.never:
            return
        self.tags += 1
        if tag in INLINE:
            self.in_link = max(0, self.in_link - (tag == "a"))
            return
        tags = self.tags
        self.flush()
        if not self.lines or tags == self.tags:
            self.tags = 0
        self.in_link = 0
        self.heading = False
        if self.tags_open[tag]:
            while self.open[-1][0] != tag:
                self._close()
            self._close()

    def handle_data(self, data: str) -> None:
        if not self.never:
            self.pieces.append(data)
            if self.in_link:
                self.linked += len(data.strip())

    def unknown_decl(self, data: str) -> None:
        """Marked sections carry no text."""


def content_lines(lines: list[tuple[str, int, float, int, int]]) -> np.ndarray:
    """Which lines belong to the cluster of high smoothed ratios."""
    ratio = np.array([len(text) / tags for text, tags, *_ in lines])
    reach = np.arange(-2, 3)
    kernel = np.exp(-(reach**2) / (2 * SIGMA**2))
    padded = np.convolve(ratio, kernel, "full")[2 : 2 + len(ratio)]
    smooth = padded / np.convolve(np.ones(len(ratio)), kernel, "full")[2 : 2 + len(ratio)]
    return smooth >= min(smooth.std(), smooth.max())


def _upwards(own: list[float], outer: list[int]) -> list[float]:
    """Sums over each number and all that lie in it."""
    total = list(own)
    for k in range(len(own) - 1, 0, -1):
        total[outer[k]] += total[k]
    return total


def left_out(parser: Lines) -> list[bool]:
    """Which parts are boilerplate."""
    n = len(parser.kind)
    always = [False] * n
    for k in range(1, n):
        always[k] = always[parser.outer[k]] or parser.kind[k] in (ALWAYS, READERS)
    chars, linked, cluster, count = ([0.0] * n for _ in range(4))
    for text, _, share, _, part in parser.lines:
        chars[part] += len(text)
        linked[part] += share * len(text)
    seen = [x for x in parser.lines if not always[x[4]]]
    in_article = 0
    for (text, _, share, at, part), good in zip(seen, content_lines(seen) if seen else ()):
        if good and share <= LINKS:
            cluster[part] += len(text)
            count[part] += 1
            in_article += part == 0 and parser.article[at] > 0
    chars, linked, cluster, count = (_upwards(x, parser.outer) for x in (chars, linked, cluster, count))
    out = [False] * n
    for k in range(1, n):
        most = count[k] > 1 and cluster[k] >= MOST * cluster[0] and (parser.within[k] or not in_article)
        text_of_article = parser.kind[k] == WORDED and parser.within[k] and linked[k] <= chars[k] / 2
        out[k] = out[parser.outer[k]] or always[k] or not (most or text_of_article)
    return out


def main_text(html: str | None) -> str:
    """Main text of one page; empty for null, empty and textless pages."""
    parser = Lines()
    try:
        parser.feed(html or "")
        parser.close()
    except AssertionError:  # a broken declaration; what came before it counts
        pass
    parser.flush()
    out = left_out(parser)
    lines = [x for x in parser.lines if not out[x[4]]]
    if not lines:
        return ""
    content = content_lines(lines)
    held: Counter = Counter()  # cluster text of each outermost article
    good_lines = [0] * len(parser.parent)
    total = 0
    for (text, _, _, at, _), good in zip(lines, content):
        if good:
            total += len(text)
            good_lines[at] += 1
            if parser.article[at]:
                held[parser.article[at]] += len(text)
    article = max(held, key=lambda k: held[k], default=0)
    inside = article > 0 and held[article] >= MOST * total
    if inside:
        region = article
    else:
        good_lines = _upwards(good_lines, parser.parent)
        region = at = max(k for k, n in enumerate(good_lines) if n == good_lines[0])
        while at:
            if parser.of_text[at]:
                region = parser.parent[at]
            at = parser.parent[at]
    member = [region == 0] * len(parser.parent)
    for k in range(1, len(member)):
        member[k] = k == region or member[parser.parent[k]]
    return " ".join(text for (text, _, linked, at, _), good in zip(lines, content) if member[at] and (inside or linked <= LINKS or good))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, len(batch), 256):
            part = batch.slice(k, 256)
            texts = [main_text(x.as_py()) for x in part.column("html")]
            yield pa.RecordBatch.from_arrays(
                [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )


def page_texts(pages: DataFrame) -> DataFrame:
    """Per row ``page_id, url, text, n_chars``: the main text of the whole page and its number of code points.

    White space inside a block becomes one space, blocks are joined by one space. A null, empty or textless page gives
    an empty text. Null ids and urls and repeated rows are kept; other columns aren't read. An empty table gives no
    rows. Each page is parsed alone, so memory is bounded by the longest one.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html"))
    return rows.mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
