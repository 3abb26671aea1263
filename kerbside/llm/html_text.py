"""Main text of web pages by smoothed text-to-tag ratios."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
from pyspark.sql import DataFrame

from kerbside.llm.frames import map_rows

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that begin and end a line of text.
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody "
    "td textarea tfoot th thead title tr ul".split()
)
#: Elements that never hold text of the article.
OUTSIDE = frozenset(
    "head title script style noscript template nav footer aside form button select textarea iframe object svg canvas audio video menu dialog "
    "fieldset search".split()
)
#: Elements that can hold an article.
HOLDERS = frozenset("html body main article section div td center".split())
ARTICLES = frozenset(("article", "main"))
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar".split())
#: Words of class names and ids of what is no article.
MARKED = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox adslot banner breadcrumb breadcrumbs comment comments commentlist cookie cookies "
    "consent copyright disqus footer form gdpr header masthead menu modal nav navbar navigation newsletter notice notification notifications "
    "overlay pager pagination popup promo promoted promotion recommended related reply replies responses share sharing sidebar signup skip "
    "social sponsor sponsored subscribe tagcloud toolbar topbar alert login search widget discussion respond teaser outbrain taboola "
    "notices sidebars menus footers headers promos sponsors shares toc".split()
)
#: Inside an article these words name its own head, as the element does.
OWN_HEAD = frozenset(("header", "headers"))
#: Elements whose ids are made from their headings, or name a place to link to.
ANCHORED = frozenset("h1 h2 h3 h4 h5 h6 p section".split())
#: One line each: inside an article, class words of these are weighed with the lines around.
SHORT = ANCHORED - {"section"}
#: What is left of the ratio of a line in an element of an article whose class or id is marked.
LOWERED = 0.7
#: A start tag that ends an open element of these kinds, as HTML has it.
ENDS = {
    "li": frozenset(("li",)), "dt": frozenset(("dt", "dd")), "dd": frozenset(("dt", "dd")), "option": frozenset(("option",)),
    "tr": frozenset(("tr", "td", "th")), "td": frozenset(("td", "th")), "th": frozenset(("td", "th")),
}
WORDS = re.compile(r"[a-z]+|[0-9]+")
SPLIT_CASE = re.compile(r"(?<=[a-z])(?=[A-Z])")


def is_hidden(attrs: list[tuple[str, str | None]]) -> bool:
    """Whether the page says by role or state that an element is no article."""
    for name, value in attrs:
        if name == "hidden" or (name == "aria-hidden" and value == "true") or (name == "role" and value and value.strip().lower() in ROLES):
            return True
    return False


def is_marked(attrs: list[tuple[str, str | None]], tag: str = "", within: bool = False) -> bool:
    """Whether words of class or id name something that is no article."""
    for name, value in attrs:
        if not value or not (name == "class" or (name == "id" and tag not in ANCHORED)):
            continue
        found = MARKED.intersection(WORDS.findall(f"{value} {SPLIT_CASE.sub(' ', value)}".lower()))
        if found - OWN_HEAD if within else found:
            return True
    return False


@dataclass
class Node:
    """An element; ``mark`` is the innermost marked element it is in, where that is part of an article, or -1."""

    tag: str
    parent: int
    outside: bool
    within: bool = False
    mark: int = -1


@dataclass
class Line:
    """A line of text: its parts, tags in it, characters in links, its element."""

    node: int
    outside: bool
    parts: list[str] = field(default_factory=list)
    tags: int = 0
    linked: int = 0
    text: str = ""
    mark: int = -1


class Lines(HTMLParser):
    """The lines of a page in page order, from the parser's events."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.nodes = [Node("", -1, False)]
        self.open = [0]
        self.links = 0
        self.lines: list[Line] = []
        self.line: Line | None = None
        self.pending = 0

    def _end_line(self) -> None:
        if self.line:
            self.lines.append(self.line)
            self.line = None
        self.pending = 0

    def _close(self, at: int) -> None:
        for node in self.open[at:]:
            self.links -= self.nodes[node].tag == "a"
        del self.open[at:]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in BLOCK:
            self._end_line()
            self._close_implied(tag)
        elif self.line:
            self.line.tags += 1
        else:
            self.pending += 1
        if tag == "br" and self.line:
            self.line.parts.append(" ")
        if tag in VOID:
            return
        parent, own = self.open[-1], len(self.nodes)
        up = self.nodes[parent]
        outside, within, mark = up.outside or tag in OUTSIDE, up.within or tag in ARTICLES, up.mark
        if attrs and not outside and tag not in ("html", "body"):
            if is_hidden(attrs):
                outside = True
            elif is_marked(attrs, tag, within):
                if not within:
                    outside = True
                elif mark < 0 or tag not in SHORT:
                    mark = own
        if tag == "header" and not outside:  # an article's own header is part of it
            outside = not within
        if tag in ARTICLES and outside and not is_hidden(attrs) and not is_marked(attrs):  # what was left open before it does not cover it
            outside = any(self.nodes[n].tag in ("aside", "template", "noscript") or self.nodes[n].tag in ARTICLES for n in self.open)
            mark = -1
        self.nodes.append(Node(tag, parent, outside, within, mark))
        self.open.append(len(self.nodes) - 1)
        self.links += tag == "a"

    def _close_implied(self, tag: str) -> None:
        """Close what a block element ends: an open paragraph, and items of its own kind."""
        for at in range(len(self.open) - 1, 0, -1):
            name = self.nodes[self.open[at]].tag
            if name == "p" or name in ENDS.get(tag, ()):
                self._close(at)
                return
            if name in HOLDERS or name in ("ul", "ol", "dl", "table", "blockquote"):
                return

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK:
            self._end_line()
        elif self.line:
            self.line.tags += 1
        for at in range(len(self.open) - 1, 0, -1):
            name = self.nodes[self.open[at]].tag
            if name == tag:
                self._close(at)
                return
            if name in HOLDERS and tag not in HOLDERS and tag not in ("ul", "ol", "dl", "table"):
                return  # a stray end tag inside a block closes nothing outside it

    def handle_data(self, data: str) -> None:
        line = self.line
        if line is None:
            if not data.strip():
                return
            node = self.open[-1]
            line = self.line = Line(node, self.nodes[node].outside, tags=self.pending, mark=self.nodes[node].mark)
        elif line.outside != self.nodes[self.open[-1]].outside:  # an advert inside a line
            tags = line.tags
            self._end_line()
            node = self.open[-1]
            self.line = line = Line(node, self.nodes[node].outside, tags=tags, mark=self.nodes[node].mark)
        if data.strip():  # a line of which only a part is marked is not
            line.mark = min(line.mark, self.nodes[self.open[-1]].mark)
        line.parts.append(data)
        if self.links:
            line.linked += len(data)


def page_lines(html: str) -> tuple[list[Line], list[Node]]:
    parser = Lines()
    parser.feed(html)
    parser.close()
    parser._end_line()
    lines = []
    for line in parser.lines:
        line.text = " ".join("".join(line.parts).split())
        if line.text:
            lines.append(line)
    return lines, parser.nodes


def smooth(values: np.ndarray, sigma: float = 1.0) -> np.ndarray:
    """Gaussian smoothing; the ends are weighted by what there is."""
    radius = max(1, round(3 * sigma))
    kernel = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    cut = slice(radius, radius + len(values))
    return np.convolve(values, kernel)[cut] / np.convolve(np.ones(len(values)), kernel)[cut]


def threshold(values: np.ndarray) -> float:
    """The border of two clusters of values, by two means."""
    low, high = float(values.min()), float(values.max())
    for _ in range(30):
        border = (low + high) / 2
        above = values >= border
        if above.all() or not above.any():
            return low
        low, high, before = float(values[~above].mean()), float(values[above].mean()), border
        if abs((low + high) / 2 - before) < 1e-9:
            break
    return (low + high) / 2


def main_text(html: str | None, sigma: float = 1.0) -> str:
    """The article of a page; empty if there is none.

    A line's ratio is its characters outside links over its tags; lines in
    elements that never hold an article count 0, those in an element of an
    article with a marked class or id count less. Smoothed ratios fall into two
    clusters, and the lines of the higher one mark the content. The content
    region is the article they lie in, or the smallest holder of nearly all of
    their text, so that short paragraphs and headings between them stay; in it,
    every line is kept but those outside the article by their element, marked elements
    without a line in the higher cluster and, where the page names no article,
    items that are links only, unless they are in the higher cluster or follow
    a line of it in the same holder. Of several articles all that hold such lines are
    the region; one that is marked itself only if all are.
    """
    if not html:
        return ""
    lines, nodes = page_lines(html)
    inside = [line for line in lines if not line.outside]
    if not inside:
        return ""
    ratios = np.array([0 if x.outside else max(0, len(x.text) - x.linked) / max(1, x.tags) * (LOWERED if x.mark >= 0 else 1) for x in lines], float)
    smoothed = smooth(ratios, sigma)
    border = threshold(smoothed)
    seeds = [x for x, s, r in zip(lines, smoothed, ratios, strict=True) if s >= border and r > 0] or inside
    weights: dict[int, int] = {}
    total = 0
    for line in seeds:
        size = len(line.text)
        total += size
        node = line.node
        while node >= 0:
            weights[node] = weights.get(node, 0) + size
            node = nodes[node].parent
    articles = [n for n in weights if nodes[n].tag in ARTICLES and not _within_article(nodes, n)]
    articles = [n for n in articles if nodes[n].mark != n] or articles
    named = sum(weights[n] for n in articles) * 2 >= total
    if named:
        regions = articles
    else:
        holders = [n for n in weights if (nodes[n].tag in HOLDERS or n == 0) and weights[n] * 10 >= total * 9]
        regions = [max(holders)]  # nodes are numbered in page order: the last one is the innermost
    member = [False] * len(nodes)
    for n in regions:
        member[n] = True
    for n in range(1, len(nodes)):
        member[n] = member[n] or member[nodes[n].parent]
    left_out = _left_out(lines, nodes, ratios, smoothed, border, sigma)
    kept, held = [], set()  # holders that a line of the higher cluster was in so far
    for line, value, ratio in zip(lines, smoothed, ratios, strict=True):
        if line.outside or not member[line.node] or (line.mark >= 0 and line.mark not in regions and line.mark in left_out):
            continue
        if value >= border and ratio > 0:
            held.add(_holder(nodes, line.node))
        links_only = line.linked * 10 >= len(line.text) * 8 and nodes[line.node].tag in ("a", "li", "td", "div", "span")
        if named or not links_only or value >= border or _holder(nodes, line.node) in held:
            kept.append(line)
    return "\n".join(x.text for x in kept)


def _left_out(lines: list[Line], nodes: list[Node], ratios: np.ndarray, smoothed: np.ndarray, border: float, sigma: float) -> set[int]:
    """Marked elements none of whose lines is in the higher cluster.

    A heading or paragraph is weighed with the lines around it, any other
    element by its own lines, so that what is around an advert does not keep it.
    """
    own: dict[int, list[int]] = {}
    for i, line in enumerate(lines):
        if line.mark >= 0 and not line.outside:
            own.setdefault(line.mark, []).append(i)
    out = set()
    for mark, at in own.items():
        values = smoothed[at] if nodes[mark].tag in SHORT else smooth(ratios[at], sigma)
        if values.max() < border:
            out.add(mark)
    return out


def _holder(nodes: list[Node], n: int) -> int:
    """The innermost element around a line that can hold an article; a table's cells stand for the table's."""
    while n > 0 and (nodes[n].tag not in HOLDERS or nodes[n].tag == "td"):
        n = nodes[n].parent
    return n


def _within_article(nodes: list[Node], n: int) -> bool:
    n = nodes[n].parent
    while n >= 0:
        if nodes[n].tag in ARTICLES:
            return True
        n = nodes[n].parent
    return False


def extract(pages: DataFrame, sigma: float = 1.0) -> DataFrame:
    """page_id, url, text and n_chars (code points) of each page's whole html.

    Null and empty html give an empty text, as do pages without an article.
    Broken markup is read as far as it goes: open elements end with the page.
    Rows stay as they are, repeated ones too; other columns are not read.
    """
    kinds = {f.name: f.dataType.simpleString() for f in pages.schema}

    def start():
        def row(page_id, url, html):
            text = main_text(html, sigma)
            return [(page_id, url, text, len(text))]

        return row

    schema = f"page_id {kinds['page_id']}, url {kinds['url']}, text string, n_chars long"
    return map_rows(pages, ["page_id", "url", "html"], start, schema, chunk=500)
