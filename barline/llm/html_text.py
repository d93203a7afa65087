"""The main text of web pages, by text-to-tag ratios over a stream of parser events.

The standard library's parser reports tags and text as it meets them. Text between two block tags is a line; its ratio
is its length over the number of tags it took. Ratios are smoothed by a Gaussian over neighbouring lines, and lines above one
standard deviation are content: long paragraphs lift the short ones beside them, menus and captions stay low. The content
lines then select regions: the article elements that hold them, or else the innermost element that holds nearly all of them.
A region is kept whole, so a short paragraph between long ones is not lost.

What markup names as something other than the article never becomes a line: menus, page headers, footers, asides, forms, scripts,
styles, hidden elements, and elements whose class or id names an advert, a notice, a sidebar or readers' comments.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from barline.llm.text import text_udf

# Lines' worth of the Gaussian, and standard deviations of the smoothed ratios that content lines exceed.
SIGMA = 1.0
DEVIATIONS = 1.0
# Share of the content that the innermost element of a page without articles must hold.
MOST = 0.9
# Articles below this share of the content are teasers; further articles count from this share of the longest on.
SOME = 0.25
# Lines of a page without articles are menus if links make up this share of them.
LINKED = 0.5
# Paragraphs of this length, and as many, are an article whatever the class of their element says.
LONG_LINE, LONG_LINES = 80, 3

# Names of HTML elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rb rp rt ruby s samp small "
    "span strike strong sub sup time tt u var".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
NEVER = frozenset(
    "head title script style noscript template svg iframe object canvas audio video nav footer aside form fieldset button "
    "select option textarea datalist dialog menu".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog menu menubar form".split())
# Words of a class or id that name something other than the article.
NOT_ARTICLE = frozenset(
    """ad ads advert adverts advertisement advertisements advertising sponsor sponsored sponsors promo promotion promotions banner
    cookie cookies consent gdpr notice notices notification notifications disclaimer newsletter subscribe subscription signup login
    popup modal overlay sidebar aside menu nav navbar navigation breadcrumb breadcrumbs pagination pager toolbar footer masthead
    comment comments reply replies respond disqus discussion share sharing social related recommended recommendations
    trending taboola outbrain widget widgets copyright""".split()
)
# Elements whose start ends an open one of the same row, unless an element of the last set lies between.
_ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}}
_HOLDS = frozenset("ul ol dl table".split())
# Elements whose inside leaves a paragraph around them open.
_OVER_P = frozenset("article aside blockquote body div li main section table td th".split())

_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)

# How a line is treated: kept, kept if a heading, left out by name, left out by kind.
KEPT, TITLES, NAMED, GONE = range(4)


@dataclass
class Line:
    """A run of text between block tags."""

    text: str
    tags: int
    linked: int
    element: int
    named: bool


def _names(attributes: dict[str, str | None]) -> set[str]:
    """Words of class and id; those after ``has``, ``no`` or ``with`` speak of the page, not of the element."""
    words: set[str] = set()
    for value in f"{attributes.get('class') or ''} {attributes.get('id') or ''}".split():
        parts = [w.lower() for w in _WORD.findall(value)]
        words.update(w for before, w in zip(["", *parts], parts) if before not in ("has", "no", "with", "without"))
    return words


class LineReader(HTMLParser):
    """Lines and elements of a page from parser events."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[Line] = []
        # Of each element in order of opening: its parent, name, and treatment. The first is the page.
        self.parent, self.name, self.treated = [-1], ["page"], [KEPT]
        self._open: list[int] = [0]
        self._names: Counter[str] = Counter()
        self._pieces: list[str] = []
        self._tags = self._linked = self._links = self._headings = 0

    def _treatment(self, tag: str, attributes: dict[str, str | None]) -> int:
        above = self.treated[self._open[-1]]
        style = attributes.get("style") or ""
        hidden = "hidden" in attributes or attributes.get("aria-hidden") == "true" or _HIDDEN.search(style)
        if hidden or tag in NEVER or (attributes.get("role") or "").lower() in ROLES:
            return GONE
        in_article = bool(self._names["article"] or self._names["main"])
        if tag == "header":
            return max(above, TITLES if in_article else GONE)
        if tag in ("html", "body", "main"):
            return above
        names = _names(attributes)
        if names & NOT_ARTICLE:
            return max(above, NAMED)
        if "header" in names:
            return max(above, TITLES if in_article else NAMED)
        return above

    def _end_line(self) -> None:
        text = " ".join("".join(self._pieces).split())
        if text:
            element = next(e for e in reversed(self._open) if self.name[e] not in INLINE)
            named = self.treated[element] == NAMED or (self.treated[element] == TITLES and not self._headings)
            self.lines.append(Line(text, self._tags, self._linked, element, named))
            self._tags = 0
        self._pieces, self._linked = [], 0

    def _close(self, depth: int) -> None:
        for element in self._open[depth:]:
            name = self.name[element]
            self._names[name] -= 1
            self._headings -= name in HEADINGS
        del self._open[depth:]

    def _close_last(self, names: set[str], unless: frozenset[str] = frozenset()) -> None:
        """End the innermost open element of ``names`` that no element of ``unless`` hides."""
        if not any(self._names[n] for n in names):
            return
        for depth in range(len(self._open) - 1, 0, -1):
            name = self.name[self._open[depth]]
            if name in names:
                return self._close(depth)
            if name in unless:
                return

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self._tags += self.treated[self._open[-1]] != GONE
        if tag == "br":
            self._pieces.append(" ")
        self._links += tag == "a"
        if tag in VOID:
            return
        attributes = dict(attrs)
        if tag in INLINE:
            above = self.treated[self._open[-1]]
            # Within a line a name says little: links to comments or related pages are part of their sentence.
            treatment = GONE if attributes and self._treatment(tag, attributes) == GONE else above
            if treatment == above:
                return
        else:
            self._end_line()
            self._close_last({"p"}, _OVER_P)
            if tag in _ENDS:
                self._close_last(_ENDS[tag], _HOLDS)
            if tag == "body":
                self._close_last({"head"})
            treatment = max(self.treated[self._open[-1]], self._treatment(tag, attributes))
        self.parent.append(self._open[-1])
        self.name.append(tag)
        self.treated.append(treatment)
        self._open.append(len(self.name) - 1)
        self._names[tag] += 1
        self._headings += tag in HEADINGS

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        # A slash does not end an element in HTML, but it is written to end those without text.
        if tag not in NEVER:
            self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        self._tags += self.treated[self._open[-1]] != GONE
        self._links = max(0, self._links - (tag == "a"))
        if tag in INLINE:
            # Only inline elements that hide their text are open.
            depth = len(self._open) - 1
            while depth and self.name[self._open[depth]] in INLINE:
                if self.name[self._open[depth]] == tag:
                    return self._close(depth)
                depth -= 1
            return
        self._end_line()
        if tag not in VOID and self._names[tag]:
            self._close_last({tag})

    def handle_data(self, data: str) -> None:
        if self.treated[self._open[-1]] == GONE:
            return
        self._pieces.append(data)
        if self._links:
            self._linked += len(data)

    def _whole(self, end: int) -> int:
        """Markup that the page does not end reaches to its end, as in browsers; the parser would try it again at each ``<``."""
        return len(self.rawdata) if end < 0 else end

    def parse_starttag(self, i: int) -> int:
        return self._whole(super().parse_starttag(i))

    def parse_endtag(self, i: int) -> int:
        return self._whole(super().parse_endtag(i))

    def parse_comment(self, i: int, report: bool = True) -> int:
        return self._whole(super().parse_comment(i, report))

    def parse_pi(self, i: int) -> int:
        return self._whole(super().parse_pi(i))

    def parse_html_declaration(self, i: int) -> int:
        # A marked section is a comment to HTML; the parser refuses those it does not know.
        section = self.rawdata.startswith("<![", i)
        return self._whole(self.parse_bogus_comment(i) if section else super().parse_html_declaration(i))

    def read(self, page: str) -> list[Line]:
        self.feed(page)
        self.close()
        self._end_line()
        return self.lines


def smoothed(ratios: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian mean of neighbouring ratios; the ends take the weights that remain."""
    reach = max(1, round(3 * sigma))
    weights = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    sums = np.convolve(ratios, weights)[reach : reach + len(ratios)]
    return sums / np.convolve(np.ones(len(ratios)), weights)[reach : reach + len(ratios)]


def content_lines(lines: list[Line]) -> np.ndarray:
    """Whether the smoothed text-to-tag ratio of each line is above the threshold of the page."""
    ratios = np.array([len(line.text) / max(1, line.tags) for line in lines])
    smooth = smoothed(ratios)
    threshold = min(DEVIATIONS * smooth.std(), smooth.max() * (1 - 1e-9))
    return smooth > threshold


def _regions(reader: LineReader, lines: list[Line], content: np.ndarray) -> tuple[list[int], bool]:
    """Elements whose lines are the main text, and whether the page names them."""
    n = len(reader.parent)
    mass, held = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for line, good in zip(lines, content):
        held[line.element] += len(line.text)
        mass[line.element] += len(line.text) if good else 0
    for element in range(n - 1, 0, -1):
        mass[reader.parent[element]] += mass[element]
        held[reader.parent[element]] += held[element]
    for name in ("article", "main"):
        inside = [False] * n
        outer = []
        for element in range(1, n):
            inside[element] = inside[reader.parent[element]] or reader.name[element] == name
            if reader.name[element] == name and not inside[reader.parent[element]] and held[element]:
                outer.append(element)
        longest = max((held[e] for e in outer), default=0)
        chosen = [e for e in outer if held[e] >= SOME * longest]
        if chosen and held[chosen].sum() >= SOME * mass[0]:
            return chosen, True
    region = 0
    for element in range(1, n):
        if reader.parent[element] == region and mass[element] >= MOST * mass[0]:
            region = element
    return [region], False


def blocks(page: str | None) -> list[str]:
    """Blocks of a page's main text, in page order."""
    reader = LineReader()
    every = reader.read(page or "")
    lines = [line for line in every if not line.named]
    if sum(len(line.text) >= LONG_LINE for line in every if line.named) >= LONG_LINES and not any(
        len(line.text) >= LONG_LINE for line in lines
    ):
        lines = every
    if not lines:
        return []
    content = content_lines(lines)
    regions, by_name = _regions(reader, lines, content)
    within = [False] * len(reader.parent)
    for element in range(len(within)):
        within[element] = element in regions or (element > 0 and within[reader.parent[element]])
    inside = [i for i, line in enumerate(lines) if within[line.element]]
    if not by_name:
        inside = [i for i in inside if content[i] or lines[i].linked < LINKED * len(lines[i].text)]
    return [lines[i].text for i in inside]


def main_text(pages: DataFrame, html: str = "html", into: str = "content") -> DataFrame:
    """``pages`` with a struct of ``text`` and its length ``n_chars`` in code points; no shuffle.

    The text is that of the main regions, blocks joined by an empty line. Null and empty pages, and pages
    without any, have an empty text. Rows keep their other columns and their number, so repeated rows get equal texts; a column
    named as ``into`` is replaced.
    """

    def setup() -> Callable[[str | None], tuple]:
        def each(page: str | None) -> tuple:
            text = "\n\n".join(blocks(page))
            return text, len(text)

        return each

    return pages.withColumn(into, text_udf("text string, n_chars long", setup)(F.col(html)))
