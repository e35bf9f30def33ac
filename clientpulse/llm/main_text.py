"""Main text of web pages from parser events, by smoothed text-to-tag ratios.

The standard library's parser turns a page into lines: one per block element, with its text, the tags met in it, and
the elements it lies in. Each line's text length over its tags is smoothed by a Gaussian along the page and parted
into two clusters at a threshold. The content region is all outermost article and main elements, if they hold nearly all
text of the high cluster, or else the innermost element that does. Its lines, short ones too, are the article, except
those in parts that are never article text (menus, footers, sidebars, forms, notices, adverts, comments of readers, code)
and, before the first and after the last line of the high cluster, lines of the low one that are links or a copyright.

What is known of an element's ancestors is a flag on the element, and what it holds is added up once from the leaves, so
the work grows with the page and not with the depth of its nesting.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SIGMA = 1.0
#: Share of the high cluster's text that the content region must hold.
REGION_SHARE = 0.9
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp "
                   "small span strike strong sub sup time tt u var wbr br img".split())
#: Elements whose text is never read, and elements that are never part of the article.
SILENT = frozenset("script style noscript template title head svg math iframe object canvas audio video".split())
OUTSIDE = frozenset("nav footer aside form button select textarea menu dialog option fieldset".split())
#: Words in class, id or role that mark such parts.
OUTSIDE_WORDS = frozenset("""ad ads adv advert adverts advertisement advertising banner promo promoted promotion sponsor sponsored
nav navbar navigation menu breadcrumb breadcrumbs sidebar footer foot masthead topbar toolbar pagination pager
comment comments commentlist reviews reply replies respond discussion disqus notice notices cookie cookies consent gdpr alert popup modal
overlay newsletter subscribe subscription signup login search share sharing social related recommended widget
contentinfo complementary skip""".split())
#: An open paragraph ends where one of these begins.
ENDS_PARAGRAPH = frozenset("address article aside blockquote center details dialog dir div dl fieldset figure figcaption "
                           "footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
            "th": {"td", "th"}, "option": {"option"}}
SIBLING_HOLDERS = frozenset("ul ol menu dl table tbody thead tfoot select".split())
ARTICLE = frozenset(("article", "main"))
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Words of them that are headings of articles too: the ratio of the lines decides.
DOUBTFUL_WORDS = frozenset("discussion reviews search related share sharing social notice notices alert navigation subscription".split())
#: Words beside them in a name that do not change what it marks.
FILLERS = frozenset("""area bar block box button buttons container content form group holder inner item items left link links list
outer panel posts right section site slot top bottom google main primary reader readers secondary unit user users wrap wrapper x""".split())
#: Share of a line's text in links from which it counts as links.
LINK_SHARE = 0.5
_COPYRIGHT = re.compile(r"(?:copyright\b|\(c\)|©)", re.IGNORECASE)
#: Elements that a name never takes out.
NEVER_MARKED = frozenset(("html", "body")) | ARTICLE | HEADINGS
_WORD = re.compile(r"[a-z]+")
#: Elements that are parts of a text, never the region.
PARAGRAPHS = HEADINGS | frozenset("p ul ol dl li blockquote td th tr dt dd pre figure figcaption".split())
_CUT_MARKUP = re.compile(r"<[a-zA-Z/!?]")


def _mark(name: str) -> str | None:
    """What one class, id or role says: outside, doubtful, or nothing. All its words must say so or be fillers."""
    words = set(_WORD.findall(name))
    known = words & OUTSIDE_WORDS
    if not known or words - known - FILLERS:
        return None
    return "doubtful" if known <= DOUBTFUL_WORDS else "outside"


def _marks(attrs: list[tuple[str, str | None]]) -> set[str]:
    """What the class, id and role of an element say."""
    names = " ".join(v for k, v in attrs if k in ("class", "id", "role") and v).lower().split()
    return {mark for mark in map(_mark, names) if mark}


class _Element:
    """An open or closed block element; ``number`` counts them in the order of the page, parents first."""

    __slots__ = ("tag", "parent", "number", "outside", "silent", "in_article", "depth", "marked", "doubtful")

    def __init__(self, tag: str, parent: _Element | None, number: int, outside: bool, silent: bool,
                 marks: set[str] | frozenset[str] = frozenset()):
        self.marked, self.doubtful = "outside" in marks, "doubtful" in marks
        self.tag, self.parent, self.number, self.outside, self.silent = tag, parent, number, outside, silent
        self.depth = parent.depth + 1 if parent else 0
        self.in_article = tag in ARTICLE or bool(parent and parent.in_article)


class _Lines(HTMLParser):
    """Parser events to lines (text, tags, innermost block element)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.at = _Element("", None, 0, False, False)
        self.elements = [self.at]
        self.lines: list[tuple[str, int, _Element, float]] = []
        self._open: Counter[str] = Counter()
        self._text: list[str] = []
        self._tags = self._links = self._linked = 0
        self._muted: tuple[str, int] | None = None

    def _end_line(self) -> None:
        if self._text:
            text = " ".join("".join(self._text).split())
            if text:
                self.lines.append((text, self._tags, self.at, min(1.0, self._linked / len(text))))
            self._text.clear()
        self._tags = self._linked = 0
        self._muted = None

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self._tags += 1
        if tag in INLINE:
            self._begin_inline(tag, attrs)
            return
        self._end_line()
        self._links = 0
        if tag in ENDS_PARAGRAPH:
            self._close({"p"}, ENDS_PARAGRAPH - {"p"} | SIBLING_HOLDERS | {"li", "td", "th", "body"})
        if tag in SIBLINGS:
            self._close(SIBLINGS[tag], SIBLING_HOLDERS)
        if tag in VOID:
            return
        outside = self.at.outside or tag in OUTSIDE or (tag == "header" and not self.at.in_article)
        marks = set() if tag in NEVER_MARKED else _marks(attrs)
        self.at = _Element(tag, self.at, len(self.elements), outside, self.at.silent or tag in SILENT, marks)
        self.elements.append(self.at)
        self._open[tag] += 1
        self._tags = 1

    def _begin_inline(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag == "br":
            self._text.append(" ")
        elif tag == "a":
            self._links += 1
        if self._muted and tag == self._muted[0]:
            self._muted = tag, self._muted[1] + 1
        elif not self._muted and tag not in VOID and attrs and "outside" in _marks(attrs):
            self._muted = tag, 1

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_endtag(self, tag: str) -> None:
        self._tags += 1
        if tag == "a":
            self._links = max(0, self._links - 1)
        if tag in INLINE or tag in VOID:
            if self._muted and tag == self._muted[0]:
                self._muted = (tag, self._muted[1] - 1) if self._muted[1] > 1 else None
            return
        self._end_line()
        self._close({tag}, frozenset())

    def _close(self, tags: set[str] | frozenset[str], stop: frozenset[str] | set[str]) -> None:
        """Leave the nearest open element of ``tags``, unless one of ``stop`` or the page's root lies before it."""
        if not any(self._open[tag] for tag in tags):
            return
        element = self.at
        while element.parent and element.tag not in tags:
            if element.tag in stop:
                return
            element = element.parent
        if not element.parent:
            return
        while self.at is not element.parent:
            self._open[self.at.tag] -= 1
            self.at = self.at.parent

    def handle_data(self, data: str) -> None:
        if not self.at.silent and not self._muted:
            self._text.append(data)
            if self._links:
                self._linked += len(data)

    def close(self) -> None:
        if _CUT_MARKUP.match(self.rawdata):  # a tag or comment that the page's end cuts off is not text
            self.rawdata = ""
        super().close()
        self._end_line()


def smoothed(ratio: np.ndarray, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing along the page; at the borders the kernel is cut and weighs the rest up."""
    reach = max(1, int(np.ceil(3 * sigma)))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / sigma) ** 2)
    weight = np.convolve(np.ones(len(ratio)), kernel)[reach:reach + len(ratio)]
    return np.convolve(ratio, kernel)[reach:reach + len(ratio)] / weight


def high_cluster(values: np.ndarray) -> np.ndarray:
    """Which values lie above the threshold that parts them best into two clusters (all, if they are equal)."""
    order = np.sort(values)
    n = len(order)
    if n < 2 or order[0] == order[-1]:
        return np.ones(n, bool)
    total, left = order.sum(), np.cumsum(order)[:-1]
    count = np.arange(1, n)
    between = (left / count - (total - left) / (n - count)) ** 2 * count * (n - count)
    between[order[1:] == order[:-1]] = -1
    return values > order[int(between.argmax())]


def main_text(html: str | None, sigma: float = SIGMA) -> str:
    """The article of a page: its blocks in order, two line breaks between; empty if there is none (and for null)."""
    if not html:
        return ""
    parser = _Lines()
    parser.feed(html)
    parser.close()
    if not parser.lines:
        return ""
    parents = [e.parent.number if e.parent else -1 for e in parser.elements]
    holds = np.array([e.number for _, _, e, _ in parser.lines])
    marked = _marked(parser.elements, parents, holds)
    free = np.array([not e.outside and not marked[e.number] for _, _, e, _ in parser.lines], bool)
    if not free.any():
        return ""
    size = np.array([len(text) for text, *_ in parser.lines], np.int64)
    ratio = size / np.maximum([tags for _, tags, _, _ in parser.lines], 1)
    # Logarithms: one very long line must not be the only member of the high cluster.
    high = high_cluster(smoothed(np.log1p(ratio), sigma)) & free
    if not high.any():
        high = free
    own = np.bincount(holds[high], size[high], len(parents)).astype(np.int64).tolist()
    held = _added_up(own, parents)
    regions = _regions(parser.elements, own, held)
    inside = _inherited([e.number in regions for e in parser.elements], parents)
    doubted = _inherited([e.doubtful and not h for e, h in zip(parser.elements, held)], parents)
    chosen = [k for k, (e, f) in enumerate(zip(holds.tolist(), free)) if f and inside[e] and not doubted[e]]
    return "\n\n".join(parser.lines[k][0] for k in _trimmed(chosen, parser.lines, high))


def _trimmed(chosen: list[int], lines: list[tuple[str, int, _Element, float]], high: np.ndarray) -> list[int]:
    """Without the links and copyright lines of the low cluster that stand before or after all lines of the high one."""
    sure = [n for n, k in enumerate(chosen) if high[k]]
    first, last = (sure[0], sure[-1]) if sure else (0, len(chosen) - 1)
    return [k for n, k in enumerate(chosen) if first <= n <= last or not (
        lines[k][3] >= LINK_SHARE or _COPYRIGHT.match(lines[k][0]))]


def _added_up(own: list[int], parents: list[int]) -> list[int]:
    """Per element what it and all elements below it have."""
    total = list(own)
    for number in range(len(parents) - 1, 0, -1):
        total[parents[number]] += total[number]
    return total


def _inherited(flags: list[bool], parents: list[int]) -> list[bool]:
    """Per element whether it or an element around it has the flag."""
    out = list(flags)
    for number in range(1, len(parents)):
        out[number] = out[number] or out[parents[number]]
    return out


def _marked(elements: list[_Element], parents: list[int], holds: np.ndarray) -> list[bool]:
    """Whether names take an element out. Where every article with text lies in parts that names take out, the names of
    the articles' holders do not count."""
    marked = _inherited([e.marked for e in elements], parents)
    filled = _added_up(np.bincount(holds, minlength=len(parents)).tolist(), parents)
    articles = [e.tag in ARTICLE and n > 0 and not e.outside for e, n in zip(elements, filled)]
    if all(marked[k] for k, article in enumerate(articles) if article):
        around = _added_up([int(article) for article in articles], parents)
        marked = _inherited([e.marked and not n for e, n in zip(elements, around)], parents)
    return marked


def _regions(elements: list[_Element], own: list[int], held: list[int]) -> set[int]:
    """The outermost articles, if they hold the asked share of the content's text; else the innermost element that does.

    An element that holds nothing but its own lines is a paragraph, whatever its tag, and no region.
    """
    total = held[0]
    articles = {e.number for e, n in zip(elements, held) if n and e.tag in ARTICLE and not (e.parent and e.parent.in_article)}
    if articles and sum(held[k] for k in articles) >= REGION_SHARE * total:
        return articles
    wide = [e for e, n in zip(elements, held) if n and n >= REGION_SHARE * total and e.tag not in PARAGRAPHS
            and (own[e.number] != n or not e.parent)]
    return {max(wide, key=lambda e: e.depth).number}


def extracted(pages: DataFrame, html: str = "html", keep: list[str] | None = None) -> DataFrame:
    """(row, text): a struct of the columns ``keep`` (all by default) and the page's main text.

    A null or empty page has an empty text; repeated rows are read each; an empty table gives no rows.
    """
    names = pages.columns
    at, kept = names.index(html), [names.index(k) for k in (names if keep is None else keep)]
    packed = pages.select(F.struct("*").alias("row"))
    row = T.StructType([packed.schema["row"].dataType.fields[k] for k in kept])
    shape = T.StructType([T.StructField("row", row), T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = batch.column(0)
            texts = pa.array([main_text(value.as_py()) for value in whole.field(at)], pa.string())
            part = pa.StructArray.from_arrays([whole.field(k) for k in kept], names=row.names)
            yield pa.RecordBatch.from_arrays([part, texts], names=["row", "text"])

    return packed.mapInArrow(run, shape)
