"""Main text of web pages from the events of the standard library's streaming
HTML parser.

The events give one line for each block of a page: its text, how many tags it
has, how much of it is link text, and the container it stands in. Menus, page
headers and footers, sidebars, notices, adverts, forms, scripts, styles and
reader comments are left out as their elements open (by element, role, class
or id). The text-to-tag ratios of the other lines are smoothed by a Gaussian,
lines over a threshold, themselves too, form the content clusters, and the
containers that hold a cluster are the content regions; a region's lines are
all kept, so a short paragraph between long ones stays. A line's container is
the innermost article or main it stands in, or else the nearest other one; an
article is no content by itself. What only a class or id marks as left out (it
may name the layout of the whole page) a main or an outermost article inside
opens again.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import map_arrow, slices

SLICE_BYTES = 8 << 20
SIGMA = 1.0  # of the smoothing, in lines
THRESHOLD = 0.5  # of the standard deviation of the page's smoothed ratios
SPARED = 4
WRAPPERS = 8  # elements of such names, one in the other around the text, that are tried
MAX_LINK_SHARE = 0.5  # of a content line's characters outside an article

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre "
    "search section summary table tbody tfoot thead tr ul".split()
)
_OUT = frozenset(
    "aside button canvas datalist dialog footer form head iframe map menu nav noframes noscript object script search "
    "select style svg template textarea title video audio".split()
)
_REGION = frozenset("article main".split())
_CONTAINER = _BLOCK - frozenset("p h1 h2 h3 h4 h5 h6 li dt dd tr pre blockquote ul ol dl hr figcaption hgroup caption tbody thead tfoot summary address".split())
#: An element that opens closes an open one of these, up to the nearest of the others.
_CLOSES = {
    "li": ("li", frozenset("ul ol menu dir".split())),
    "dt": ("dt dd", frozenset(["dl"])),
    "dd": ("dt dd", frozenset(["dl"])),
    "tr": ("tr td th", frozenset(["table"])),
    "td": ("td th", frozenset(["tr", "table"])),
    "th": ("td th", frozenset(["tr", "table"])),
    "option": ("option", frozenset(["select", "datalist"])),
}
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar".split())
#: Parts of class names and ids (cut at all but letters) of what is no article.
_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion promoted "
    "sidebar sidenav nav navbar navigation menu breadcrumb breadcrumbs footer masthead toolbar topbar "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe signup "
    "login comment comments commentlist disqus reply replies respond share sharing social related recommended "
    "pagination pager widget widgets skip aside announcement disclaimer toast copyright outbrain taboola".split()
)
#: Those under which an article is a reader's comment.
_COMMENTS = frozenset("comment comments commentlist disqus reply replies respond".split())
#: Those of what is laid over a page; it is never spared.
_LAID_OVER = frozenset("cookie cookies consent gdpr popup modal overlay newsletter subscribe signup login alert toast".split())
#: How much an element is left out: by its name, by that of comments, by what it is.
_BY_NAME, _BY_COMMENT, _BY_KIND = 1, 2, 3
#: Name parts that only make an element boilerplate when two of them meet.
_PAIRS = (("side", "bar"), ("side", "column"), ("side", "menu"))
#: With these a header, outside an article too, is that of the text, and an outermost article is no boilerplate.
_OF_TEXT = frozenset("article entry post story content section".split())
_WORD = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")
_OPENS = re.compile(r"<[a-zA-Z/!?]")


class Lines(HTMLParser):
    """The lines of a page: ``text, tags, link characters, region, container,
    in a list, in a heading h1``. Elements with a number in ``spared`` are not left
    out for their name. ``where`` has the places in the stack of each open
    element, so no step walks the stack but to close what it pops."""

    def __init__(self, spared: frozenset[int] = frozenset()):
        super().__init__(convert_charrefs=True)
        self.lines: list[tuple[str, int, int, int, int, bool, bool]] = []
        self.stack: list[tuple[str, int, int, int, bool]] = []  # element, out, region, container, link
        self.where: defaultdict[str, list[int]] = defaultdict(list)
        self.parents = {0: 0}  # of the containers
        self.sections: set[int] = set()
        self.spared = spared
        self.left: defaultdict[int, int] = defaultdict(int)  # characters, not of links, in elements that may be spared
        self.leaving: list[int] = []  # such elements that are open
        self.n = 0
        self.parts: list[str] = []
        self.tags = self.linked = 0
        self.at = (0, 0, False, False)

    def _end_line(self) -> None:
        text = _SPACE.sub(" ", "".join(self.parts)).strip()
        if text:
            self.lines.append((text, max(1, self.tags), self.linked, *self.at))
        self.parts, self.tags, self.linked = [], 0, 0

    def _last(self, tags) -> int:
        """Place of the innermost open element of these, or -1."""
        return max((self.where[t][-1] for t in tags if self.where[t]), default=-1)

    def _pop_to(self, i: int) -> None:
        if any(x[0] in _BLOCK for x in self.stack[i:]):
            self._end_line()
        for tag, *_ in self.stack[i:]:
            self.where[tag].pop()
        for mark in ("#container", "#kind", "#left"):
            places = self.where[mark]
            while places and places[-1] >= i:
                places.pop()
                if mark == "#left":
                    self.leaving.pop()
        del self.stack[i:]

    def _is_out(self, tag: str, attrs: list[tuple[str, str | None]], inside: int) -> int:
        """0, or how much the element is left out."""
        if tag in _OUT or tag == "header" and not inside:
            return _BY_KIND
        a = dict(attrs)
        if "hidden" in a or a.get("aria-hidden") == "true" or "display:none" in (a.get("style") or "").replace(" ", ""):
            return _BY_KIND
        if (a.get("role") or "").lower() in _ROLES:
            return _BY_KIND
        if tag in ("body", "html", "main"):
            return 0
        out = 0
        for key in ("class", "id"):
            if value := a.get(key):
                names = _WORD.findall(value.lower())
                if tag == "article" and not inside and not _OF_TEXT.isdisjoint(names):
                    return 0
                if not _COMMENTS.isdisjoint(names):
                    out = _BY_COMMENT
                elif not _NAMES.isdisjoint(names) or any(x in names and y in names for x, y in _PAIRS):
                    out = max(out, _BY_NAME)
                elif "header" in names and not inside and _OF_TEXT.isdisjoint(names):
                    out = max(out, _BY_NAME)
        return out

    def handle_starttag(self, tag: str, attrs) -> None:
        self.tags += 1
        if tag == "br" or tag in ("td", "th"):
            self.parts.append(" ")
        if tag in _VOID:
            if tag == "hr":
                self._end_line()
            return
        stack = self.stack
        if tag in _REGION and self.where["#kind"]:  # a page in a form, or a menu that was never closed
            i = self.where["#kind"][0]
            if stack[i][0] in ("nav", "header", "form", "head"):
                self._pop_to(i)
        if tag in _CLOSES:
            closed, stop = _CLOSES[tag]
            i = self._last(closed.split())
            if i > self._last(stop):
                self._pop_to(i)
        if tag in _BLOCK:
            self._end_line()
            i = self._last(["p"])
            if i > self._last(["#container"]):
                self._pop_to(i)
            self.tags = 1
        _, out, region, container, link = stack[-1] if stack else ("", 0, 0, 0, False)
        self.n += 1
        own = self._is_out(tag, attrs, region)
        may = own == _BY_NAME or own == _BY_KIND and tag == "form"
        if may:
            names = _WORD.findall(" ".join(v.lower() for k, v in attrs if k in ("class", "id") and v))
            may = _LAID_OVER.isdisjoint(names)
        if may and self.n in self.spared:
            own = 0
        elif may and not out:
            self.where["#left"].append(len(stack))
            self.leaving.append(self.n)
        opens = tag == "main" and out < _BY_KIND or tag == "article" and not region and out < _BY_COMMENT
        before, out = out, own if opens else max(out, own)
        if out == _BY_KIND and before != _BY_KIND:
            self.where["#kind"].append(len(stack))
        if tag in _REGION:
            region = self.n
        if tag in _CONTAINER:
            self.parents[self.n] = container
            container = self.n
            if tag == "section":
                self.sections.add(self.n)
        if tag in _CONTAINER or tag in ("td", "th"):
            self.where["#container"].append(len(stack))
        self.where[tag].append(len(stack))
        stack.append((tag, out, region, container, link or tag == "a"))

    def handle_startendtag(self, tag: str, attrs) -> None:
        if tag in _VOID:
            self.handle_starttag(tag, attrs)
        else:  # the slash means nothing in HTML
            self.handle_starttag(tag, attrs)
            if tag in self.CDATA_CONTENT_ELEMENTS:
                self.set_cdata_mode(tag)

    def handle_endtag(self, tag: str) -> None:
        self.tags += 1
        i = self._last([tag])
        if i >= 0 and (tag in ("body", "html") or i >= self._last(_REGION)):
            self._pop_to(i)

    def handle_data(self, data: str) -> None:
        _, out, region, container, link = self.stack[-1] if self.stack else ("", 0, 0, 0, False)
        if out:
            if self.leaving and not link and self._plain(out):
                self.left[self.leaving[0]] += len(data.strip())
            return
        self.parts.append(data)
        listed = self._last(["li"]) > self._last(["#container"])
        self.at = region, container, listed, bool(self.where["h1"])
        if link:
            self.linked += len(data)

    def _plain(self, out: int) -> bool:
        """Whether text is left out only for elements that may be spared."""
        return out == _BY_NAME or out == _BY_KIND and self.where["#kind"][0] == self.where["#left"][0]

    def finish(self) -> list[tuple[str, int, int, int, int, bool, bool]]:
        self.close()
        self._end_line()
        return self.lines


def smoothed(x: np.ndarray, sigma: float) -> np.ndarray:
    """``x`` under a Gaussian of ``sigma`` entries, ends repeated."""
    r = max(1, int(np.ceil(3 * sigma)))
    kernel = np.exp(-0.5 * (np.arange(-r, r + 1) / sigma) ** 2)
    return np.convolve(np.pad(x, r, mode="edge"), kernel / kernel.sum(), mode="valid")


def content(lines: list[tuple[str, int, int, int, int, bool, bool]], parents: dict[int, int], sections: set[int]) -> list[str]:
    """The texts of the content regions' lines, in page order."""
    few_links = lambda x: x[2] <= MAX_LINK_SHARE * len(x[0])
    tried = [x for x in lines if x[3] or few_links(x)]
    if not tried:
        return []
    own = np.array([len(x[0]) / x[1] for x in tried])
    dense = np.array([few_links(x) for x in tried])
    if not dense.any():
        dense[:] = True
    ratio = smoothed(own, SIGMA)
    least = min(THRESHOLD * ratio.std(), np.minimum(ratio, own)[dense].max())
    cluster = dense & (ratio >= least) & (own >= least)  # a short line beside a long one is no cluster
    chosen = [x for x, c in zip(tried, cluster, strict=True) if c]
    regions = {x[3] for x in chosen if x[3]}
    wanted = {x[4] for x in chosen if not x[3]}
    if not any(x[3] for x in lines):
        wanted |= {x[4] for x in [x for x in lines if x[6]][:1]}
    inside = set()
    if wanted:
        top = _ancestor(wanted, parents)
        while top in sections:  # a section has others beside it
            top = parents[top]
        inside = _below(top, parents)
    return [x[0] for x in lines if (x[3] in regions if x[3] else x[4] in inside and (few_links(x) or x[4] in wanted and not x[5]))]


def _ancestor(some: set[int], parents: dict[int, int]) -> int:
    """The nearest container that holds all of these (numbers grow inwards)."""
    left, known = [-n for n in some], set(some)
    heapify(left)
    while len(left) > 1:
        parent = parents[-heappop(left)]
        if parent not in known:
            known.add(parent)
            heappush(left, -parent)
    return -left[0]


def _below(top: int, parents: dict[int, int]) -> set[int]:
    """The container and all in it."""
    out = {top}
    for n, parent in parents.items():  # a container comes after its parent
        if parent in out and n > top:
            out.add(n)
    return out


def _parsed(html: str, spared: frozenset[int]) -> Lines:
    parser = Lines(spared)
    unfinished = _OPENS.search(html, html.rfind(">") + 1)
    parser.feed(html[: unfinished.start()] if unfinished else html)
    parser.finish()
    return parser


def extract(html: str) -> str:
    """Main text of one page; an unfinished tag at its end is no text."""
    parser = _parsed(html, frozenset())
    text = "\n".join(content(parser.lines, parser.parents, parser.sections))
    for _ in range(WRAPPERS):
        if not parser.left:
            break
        n, most = max(parser.left.items(), key=lambda x: x[1])
        if most <= SPARED * len(text) or any(x[3] for x in parser.lines):
            break
        parser = _parsed(html, parser.spared | {n})
        text = "\n".join(content(parser.lines, parser.parents, parser.sections))
    return text


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "html", SLICE_BYTES):
        found = [extract(x or "") for x in batch.column("html").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(found, pa.string()), pa.array(list(map(len, found)), pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def main_text(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``page_id, url, text, n_chars`` for each row of ``pages``.

    Character references are decoded, white space inside a block becomes one
    space, blocks are trimmed and joined by one line break. Null and empty
    pages, and pages without content, have the text ``''``; rows that repeat
    are read each on its own.
    """
    inp = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    kinds = [f"{c} {inp.schema[c].dataType.simpleString()}" for c in ("page_id", "url")]
    return map_arrow(inp, _extract, f"{', '.join(kinds)}, text string, n_chars bigint")
