"""Main text of web pages: parser events, text-to-tag ratios, content regions.

A page is fed in pieces to the standard library's parser.  Its events become lines,
one per block of the page.  A line's ratio is its characters outside links over its
tags, and nothing where the page itself says it is no content (navigation, forms,
adverts, comments, ...).  Ratios are smoothed with a Gaussian along the page, the
best split in two clusters gives a threshold, and lines above it are content.  The
element that holds the content lines is the region; all of its lines are kept, so
that a headline or a paragraph of one word is not lost between long ones.

Cases: a null or empty page has an empty text, never null; so has a page without
text outside its menus and the like.  Pages may repeat and may be of any length.
Markup may be cut short, unclosed or crossed; bytes that are not UTF-8 become U+FFFD.
Columns of the input stay, but for those named like a result column.
"""

from __future__ import annotations

import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from fileload.llm.text import map_texts

#: Characters fed to the parser at a time.
PIECE = 1 << 16
#: Lines on each side that a smoothed ratio looks at, and the Gaussian's width.
RADIUS, SIGMA = 2, 1.0

_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th "
    "thead tr ul".split()
)
#: Elements that are never part of an article.
_NEVER = frozenset(
    "aside audio button canvas datalist dialog embed fieldset footer form head iframe input label menu nav noscript object "
    "option script search select style svg template textarea title video".split()
)
#: A new one of these ends an open one of the same list.
_SIBLINGS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table")}
_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search tablist toolbar".split())
#: Words of class names and ids that tell of something else than the article.
_WORDS = frozenset(
    "ad ads adbox adsbygoogle adslot adv advert advertisement advertisements adverts advertising affiliate aside banner "
    "breadcrumb breadcrumbs captcha comment commentlist commentform comments consent cookie cookies copyright discussion "
    "disqus dropdown feedback flyout follow footer form gdpr header hidden legal login masthead menu menubar menus modal nav "
    "navbar navigation newsletter noprint notice notices notification notifications outbrain overlay pager pagination "
    "paywall popup privacy promo promoted promotion ratings recommendations recommended related replies reply respond "
    "responses rail search share sharing sidebar sidebars signin signup skip skyscraper social sponsor sponsored sponsors "
    "subscribe subscription taboola toolbar topbar tracking trending warning widget widgets".split()
)
#: Words that name the article itself: with them, a header is its heading.
_OWN = frozenset("article content entry page post story".split())
#: A class such as has-sidebar speaks of the page, not of the element.
_HAS = frozenset("has is no not with without show".split())
_PARTS = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]*")
_NONE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


def _names(attrs: dict) -> list[list[str]]:
    """Class names and id, each as its lower-case words."""
    given = f"{attrs.get('class') or ''} {attrs.get('id') or ''}".split()
    return [[word.lower() for word in _PARTS.findall(name)] for name in given]


class _Page(HTMLParser):
    """Lines of a page and the tree of elements they are in."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        # Open elements: tag, node, whether skipped, whether a link.
        self.open = [("", 0, False, False)]
        self.count: dict[str, int] = {}
        # For each node its parent and what kind it is.
        self.parent, self.kind = [-1], [""]
        self.texts: list[str] = []
        self.node: list[int] = []
        self.chars: list[int] = []
        self.linked: list[int] = []
        self.ratio: list[float] = []
        self.head: list[bool] = []
        self._line: list[str] = []
        self._at, self._shown, self._in_links, self._tags = 0, False, 0, 0

    def flush(self) -> None:
        """End a line; one without text of its own still parts its neighbours."""
        text = " ".join("".join(self._line).split())
        if text or self._tags:
            node = self._at if self._shown else self.open[-1][1]
            outside = len(text) - min(self._in_links, len(text))
            self.texts.append(text)
            self.node.append(node)
            self.chars.append(len(text))
            self.linked.append(len(text) - outside)
            self.ratio.append(outside / max(1, self._tags))
            self.head.append(self.kind[node] == "h1")
        self._line, self._shown, self._in_links, self._tags = [], False, 0, 0

    def _skips(self, tag: str, attrs: dict) -> bool:
        inside = self.count.get("article") or self.count.get("main")
        if tag in _NEVER or tag == "header" and not inside:
            return True
        if not attrs:
            return False
        if "hidden" in attrs or attrs.get("aria-hidden") == "true" or attrs.get("role") in _ROLES:
            return True
        if attrs.get("style") and _NONE.search(attrs["style"]):
            return True
        if tag in ("html", "body", "main"):
            return False
        for words in _names(attrs):
            found = _WORDS.intersection(words)
            if found <= {"header", "widget"} and (inside or _OWN.intersection(words)):
                continue
            if found and not _HAS.intersection(words[:1]):
                return True
        return False

    def _pop_to(self, at: int) -> None:
        while len(self.open) > at:
            tag = self.open.pop()[0]
            self.count[tag] -= 1

    def _close_open(self, tag: str, fences: tuple[str, ...] | frozenset[str]) -> None:
        """End the innermost open ``tag`` unless a fence is between."""
        if self.count.get(tag):
            for at in range(len(self.open) - 1, 0, -1):
                if self.open[at][0] == tag:
                    return self._pop_to(at)
                if self.open[at][0] in fences:
                    return

    def handle_starttag(self, tag, attrs):
        attrs = dict(attrs) if attrs else {}
        block = tag in _BLOCKS
        if block:
            self.flush()
            self._close_open("p", _BLOCKS)
            if tag in _SIBLINGS:
                for same in ("dt", "dd") if tag in ("dt", "dd") else ("td", "th") if tag in ("td", "th") else (tag,):
                    self._close_open(same, _SIBLINGS[tag])
        elif tag == "br":
            self._line.append(" ")
        self._tags += 1
        if tag in _VOID:
            return
        _, node, skipped, link = self.open[-1]
        skipped = skipped or self._skips(tag, attrs)
        if block:
            self.parent.append(node)
            own = attrs.get("role") == "main" or "articleBody" in (attrs.get("itemprop") or "")
            self.kind.append("article" if own else tag)
            node = len(self.parent) - 1
        self.open.append((tag, node, skipped, link or tag == "a"))
        self.count[tag] = self.count.get(tag, 0) + 1

    def handle_endtag(self, tag):
        if tag in _BLOCKS:
            self.flush()
        self._tags += 1
        if self.count.get(tag):
            for at in range(len(self.open) - 1, 0, -1):
                if self.open[at][0] == tag:
                    return self._pop_to(at)

    def handle_startendtag(self, tag, attrs):
        # A slash closes nothing in HTML: <div/> opens, <br/> is void.
        self.handle_starttag(tag, attrs)

    def handle_data(self, data):
        _, node, skipped, link = self.open[-1]
        if skipped:
            return
        if not self._shown and data.strip():
            self._at, self._shown = node, True
        self._line.append(data)
        if link:
            self._in_links += len(" ".join(data.split()))

    def updatepos(self, i, j):
        # Nobody asks for line numbers.
        return j

    def parse_marked_section(self, i, report=1):
        # The library stops on keywords it does not know; a browser sees a comment.
        end = self.rawdata.find(">", i + 3)
        return -1 if end < 0 else end + 1


def _smooth(ratio: np.ndarray) -> np.ndarray:
    """Gaussian means along the page; beyond its ends there is nothing to weigh."""
    n, total, weight = len(ratio), np.zeros(len(ratio)), np.zeros(len(ratio))
    for k in range(-RADIUS, RADIUS + 1):
        here = slice(max(0, -k), max(0, min(n, n - k)))
        share = np.exp(-0.5 * (k / SIGMA) ** 2)
        total[here] += share * ratio[max(0, k) : max(0, min(n, n + k))]
        weight[here] += share
    return total / weight


def _threshold(values: np.ndarray) -> float:
    """Least value of the upper of the two clusters that part the values best."""
    ordered = np.sort(values)
    n = len(ordered)
    if n < 2 or ordered[0] == ordered[-1]:
        return float(ordered[0])
    low = np.cumsum(ordered)[:-1]
    size = np.arange(1, n)
    between = (low / size - (ordered.sum() - low) / (n - size)) ** 2 * size * (n - size)
    between[ordered[1:] == ordered[:-1]] = -1
    return float(ordered[int(np.argmax(between)) + 1])


def main_blocks(html: str) -> list[str]:
    """Texts of the blocks of a page's article, in page order."""
    page = _Page()
    # A comment or tag that never ends takes in the rest.
    unended = html.find("<!--", html.rfind("-->") + 1)
    html = html[:unended] if unended >= 0 else html
    cut = re.compile("<[a-zA-Z/!?]").search(html, html.rfind(">") + 1)
    html = html[: cut.start()] if cut else html
    for at in range(0, len(html), PIECE):
        page.feed(html[at : at + PIECE])
    page.close()
    page.flush()
    chars = np.array(page.chars, np.int64)
    texted = np.flatnonzero(chars)
    if not len(texted):
        return []
    node = np.array(page.node)
    smooth = _smooth(np.array(page.ratio))
    content = texted[smooth[texted] >= _threshold(smooth[texted])]
    region = _region(page, node, chars, content)
    # Nodes are numbered in page order, parents first.
    inside = np.zeros(len(page.parent), bool)
    inside[region] = True
    for n in range(region + 1, len(page.parent)):
        inside[n] = inside[page.parent[n]]
    keep = inside[node] & (chars > 0) & ~_link_lists(page, node, chars)
    if not keep[texted].any():
        return []
    first = int(np.flatnonzero(keep)[0])
    above = [i for i in texted[texted < first].tolist() if page.head[i] and page.parent[node[i]] == page.parent[region]]
    return [page.texts[i] for i in [*above[-1:], *np.flatnonzero(keep).tolist()]]


def _region(page: _Page, node: np.ndarray, chars: np.ndarray, content: np.ndarray) -> int:
    """The element that holds the content lines: an article where the page names
    one that holds most of them, else the least element that holds them all."""
    mass = np.zeros(len(page.parent), np.int64)
    np.add.at(mass, node[content], chars[content])
    for n in range(len(page.parent) - 1, 0, -1):
        mass[page.parent[n]] += mass[n]
    named = [n for n, kind in enumerate(page.kind) if kind in ("article", "main") and 2 * mass[n] > mass[0]]
    if named:
        outer = named[0]
        return [n for n in named if 10 * mass[n] >= 9 * mass[outer]][-1]
    region = 0
    for n in range(1, len(page.parent)):
        if page.parent[n] == region and mass[n] == mass[0]:
            region = n
    # A paragraph or heading alone is part of something larger.
    return page.parent[region] if region and page.kind[region] in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "li") else region


def _link_lists(page: _Page, node: np.ndarray, chars: np.ndarray) -> np.ndarray:
    """Lines of lists that are nothing but links: menus without a name."""
    linked = np.array(page.linked)
    parent = np.array(page.parent)[node]
    item = np.array([page.kind[n] == "li" for n in node.tolist()])
    lists, place = np.unique(parent, return_inverse=True)
    items = np.bincount(place, weights=item & (chars > 0), minlength=len(lists))
    links = np.bincount(place, weights=item & (chars > 0) & (linked >= chars), minlength=len(lists))
    return item & ((items >= 3) & (links == items))[place]


_FIELDS = StructType(
    [StructField("blocks", ArrayType(StringType())), StructField("text", StringType()), StructField("n_chars", LongType())]
)


def extract_text(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` without ``html_col`` and with ``blocks``, the texts of the article's
    blocks, ``text``, the blocks joined by one space, and its ``n_chars``."""

    def run(htmls):
        raw = htmls.cast(pa.binary()).to_pylist()
        blocks = [main_blocks(html.decode("utf-8", "replace")) if html else [] for html in raw]
        texts = [" ".join(b) for b in blocks]
        return [
            pa.array(blocks, pa.list_(pa.string())),
            pa.array(texts, pa.string()),
            pa.array([len(t) for t in texts], pa.int64()),
        ]

    return map_texts(pages, html_col, _FIELDS, run, keep_text=False)
