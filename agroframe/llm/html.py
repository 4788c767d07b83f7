"""Main text of web pages by text-to-tag ratios.

The standard-library parser streams a page's events into *lines*: runs of text
between block borders, each with its number of tags and its place in the open
elements.  A line's ratio is its characters per tag.  The ratios are smoothed
along the page with a Gaussian and split into two clusters by a threshold;
the lines above it are *hot*.  Where the page names articles, its content is all
of them but lists of links without a hot line.  Elsewhere a region is found around the hot lines,
from the body down to the smallest element that still holds nearly all hot text.
Inside and beside the region every line is kept, so short paragraphs, sections and headings are
not lost, except links: a list of them goes, unless its branch holds hot text.  Elements
that are something else by tag, role or style (menus, forms, page footers, ...) never give lines.
Those that call themselves so by class or id give none either.  Blocks that are no content at any size
(comments, ads, notices, sidebars, newsletters, ...) stay closed; names that also serve layout (share, social, banner) are
opened where the element holds an article or the page's densest text, and those of
page parts (widget, promo, ...) where nothing else is left: then the page is read again with them open.
All steps are linear in the page, however deep its elements nest.
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

from agroframe.llm.common import small_batches

INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt "
                   "ruby s samp small span strike strong sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = frozenset("head script style noscript template nav footer aside form button select textarea iframe object "
                    "svg canvas audio video menu dialog datalist title".split())
ROLES = frozenset("navigation banner contentinfo complementary search alert alertdialog dialog form menu menubar "
                  "toolbar".split())
COMMENTS = frozenset("comment commentlist comments discussion disqus replies respond".split())
# no content, however much they hold
NEVER = COMMENTS | frozenset("ad ads advert advertisement advertising adverts consent cookie cookies gdpr modal newsletter "
                             "notice notices overlay paywall popup sidebar sidebars signup sponsor sponsored subscribe".split())
# names that layout uses too
LAYOUT = frozenset("banner masthead share sharing social".split())
NAMES = NEVER | LAYOUT | frozenset("breadcrumb breadcrumbs footer menu menus nav navbar navigation pagination promo promotion "
                                   "recommended related toolbar widget widgets".split())
# after these, a class speaks of the page's layout or of a topic: no-sidebar, tag-comments
ABOUT = frozenset("no not non has have with without hide tag category cat topic taxonomy".split())
# with one of these, a class says what the page has or lacks: ads-free, popup-enabled
STATES = frozenset("disabled enabled free js loaded off ready".split())
# beside one of these, a name may be that of a frame around the content: content-sidebar-wrap
FRAMES = frozenset("body container content frame grid layout main page row site wrap wrapper".split())
# a start tag on the left ends an open element on the right
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}, "tbody": {"thead", "tbody", "tr", "td", "th"}}
SCOPES = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"},
          "th": {"table", "tr"}, "option": {"select"}, "tbody": {"table"}}
ARTICLES = ("main", "article")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
RADIUS, SIGMA = 2, 1.0
REGION_SHARE = 0.9  # the region narrows while one child holds this share of the hot text


class _Node:
    """An element: its place in document order, its depth, whether it lies in an article or a heading, and its topmost article."""

    __slots__ = ("tag", "parent", "skip", "article", "heading", "top", "closed", "depth", "index")

    def __init__(self, tag, parent, skip, article, closed=None, index=0):
        self.tag, self.parent, self.skip, self.article, self.closed, self.index = tag, parent, skip, article, closed, index
        self.depth = parent.depth + 1 if parent else 0
        self.heading = bool(parent and parent.heading) or tag in HEADINGS
        self.top = parent.top if parent and parent.top else self if article else None


class _Closed:
    """An element that gives no lines because of its class or id *word*; *framed*: the name also has a word for a frame."""

    __slots__ = ("word", "framed", "outer", "chars", "tags", "article")

    def __init__(self, word, framed, outer):
        self.word, self.framed, self.outer, self.chars, self.tags, self.article = word, framed, outer, 0, 0, False


class _Line:
    __slots__ = ("text", "tags", "link_chars", "anchors", "node")

    def __init__(self, text, tags, link_chars, anchors, node):
        self.text, self.tags, self.link_chars, self.anchors, self.node = text, tags, link_chars, anchors, node


class LineParser(HTMLParser):
    """Parser events to lines; tag soup is closed the way browsers close it.

    *opened*: numbers of the start tags whose class or id does not matter.
    """

    def __init__(self, opened=frozenset()):
        super().__init__(convert_charrefs=True)
        self.opened, self.starts = opened, 0
        self.closed: dict[int, _Closed] = {}
        self.node = self.root = _Node("html", None, "", False)
        self.nodes = [self.root]  # parents before children
        self.stacks: dict[str, list[_Node]] = {}  # open elements by tag, innermost last
        self.lines: list[_Line] = []
        self.pieces: list[str] = []
        self.tags = self.links = self.link_chars = self.anchors = 0

    def parse_marked_section(self, i, report=1):
        return self.parse_bogus_comment(i)

    def _break(self) -> None:
        if self.pieces:
            text = " ".join("".join(self.pieces).split())
            if text:
                self.lines.append(_Line(text, self.tags, self.link_chars, self.anchors, self.node))
                self.tags = self.link_chars = self.anchors = 0
            self.pieces = []

    def _to(self, node: _Node) -> None:
        """Make *node* the innermost open element."""
        while self.node is not node:
            self.links -= self.node.tag == "a" and self.links > 0
            self.stacks[self.node.tag].pop()
            self.node = self.node.parent

    def _inner(self, tags) -> _Node | None:
        """The innermost open element with one of *tags*."""
        return max((self.stacks[t][-1] for t in tags if self.stacks.get(t)), key=lambda n: n.depth, default=None)

    def _open(self, tags, stop=()) -> _Node | None:
        """The innermost open element with one of *tags*, unless one of *stop* lies further in."""
        node = self._inner(tags)
        if node is None or not stop:
            return node
        bar = self._inner(stop)
        return node if bar is None or bar.depth < node.depth or bar is node else None

    def _kind(self, tag: str, attrs: dict) -> str:
        """Why the element gives no lines, or ''."""
        if tag in SKIPPED or tag == "header" and not self.node.article:
            return tag
        if "hidden" in attrs or attrs.get("aria-hidden") == "true":
            return "hidden"
        if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", attrs.get("style") or ""):
            return "hidden"
        return "role" if tag not in ("html", "body", "main") and (attrs.get("role") or "") in ROLES else ""

    def _word(self, tag: str, attrs: dict) -> tuple[str, bool]:
        """By which word class or id call the element something else than content, or '', and whether a frame's word is beside it."""
        for name in f"{attrs.get('class') or ''} {attrs.get('id') or ''}".lower().split():
            words = [w for w in re.split(r"[^a-z0-9]+", name) if w]
            if not STATES.isdisjoint(words):
                continue
            pairs = [a + b for a, b in zip(words, words[1:])] + [""]  # side-bar is sidebar
            for word, pair in zip(words, pairs):
                if word in ABOUT:
                    break
                found = word if word in NAMES else pair if pair in NAMES else ""
                if tag in ARTICLES:
                    found = found if found in COMMENTS else ""
                if found or word == "header" and tag not in ARTICLES and not self.node.article:
                    return found or word, not FRAMES.isdisjoint(words)
        return "", False

    def handle_starttag(self, tag, attrs):
        self.tags += 1
        self.starts += 1
        inline = tag in INLINE
        if tag == "br":
            self.pieces.append(" ")
        elif not inline:
            self._break()
        if tag in VOID or tag in ("html", "body"):
            return
        if not inline and tag not in ("li", "dd", "dt") and (p := self._open(("p",), ("td", "th", "table", "button"))):
            self._to(p.parent)
        while tag in CLOSES and (old := self._open(CLOSES[tag], SCOPES[tag])):
            self._to(old.parent)
        if tag in ARTICLES and not self.node.closed and self.node.skip in ("head", "nav", "header", "footer", "menu", "form"):
            outer = self.node  # an unclosed menu or header does not swallow the article
            while outer.skip and not outer.closed:
                outer = outer.parent
            self._to(outer)
        skip, closed = self.node.skip, self.node.closed
        if not skip or closed:
            attrs = {k: v or "" for k, v in attrs}
            if kind := self._kind(tag, attrs):
                skip, closed = kind, None
            elif self.starts not in self.opened:
                word, framed = self._word(tag, attrs)
                if word and not (tag in ARTICLES and not self.node.article and not closed):
                    skip, closed = word, _Closed(word, framed, closed)
                    self.closed[self.starts] = closed
                elif closed and tag in ARTICLES:
                    closed.article = True
            if closed:
                closed.tags += 1
        self.links += tag == "a"
        self.anchors += tag == "a" and not skip
        self.node = _Node(tag, self.node, skip, self.node.article or tag in ARTICLES, closed, len(self.nodes))
        self.nodes.append(self.node)
        self.stacks.setdefault(tag, []).append(self.node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)  # "/>" closes void elements only

    def handle_endtag(self, tag):
        self.tags += 1
        if tag not in INLINE:
            self._break()
        stop = () if tag in ("table", "html", "body") or tag not in INLINE else ("td", "th", "li", "p", "div")
        if node := self._open((tag,), stop):
            self._to(node.parent)

    def handle_data(self, data):
        if self.node.tag == "head" and data.strip():
            self._to(self.node.parent)  # text ends an unclosed head
        if not self.node.skip:
            self.pieces.append(data)
            self.link_chars += len(data) if self.links else 0
        elif self.node.closed:
            self.node.closed.chars += len(" ".join(data.split()))

    def end(self) -> list[_Line]:
        self.close()
        self._break()
        return self.lines


def to_open(closed: dict[int, _Closed], lines: list[_Line]) -> set[int]:
    """Which elements closed by class or id are content after all: see the module for the three kinds of names."""
    for c in reversed(closed.values()):
        if c.outer:
            c.outer.tags += c.tags
            if c.word not in NEVER or c.framed:
                c.outer.chars += c.chars
                c.outer.article |= c.article
    seen = sum(len(x.text) for x in lines)
    total = seen + sum(c.chars for c in closed.values() if not c.outer and c.word not in NEVER)
    ratio = seen / max(sum(x.tags for x in lines), 1)
    has_article = any(x.node.article for x in lines)
    out = set()
    for i, c in closed.items():
        if c.word in NEVER:
            content = c.framed and c.article and not has_article and c.word not in COMMENTS
        else:
            content = c.article or c.word in LAYOUT and c.chars > 0.5 * total and c.chars / max(c.tags, 1) >= ratio
        if content:
            out.add(i)
    if lines:
        return out
    return {i for i in out if closed[i].article} or {i for i, c in closed.items() if c.word not in NEVER}


def smooth(values: np.ndarray, radius: int = RADIUS, sigma: float = SIGMA) -> np.ndarray:
    """Gaussian smoothing; near the ends the kernel is renormalised."""
    kernel = np.exp(-0.5 * (np.arange(-radius, radius + 1) / sigma) ** 2)
    total = np.convolve(values, kernel)[radius:radius + len(values)]
    return total / np.convolve(np.ones(len(values)), kernel)[radius:radius + len(values)]


def threshold(values: np.ndarray) -> float:
    """Border between two one-dimensional clusters (means, moved until they rest)."""
    low, high = float(values.min()), float(values.max())
    for _ in range(50):
        border = (low + high) / 2
        above = values > border
        if above.all() or not above.any():
            break
        new = float(values[~above].mean()), float(values[above].mean())
        if new == (low, high):
            break
        low, high = new
    return (low + high) / 2


def _read(html: str, opened=frozenset()) -> LineParser:
    parser = LineParser(opened)
    parser.feed(html)
    parser.end()
    return parser


def main_text(html: str | None) -> str:
    """The page's main text: blocks in page order joined by one space, '' if there is none."""
    html = html or ""
    rest = html.rfind(">") + 1
    if (cut := html.find("<", rest)) >= 0 and re.match("[a-zA-Z/!?]", html[cut + 1:cut + 2] or "x"):
        html = html[:cut]  # a tag that never ends is no text
    parser = _read(html)
    if parser.closed and (opened := to_open(parser.closed, parser.lines)):
        parser = _read(html, opened)
    lines = parser.lines
    named = [x for x in lines if x.node.article]
    lines = named or lines
    if not lines:
        return ""
    chars = np.array([len(x.text) for x in lines], dtype=float)
    ratio = smooth((chars - 0.9 * np.array([x.link_chars for x in lines])).clip(0)
                   / np.array([max(x.tags, 1) for x in lines]))
    border = threshold(ratio)
    hot = (ratio >= border) if ratio.max() > ratio.min() else np.ones(len(lines), dtype=bool)
    linked = np.array([x.link_chars for x in lines]) > 0.5 * chars
    if named:
        # every article is content, except a card that only links elsewhere
        told = {x.node.top for x, h, link in zip(lines, hot, linked) if h or not link}
        return " ".join(x.text for x in lines if x.node.top in told)

    # hot characters below every element, and its child with most of them
    weight = np.zeros(len(parser.nodes))
    np.add.at(weight, [x.node.index for x in lines], hot * chars)
    best: dict[int, _Node] = {}
    for node in reversed(parser.nodes[1:]):
        weight[node.parent.index] += weight[node.index]
        rival = best.get(node.parent.index)
        if rival is None or weight[node.index] >= weight[rival.index]:
            best[node.parent.index] = node
    region, way = parser.root, {0}
    while (down := best.get(region.index)) and down.tag != "p" and weight[down.index] >= REGION_SHARE * weight[0]:
        region = down
        way.add(region.index)
    # for every element: whether it lies in the region, and the element beside the way down, or below the region, that holds it
    within, beside = np.zeros(len(parser.nodes), dtype=bool), [None] * len(parser.nodes)
    for node in parser.nodes:
        up = node.parent
        within[node.index] = node is region or up is not None and within[up.index]
        if node.index not in way:
            beside[node.index] = beside[up.index] or node
    inside = within[[x.node.index for x in lines]]
    branch = [beside[x.node.index] for x in lines]
    # beside the region a link that is hot only by its neighbours does not speak for its branch
    told = {n for n, h, i, link in zip(branch, hot, inside, linked) if h and (i or not link)}
    title = [link and x.node.heading for link, x in zip(linked, lines)]
    titles = Counter(n for n, t in zip(branch, title) if t)
    kept = []
    for k, x in enumerate(lines):
        listed = linked[k] and (x.anchors > 1 or linked[max(k - 1, 0):k].any() or linked[k + 1:k + 2].any())
        own_words = branch[k] is None and (inside[k] or not listed)
        if not listed or own_words or branch[k] in told or title[k] and titles[branch[k]] == 1 or inside[k] and hot[k]:
            kept.append(x.text)
    return " ".join(kept)


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text and n_chars (code points) of every row.

    A null or empty page gives an empty text; ids and urls pass as they are, null
    too; repeated rows stay repeated; other columns are ignored.
    """
    def texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches, 500):
            got = [main_text(h) for h in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(got, pa.string()),
                 pa.array([len(t) for t in got], pa.int64())], names=["page_id", "url", "text", "n_chars"])

    return pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
                        F.col(html).cast("string").alias("html")) \
        .mapInArrow(texts, "page_id long, url string, text string, n_chars long")
