"""Main text of web pages from streaming parser events.

The standard-library parser feeds events to a small state machine that cuts a
page into lines, one per block element, with the text, the tags and the linked
characters of each, and hangs the lines on a tree of the page's boxes.  What can
never be text of an article (scripts, navigation, asides, hidden elements) is
left out by its element or role.  Class names and ids are hints only: a box
that they call an advert, a sidebar or the like goes unless it holds most of the
page's text, one of related links unless it is as dense as the rest, reader
comments go always; a form goes unless most of the text is in it.

Every line that is left gets its text-to-tag ratio; the ratios are smoothed with
a Gaussian over neighbouring lines, and a threshold clusters lines into content
and the rest.  The tree then settles the regions, on every page alike: from the
page's article or main element, else from its root, the walk goes down as long
as one box holds most of the content, and beside it keeps boxes of paragraphs
that are large enough or have a heading.  A region is kept whole if most of its
text lies in content lines, so short paragraphs inside an article survive.

Defined results for odd rows: a null or empty page, or one without content,
gives an empty text; unclosed and stray tags are tolerated; a page of any
length is read whole; repeated rows are treated alike; an empty table gives an
empty result; columns that clash with the results are replaced, all others pass
through.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import lean

# Element names, roles, and words of class names and ids.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd "
                    "label mark nobr q rp rt ruby s samp small span strike strong sub sup time tt "
                    "u var wbr".split())
_NEVER = frozenset("script style noscript template head title nav footer aside button select "
                   "textarea option svg canvas iframe object dialog menu audio video map".split())
_REGIONS = frozenset(("article", "main"))
_CONTAINERS = frozenset("body div section td center table ul ol dl blockquote fieldset form "
                        "header article main".split())
_PROSE = frozenset("p h1 h2 h3 h4 h5 h6 pre blockquote".split())
_HEADINGS = frozenset("h1 h2 h3".split())
_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert "
                   "alertdialog menu menubar toolbar".split())
_COMMENTS = frozenset("comment comments commentlist disqus respond".split())
_LINKS = frozenset("related recommended share sharing social widget widgets toolbar".split())
_ASIDE = frozenset("ad ads advert adverts advertisement advertising adsense sponsor sponsored promo "
                   "promotion banner cookie cookies consent gdpr notice alert popup modal overlay "
                   "newsletter subscribe signup login sidebar menu nav navbar navigation breadcrumb "
                   "breadcrumbs pagination header masthead topbar footer".split())
_TITLES = frozenset("header masthead".split())  # inside an article they hold its title
_RELATIONS = frozenset("with without has no not show hide".split())  # "no-sidebar" is no sidebar
_SPLIT = re.compile(r"[^a-z0-9]+")

_SIGMA = 1.0
_KERNEL = [math.exp(-(d * d) / (2 * _SIGMA * _SIGMA)) for d in range(-2, 3)]


class _Box:
    """An element that holds lines; ``mark`` is what speaks against it."""

    __slots__ = ("parent", "mark", "main", "chars", "linked", "tags", "prose", "headed", "good", "own", "children")

    def __init__(self, parent: _Box | None, mark: str = "", main: bool = False):
        self.parent, self.mark, self.main = parent, mark, main
        self.chars = self.linked = self.tags = self.prose = self.good = self.own = 0
        self.headed = False
        self.children: list[_Box] = []
        if parent is not None:
            parent.children.append(self)

    def above(self) -> Iterator[_Box]:
        box: _Box | None = self
        while box is not None:
            yield box
            box = box.parent


class _Line:
    __slots__ = ("parts", "tags", "linked", "box", "kind")

    def __init__(self, box: _Box, kind: str):
        self.parts: list[str] = []
        self.tags = 1
        self.linked = 0
        self.box, self.kind = box, kind

    def text(self) -> str:
        return " ".join("".join(self.parts).split())


def _mark(tag: str, attrs: list, in_main: bool) -> str:
    """``never`` for what is no text of an article, ``comments``, ``aside`` or
    ``links`` for what the names of a box suggest, else nothing."""
    if tag in _NEVER or (tag == "header" and not in_main):
        return "never"
    if tag in ("html", "body", "main"):
        return ""
    found = "aside" if tag == "form" else ""
    for name, value in attrs:
        if not value:
            if name == "hidden":
                return "never"
        elif name in ("class", "id"):
            for token in value.lower().split():
                words = {w for w in _SPLIT.split(token) if w}
                if not words.isdisjoint(_RELATIONS):
                    continue
                if not words.isdisjoint(_COMMENTS):
                    return "comments"
                if not words.isdisjoint(_ASIDE - _TITLES if in_main else _ASIDE) and tag != "article":
                    found = "aside"
                elif not words.isdisjoint(_LINKS) or tag == "article" and not words.isdisjoint(_ASIDE):
                    found = found or "links"
        elif name == "role" and value.lower() in _ROLES:
            return "never"
        elif name == "style" and "display:none" in value.lower().replace(" ", ""):
            return "never"
    return found


class _Events(HTMLParser):
    """Lines of one page, on its tree of boxes."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.lines: list[_Line] = []
        self.root = _Box(None)
        # tag, box, in a link, the element that the text is of
        self.stack: list[tuple[str, _Box, bool, str]] = []
        self.line = _Line(self.root, "")

    def _top(self) -> tuple[_Box, bool, str]:
        return self.stack[-1][1:] if self.stack else (self.root, False, "")

    def _cut(self) -> None:
        if self.line.parts:
            self.lines.append(self.line)
        box, _, kind = self._top()
        self.line = _Line(box, kind)

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in _VOID:
            if tag == "br" or tag == "hr":
                self.line.parts.append(" ")
                self.line.tags += 1
                if tag == "hr":
                    self._cut()
            return
        if tag == "p" or tag == "li":  # implied end of an open one
            for i in range(len(self.stack) - 1, max(-1, len(self.stack) - 8), -1):
                if self.stack[i][0] == tag:
                    del self.stack[i:]
                    break
                if self.stack[i][0] not in _INLINE:
                    break
        box, link, kind = self._top()
        block = tag not in _INLINE
        if box.mark != "never":
            in_main = any(b.main for b in box.above())
            mark = _mark(tag, attrs, in_main) if attrs or tag in _NEVER or tag in ("header", "form") else ""
            main = tag in _REGIONS and not mark and not in_main and not any(
                b.mark == "comments" for b in box.above())
            if main:  # a box left open before the article does not hold it
                for b in box.above():
                    if b.mark:
                        box = b.parent
            if mark or main or tag in _CONTAINERS:
                box = _Box(box, mark, main)
        if tag in _PROSE:
            kind = tag
        elif block:
            kind = ""
        self.stack.append((tag, box, link or tag == "a", kind))
        if block:
            self._cut()
        self.line.tags += 1

    def handle_endtag(self, tag: str) -> None:
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                block = any(t not in _INLINE for t, *_ in self.stack[i:])
                del self.stack[i:]
                if block:
                    self._cut()
                return

    def handle_data(self, data: str) -> None:
        box, link, kind = self._top()
        if box.mark == "never":
            return
        if not self.line.parts:
            self.line.box, self.line.kind = box, kind
        self.line.parts.append(data)
        if link:
            self.line.linked += len(data)


_Lines = list[tuple[str, _Line]]


def _weigh(lines: _Lines, root: _Box) -> None:
    """Sums of the lines below every box."""
    todo = [root]
    while todo:
        box = todo.pop()
        box.chars = box.linked = box.tags = box.prose = 0
        box.headed = False
        todo += box.children
    for t, x in lines:
        for box in x.box.above():
            box.chars += len(t)
            box.linked += min(len(t), x.linked)
            box.tags += x.tags
            box.prose += x.kind in _PROSE
            box.headed |= x.kind in _HEADINGS


def _goes(box: _Box, page: _Box, comments: int) -> bool:
    """Whether a box goes for what its names suggest, given what it holds."""
    if box.mark == "comments":
        return True
    if box.mark == "aside":
        most = 2 * box.chars >= page.chars - comments
        return not (most and (box.chars >= 200 or box.prose >= 2))
    if box.mark == "links":
        return 4 * box.linked >= box.chars or 2 * box.chars * page.tags < page.chars * box.tags
    return False


def _eligible(lines: _Lines, root: _Box) -> _Lines:
    """The lines of boxes that stay."""
    _weigh(lines, root)
    comments = sum(len(t) for t, x in lines if any(b.mark == "comments" for b in x.box.above()))
    verdicts: dict[int, bool] = {}

    def out(box: _Box) -> bool:
        path = []
        for b in box.above():
            if id(b) in verdicts:
                break
            path.append(b)
        for b in reversed(path):
            verdicts[id(b)] = (b.parent is not None and verdicts[id(b.parent)]) or bool(
                b.mark and _goes(b, root, comments))
        return verdicts[id(box)]

    return [p for p in lines if not out(p[1].box)]


def _content(lines: _Lines) -> list[bool]:
    """Content lines: smoothed text-to-tag ratio at or above the threshold,
    the lesser of half the mean and the standard deviation."""
    ratios = [(len(t) - min(len(t), x.linked)) / x.tags for t, x in lines]
    n = len(ratios)
    smooth = []
    for i in range(n):
        total = weight = 0.0
        for d, k in zip(range(-2, 3), _KERNEL):
            if 0 <= i + d < n:
                total += k * ratios[i + d]
                weight += k
        smooth.append(total / weight)
    mean = sum(smooth) / n
    spread = math.sqrt(sum((x - mean) ** 2 for x in smooth) / n)
    cut = min(mean / 2, spread) if spread > 0 else mean / 2
    return [x >= cut and x > 0 for x in smooth]


def _regions(lines: _Lines, flags: list[bool], root: _Box) -> set[int]:
    """Boxes whose lines make the text (each without the boxes below it)."""
    own: dict[int, list[int]] = {}  # characters of a box's own lines: all, in content lines
    todo = [root]
    while todo:
        box = todo.pop()
        box.good = box.own = 0
        todo += box.children
    for (t, x), ok in zip(lines, flags):
        sums = own.setdefault(id(x.box), [0, 0])
        sums[0] += len(t)
        sums[1] += len(t) if ok else 0
        x.box.own += 1
        if ok:
            # paragraphs and headings speak for a box, bare text half as much
            for box in x.box.above():
                box.good += len(t) if x.kind in _PROSE else len(t) // 2
    kept: set[int] = set()

    def keep(box: _Box) -> None:
        todo = [box]
        while todo:
            b = todo.pop()
            kept.add(id(b))
            todo += b.children

    box = root
    while True:
        best = max((b for b in box.children if b.good), key=lambda b: b.good, default=None)
        if best is None or box.main or 2 * best.good <= box.good:
            keep(box)
            break
        for b in box.children:
            if b is not best and b.prose and 4 * b.linked < b.chars and (
                    b.headed or 20 * b.good >= best.good):
                keep(b)
        if any(x.box is box and x.kind in _PROSE for _, x in lines):
            kept.add(id(box))
        box = best
    return {i for i in kept if i in own and 2 * own[i][1] >= own[i][0]}


def extract(page: str | None) -> str:
    """Main text of one page, its blocks joined by newlines."""
    if not page:
        return ""
    events = _Events()
    events.feed(page)
    events.close()
    events._cut()
    lines = _eligible([(t, x) for x in events.lines if (t := x.text())], events.root)
    mains = [p for p in lines if any(b.main for b in p[1].box.above())]
    lines = mains or lines
    if not lines:
        return ""
    _weigh(lines, events.root)
    kept = _regions(lines, _content(lines), events.root)
    return "\n".join(t for t, x in lines if id(x.box) in kept)


def extract_text(pages: DataFrame, html: str = "html", carry: list[str] | None = None) -> DataFrame:
    """Add ``text`` and ``n_chars`` to ``pages`` (or to its ``carry`` columns)."""
    carry = [c for c in (pages.columns if carry is None else carry) if c not in ("text", "n_chars")]
    schema = T.StructType([*(pages.schema[c] for c in carry), T.StructField("text", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = pa.array([extract(x.as_py()) for x in b.column("_html")], pa.string())
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in carry), texts],
                                             names=[*carry, "text"])

    return (pages.select(*carry, F.col(html).alias("_html")).mapInArrow(lean(run), schema)
            .withColumn("n_chars", F.length("text").cast("long")))
