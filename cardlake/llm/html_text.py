"""Main text of web pages from flat text blocks.

A page is cut into flat blocks of text at the borders of block elements.  Each
block is described by its number of words and its link density, by both of
these for the block before and the block after it, by whether it is a heading,
and by the zone of the page it stands in.  A decision tree, trained here on a
small labelled table, tells main text from the rest.

Zones: 3 inside ``article`` or ``main``; 2 no such element on the page; 1
outside of it on a page that has one; 0 inside menus, headers, footers,
sidebars, notices, adverts, forms, reader comments or hidden elements, told by
element, role, id and class.  The nearest such element decides, but nothing
inside a sidebar, a list of related pages or comments counts as main.  Inside
``article`` or ``main`` a class or id tells an element apart only if that is what
it names in the end: ``cookie-banner``, ``ad-slot`` and ``user-comments`` do,
``promotion-history``, ``search-results`` and ``legal-analysis`` don't, and the rest
of an article stays, its lists of links included.

Text of a block: character references decoded, white space turned into one
space, trimmed.  Kept blocks are joined in page order by two line feeds.

Defined cases: null html, html without text and pages without main text give
an empty text; unclosed elements end where HTML lets them end or with the
page; an unclosed script, style or comment swallows the rest, as in browsers;
very long and deeply nested pages are read in one linear pass; repeated rows and extra columns
pass through; an empty table gives an empty one.
"""

from __future__ import annotations

import html as references
import re
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# ---- fixed values ---------------------------------------------------------------------
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt
 fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav
 ol optgroup option p pre section summary table tbody td tfoot th thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SKIPPED = ("script", "style", "noscript", "template", "iframe", "svg", "title", "textarea", "select",
           "canvas", "audio", "video", "object", "button")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# a start tag on the left ends an open element on the right
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
        "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
APART = frozenset("nav footer form dialog".split())            # zone 0 by element
STICKY = frozenset("aside".split())                            # zone 0 with all that is inside
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog alertdialog menu".split())
HINTS = frozenset("""ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion
 banner cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe
 subscription signup login nav navbar navigation menu menubar breadcrumb breadcrumbs footer masthead share
 sharing social pagination pager copyright legal disclaimer search toolbar skip topbar""".split())
STICKY_HINTS = frozenset("""sidebar aside related recommended recommendations teaser teasers widget widgets
 comment comments commentlist disqus reply replies discussion respond""".split())
# what an element holds or how it looks, of words in a class or id
PLAIN = frozenset("""area bar block body bottom box button buttons card container content entry form holder icon
 icons inner item items label left link links list outer panel post posts articles stories right row section slot
 small text title top unit wrap wrapper""".split())

# words, link density, the same of the block before and after, heading, zone -> main text
LABELLED = (
    # inside article or main
    (120, 0.0, 80, 0.0, 60, 0.0, 0, 3, 1), (1, 0.0, 40, 0.0, 30, 0.0, 0, 3, 1), (2, 0.0, 3, 0.0, 0, 0.0, 0, 3, 1),
    (8, 0.0, 0, 0.0, 45, 0.0, 1, 3, 1), (3, 0.0, 6, 1.0, 12, 0.0, 1, 3, 1), (6, 0.0, 9, 0.0, 1, 0.0, 1, 3, 1),
    (14, 0.2, 3, 0.0, 7, 0.0, 0, 3, 1), (45, 0.4, 20, 0.1, 33, 0.0, 0, 3, 1), (1, 0.0, 1, 1.0, 1, 1.0, 0, 3, 1),
    (5, 0.0, 9, 0.0, 0, 0.0, 0, 3, 1), (4, 1.0, 50, 0.0, 60, 0.1, 0, 3, 1), (10, 0.6, 22, 0.0, 18, 0.0, 0, 3, 1),
    (2, 1.0, 2, 1.0, 3, 1.0, 0, 3, 1), (4, 1.0, 3, 1.0, 2, 1.0, 0, 3, 1), (1, 1.0, 2, 1.0, 1, 1.0, 0, 3, 1),
    (6, 1.0, 7, 1.0, 5, 1.0, 0, 3, 1),
    # the page marks no main part
    (40, 0.0, 1, 0.0, 3, 0.0, 0, 2, 1), (38, 0.0, 2, 0.0, 1, 1.0, 0, 2, 1), (80, 0.0, 3, 0.0, 0, 0.0, 0, 2, 1),
    (60, 0.0, 40, 0.0, 55, 0.0, 0, 2, 1), (35, 0.1, 3, 0.0, 80, 0.0, 0, 2, 1), (90, 0.2, 2, 1.0, 4, 0.0, 0, 2, 1),
    (18, 0.0, 50, 0.0, 25, 0.1, 0, 2, 1), (4, 0.0, 40, 0.0, 60, 0.0, 0, 2, 1), (7, 0.0, 2, 1.0, 50, 0.0, 1, 2, 1),
    (5, 0.0, 30, 0.0, 45, 0.0, 1, 2, 1), (12, 0.0, 33, 0.0, 21, 0.0, 0, 2, 1), (25, 0.3, 35, 0.0, 3, 1.0, 0, 2, 1),
    (3, 0.0, 2, 1.0, 4, 1.0, 0, 2, 0), (2, 1.0, 3, 1.0, 2, 1.0, 0, 2, 0), (6, 0.0, 4, 0.0, 0, 0.0, 0, 2, 0),
    (9, 0.8, 5, 1.0, 40, 0.0, 0, 2, 0), (30, 0.9, 12, 1.0, 8, 1.0, 0, 2, 0), (4, 0.0, 1, 1.0, 2, 0.0, 1, 2, 0),
    (1, 1.0, 40, 0.0, 1, 1.0, 0, 2, 0), (3, 1.0, 50, 0.0, 60, 0.0, 0, 2, 0), (5, 1.0, 2, 1.0, 45, 0.0, 0, 2, 0),
    (8, 0.0, 45, 0.0, 2, 1.0, 0, 2, 0), (5, 0.0, 30, 0.0, 0, 0.0, 0, 2, 0), (60, 0.8, 20, 0.0, 25, 0.0, 0, 2, 0),
    (7, 0.0, 16, 0.0, 13, 0.0, 0, 2, 1), (4, 0.0, 11, 0.0, 7, 0.0, 1, 2, 1), (8, 0.0, 9, 0.0, 21, 0.0, 0, 2, 1),
    (5, 0.0, 7, 0.0, 12, 0.0, 0, 2, 1), (14, 0.0, 10, 0.0, 0, 0.0, 0, 2, 0), (11, 0.0, 30, 0.0, 0, 0.0, 0, 2, 0),
    (17, 0.0, 12, 0.0, 10, 0.0, 0, 2, 1), (9, 0.0, 9, 0.0, 9, 0.0, 1, 2, 1), (2, 0.0, 2, 0.0, 2, 0.0, 0, 2, 1),
    (13, 0.0, 55, 0.0, 6, 0.0, 0, 2, 1), (2, 0.0, 45, 0.0, 38, 0.0, 0, 2, 1), (1, 0.0, 0, 0.0, 36, 0.0, 1, 2, 1),
    (10, 0.0, 1, 1.0, 9, 0.0, 0, 2, 0), (12, 0.0, 2, 1.0, 6, 0.0, 0, 2, 0),
    (2, 0.0, 0, 0.0, 0, 0.0, 0, 2, 1), (9, 0.0, 0, 0.0, 0, 0.0, 0, 2, 1), (3, 1.0, 0, 0.0, 0, 0.0, 0, 2, 0),
    # outside of the part that the page marks
    (50, 0.0, 0, 0.0, 30, 0.0, 0, 1, 0), (8, 0.0, 3, 1.0, 12, 0.0, 0, 1, 0), (20, 0.2, 60, 0.0, 4, 0.0, 1, 1, 0),
    (2, 1.0, 2, 1.0, 2, 1.0, 0, 1, 0), (5, 0.0, 40, 0.0, 0, 0.0, 1, 1, 0),
    # told apart by element, role, id or class
    (70, 0.0, 20, 0.0, 90, 0.0, 0, 0, 0), (6, 0.0, 1, 1.0, 10, 0.0, 1, 0, 0), (1, 1.0, 1, 1.0, 1, 1.0, 0, 0, 0),
    (15, 0.1, 30, 0.0, 25, 0.0, 0, 0, 0), (3, 0.0, 80, 0.0, 0, 0.0, 0, 0, 0), (200, 0.0, 90, 0.0, 80, 0.0, 0, 0, 0),
)
# ---- end of fixed values --------------------------------------------------------------

_MARKUP = re.compile(
    r"<!--(?:>|->|.*?(?:--!?>|\Z))"
    r"|<(" + "|".join(SKIPPED) + r")\b(?:\"[^\"]*\"|'[^']*'|[^'\">])*+>.*?(?:</\1\s*+>|\Z)"
    r"|<[!?][^>]*+>?"
    r"|<(/?)([a-zA-Z][^\s/>]*+)((?:\"[^\"]*\"|'[^']*'|[^'\">])*+)>"
    r"|</?[a-zA-Z][^>]*+>", re.S | re.I)
_SHUT = re.compile(r"(?:</[a-zA-Z]+\s*>|--!?>|<!-->)\Z")
_ATTRIBUTE = re.compile(r"([^\s=/\"']+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"']+)))?")
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|[0-9]+")


# Elements that hold the page's text; their classes and ids tell of the layout.
WHOLE = ("html", "body", "main", "article")


def _hints(value: str, inside: bool) -> tuple[bool, bool, bool]:
    """Whether a class or id tells of (a sidebar or comments, another part of a layout, a header)."""
    named = set()
    for token in value.split():
        parts = [p.lower() for p in _PARTS.findall(token)]
        if inside:      # what the element is stands last
            parts = [p for p in parts if p not in PLAIN and not p.isdigit()][-1:]
        named.update(parts)
    return bool(named & STICKY_HINTS), bool(named & HINTS), "header" in named


def zone_mark(name: str, attributes: str, inside: bool = False) -> str:
    """How an element marks what is inside: "main", "apart", "sticky" or "" (not at all).

    ``inside``: it stands in an ``article`` or ``main``.
    """
    if name in STICKY:
        return "sticky"
    mark = "apart" if name in APART else "main" if name in ("article", "main") else ""
    if name == "header":
        mark = "header"
    for m in _ATTRIBUTE.finditer(attributes) if attributes and attributes != "/" else ():
        key, value = m[1].lower(), references.unescape(m[2] or m[3] or m[4] or "")
        if key in ("class", "id") and name not in WHOLE:
            sticky, apart, header = _hints(value, inside)
            if sticky:
                return "sticky"
            if apart:
                mark = "apart"
            elif header and not mark:
                mark = "header"
        elif key == "role" and value.lower() in ROLES:
            mark = "apart"
        elif key == "role" and value.lower() == "main":
            mark = "main"
        elif key == "hidden" or (key == "aria-hidden" and value.lower() == "true") or (
                key == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I)):
            return "sticky"
    return mark


class _Open(NamedTuple):
    """An open element: the zone it makes, and the links and headings that it stands in, itself included."""

    name: str
    zone: str
    links: int
    headings: int


def blocks(page: str) -> list[tuple[str, int, int, int, int]]:
    """(text, words, words in links, heading, zone) of every block, zones 0, 1 (no mark) and 3."""
    out: list[tuple] = []
    open_: list[_Open] = []                 # outermost first
    places: dict[str, list[int]] = {}       # of the open elements of a name, outermost first
    borders = [-1]                          # of the open block elements that aren't paragraphs
    pieces: list[str] = []
    linked: list[str] = []
    now = top = _Open("", "", 0, 0)         # the innermost open element

    def flush():
        nonlocal pieces, linked
        if pieces:
            words = references.unescape("".join(pieces)).split()
            if words:
                in_links = len(references.unescape(" ".join(linked)).split()) if linked else 0
                out.append((" ".join(words), len(words), min(in_links, len(words)), int(now.headings > 0),
                            {"main": 3, "": 1}.get(now.zone, 0)))
            pieces, linked = [], []

    def text(value):
        if value:
            pieces.append(value)
            if now.links:
                linked.append(value)

    def close(i):
        """Close the element at place ``i`` with all that is open inside it."""
        nonlocal now
        while len(open_) > i:
            places[open_.pop().name].pop()
        while borders[-1] >= i:
            borders.pop()
        now = open_[-1] if open_ else top

    at, limit, swallowed = 0, page.rfind(">") + 1, False
    # without a ">" to come nothing is a tag, so nothing is looked for there
    for m in _MARKUP.finditer(page, 0, limit):
        text(page[at:m.start()])
        at = m.end()
        if at == limit:  # what stays open here takes the rest of the page with it
            swallowed = not (_SHUT.search(m[0]) if m[1] or m[0].startswith("<!--") else True)
        name = m[3]
        if name is None:
            if m[1]:
                text(" ")
            continue
        name = name.lower()
        if name == "br":
            text(" ")
            continue
        block = name in BLOCKS
        if block:
            flush()
        if m[2]:
            if places.get(name):
                close(places[name][-1])
            continue
        if name in VOID or m[4].endswith("/") and not block:
            continue
        if block and places.get("p") and places["p"][-1] > borders[-1]:
            close(places["p"][-1])      # a block element ends an open paragraph and what is open inside it
        if name == "a" and now.name == "a":
            close(len(open_) - 1)
        for i in range(len(open_) - 1, max(-1, len(open_) - 6), -1):
            if open_[i].name in ENDS.get(name, ()):
                close(i)
                break
            if open_[i].name in ("ul", "ol", "dl", "table", "select"):
                break
        mark = zone_mark(name, m[4], now.zone == "main")
        if mark == "header":
            mark = "" if now.zone == "main" else "apart"
        places.setdefault(name, []).append(len(open_))
        if block and name != "p":
            borders.append(len(open_))
        now = _Open(name, now.zone if now.zone == "sticky" or not mark else mark,
                    now.links + (name == "a"), now.headings + (name in HEADINGS))
        open_.append(now)
    if not swallowed:
        text(page[at:].split("<!--", 1)[0])
    flush()
    return out


def features(found: list[tuple]) -> np.ndarray:
    """The tree's input, one row a block (the columns of LABELLED)."""
    marked = any(b[4] == 3 for b in found)
    words = [0, *(b[1] for b in found), 0]
    density = [0.0, *(b[2] / b[1] for b in found), 0.0]
    return np.array([(words[i + 1], density[i + 1], words[i], density[i], words[i + 2], density[i + 2], b[3],
                      b[4] if b[4] != 1 or marked else 2) for i, b in enumerate(found)], float).reshape(-1, 8)


class Tree:
    """A binary decision tree grown by Gini impurity; ``nodes``: (feature, threshold, left, right, label)."""

    def __init__(self, rows, depth: int = 9):
        data = np.array(rows, float)
        self.nodes: list[tuple] = []
        self._grow(data[:, :-1], data[:, -1], depth)

    def _grow(self, x, y, depth) -> int:
        me = len(self.nodes)
        self.nodes.append((-1, 0.0, -1, -1, int(y.mean() >= 0.5)))
        if depth == 0 or y.min() == y.max():
            return me
        best = None
        for f in range(x.shape[1]):
            values = np.unique(x[:, f])
            for cut in (values[1:] + values[:-1]) / 2:
                below = x[:, f] < cut
                p, q = y[below].mean(), y[~below].mean()
                cost = below.sum() * p * (1 - p) + (~below).sum() * q * (1 - q)
                if best is None or cost < best[0] - 1e-12:
                    best = (cost, f, cut, below)
        if best is None:
            return me
        _, f, cut, below = best
        left = self._grow(x[below], y[below], depth - 1)
        right = self._grow(x[~below], y[~below], depth - 1)
        self.nodes[me] = (f, float(cut), left, right, self.nodes[me][4])
        return me

    def predict(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros(len(x), bool)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            f, cut, left, right, label = self.nodes[node]
            if f < 0:
                out[rows] = label
            elif len(rows):
                below = x[rows, f] < cut
                todo += [(left, rows[below]), (right, rows[~below])]
        return out


def main_text(page: str | None, tree: Tree) -> str:
    found = blocks(page) if page else []
    if not found:
        return ""
    return "\n\n".join(b[0] for b, keep in zip(found, tree.predict(features(found))) if keep)


def with_main_text(df: DataFrame, html: str = "html", text: str = "text", n_chars: str = "n_chars",
                   columns: list[str] | None = None, labelled=LABELLED) -> DataFrame:
    """``df`` (its ``columns``; default all) with the main text and its code points."""
    keep = [c for c in (df.columns if columns is None else columns) if c not in (text, n_chars)]
    src = df.select(*keep, *([] if html in keep else [html]))
    tree = Tree(labelled)

    def run(batches):
        for b in batches:
            found = [main_text(v.as_py(), tree) for v in b[html]]
            yield pa.RecordBatch.from_arrays(
                [*[b[c] for c in keep], pa.array(found, pa.string()),
                 pa.array([len(t) for t in found], pa.int64())], names=[*keep, text, n_chars])

    return src.mapInArrow(run, T.StructType([*[src.schema[c] for c in keep],
                                             T.StructField(text, T.StringType()),
                                             T.StructField(n_chars, T.LongType())]))
