"""Main text of web pages by composite text density.

The page is parsed into a tree that forgives missing end tags. For every node the link-adjusted characters per tag (composite
text density) are computed, and the densities of its children are summed. The node of the largest sum is the core of the
article; it is widened to ancestors as long as the density stays (WIDEN), whatever their names. The smallest density on the path from
the body to the core is the threshold: of every other node that reaches it, the subtree of the largest sum is taken
too, if it is a heading or has SHARE of the core's sum; link lists below it inside the article are left out.

Menus, headers, footers, sidebars, notices, adverts, forms and reader comments are no article, however dense: what a page marks as
such by tag, role or class holds no text for all of this. Where it marks nothing, density alone decides.

Null and empty pages, and pages without text, give an empty string; nothing is cut off, however long a page is, and the time is
in proportion to its length, whatever is left open in it; every row is handled by itself, so repeated rows agree; an empty table gives
an empty column; the function reads the one column named, so other columns, also of clashing names, change nothing.
"""

from __future__ import annotations

import html
import re
from functools import lru_cache
from math import e, log

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

_VALUE = r"""(?:"[^"]*+"|'[^']*+'|[^\s>]*+)"""
_NAMED = rf"[^\s/>][^\s/>=]*+(?:\s*+=\s*+{_VALUE})?+"
#: Comments, CDATA, declarations, tags; a quote begins a value only right behind "=". A tag that the page's end cuts off is no text.
TOKEN = re.compile(rf"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*+>?|<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|{_NAMED})*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>|</?[a-zA-Z][^>]*\Z", re.S)
ATTRIBUTE = re.compile(rf"([^\s/>][^\s/>=]*+)(?:\s*+=\s*+({_VALUE}))?+")
#: Share of its own density that the core may lose by being widened to its parent, and share of the core's sum that other parts need.
WIDEN, SHARE = 0.75, 0.05
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "textarea", "title", "noscript", "iframe", "template", "xmp", "noembed", "noframes"}
NOTEXT = {"head", "nav", "aside", "footer", "form", "button", "select", "option", "dialog", "menu", "object", "svg", "canvas", "audio", "video", "map", "datalist"} | RAW
BLOCK = {
    "address", "article", "aside", "blockquote", "body", "center", "dd", "details", "dialog", "dir", "div", "dl", "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6",
    "header", "hgroup", "hr", "html", "li", "main", "menu", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td", "tfoot", "th", "thead", "tr", "ul", "caption",
}
#: A start tag ends an open element of these, unless one of the second set lies between.
ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
ASIDE = set("ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar menu nav navbar navigation breadcrumb breadcrumbs footer masthead cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended recommendations toolbar pagination pager widget copyright legal".split())
READERS = {"comment", "comments", "commentlist", "disqus", "replies", "discussion", "respond"}
ARTICLE = {"content", "article", "main", "post", "entry", "body", "story"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu", "menubar"}


def _aside(tag: str, attributes: str, inside: bool) -> bool:
    """Whether an element holds no article text. inside: within an article."""
    if tag in NOTEXT or tag == "header" and not inside:
        return True
    if not attributes or tag in ("html", "body", "article", "main"):
        return False
    for name, value in ATTRIBUTE.findall(attributes):
        name = name.lower()
        if name in ("class", "id"):
            words = set(re.split(r"[^a-z]+", value.lower()))
            if words & READERS or words & ASIDE and not words & ARTICLE or "header" in words and not inside and not words & ARTICLE:
                return True
        elif name == "role" and value.strip("\"'").lower() in ROLES or name == "hidden" or name == "aria-hidden" and "true" in value.lower():
            return True
    return False


@lru_cache(512)
def _ended(name: str) -> tuple[frozenset[str], frozenset[str]]:
    """Tags of open elements that a start tag ends, and of those beyond which it ends none."""
    targets, walls = ENDS.get(name, (set(), set()))
    if name in BLOCK:
        targets, walls = targets | {"p"}, walls | {"div", "article", "section", "td", "li", "body", "main", "aside", "blockquote"}
    return frozenset(targets), frozenset(walls - targets)


class Tree:
    """Nodes in page order, so a subtree is a run of numbers; pieces: (node, text), text None between blocks."""

    def __init__(self, page: str):
        self.tag, self.parent, self.gone, self.end, self.inside = ["#"], [-1], [False], [0], [False]
        self.pieces: list[tuple[int, str | None]] = []
        self.open = [0]
        self.depths: dict[str, list[int]] = {}  # by tag, where the open elements stand in self.open
        at = 0
        while m := TOKEN.search(page, at):
            if m.start() > at:
                self._text(html.unescape(page[at : m.start()]))
            at = m.end()
            if m[1]:
                self._text(m[1])
            if name := m[3] or m[6]:
                name = name.lower()
                if m[2] or m[5]:
                    self._close(name)
                else:
                    self._start(name, m[4] or m[7] or "")
                    if name in RAW:
                        close = re.compile(rf"</{name}(?=[\s/>])|</{name}\Z", re.I).search(page, at)
                        at = close.start() if close else len(page)
        if at < len(page):
            self._text(html.unescape(page[at:]))
        self._pop(0)

    def _text(self, s: str) -> None:
        if not self.gone[self.open[-1]]:
            self.pieces.append((self.open[-1], s))

    def _pop(self, depth: int) -> None:
        while len(self.open) > depth:
            k = self.open.pop()
            self.end[k] = len(self.tag)
            if k:
                self.depths[self.tag[k]].pop()

    def _last(self, names) -> int:
        """Where the innermost open element of these tags stands, -1 for none."""
        return max((d[-1] for n in names if (d := self.depths.get(n))), default=-1)

    def _start(self, name: str, attributes: str) -> None:
        targets, walls = _ended(name)
        while targets and (depth := self._last(targets)) > self._last(walls):
            tag = self.tag[self.open[depth]]
            self._pop(depth)
            if tag != "p":
                break
        up = self.open[-1]
        n = len(self.tag)
        self.tag.append(name)
        self.parent.append(up)
        self.inside.append(self.inside[up] or name in ("article", "main"))
        self.gone.append(self.gone[up] or _aside(name, attributes, self.inside[up]))
        self.end.append(n + 1)
        if name in BLOCK:
            self.pieces.append((n, None))
        elif name == "br":
            self.pieces.append((up, " "))
        if name not in VOID and not (attributes.endswith("/") and name not in BLOCK and name != "a"):
            self.depths.setdefault(name, []).append(len(self.open))
            self.open.append(n)

    def _close(self, name: str) -> None:
        if (depth := self._last([name])) > 0:
            self._pop(depth)
        if name in BLOCK:
            self.pieces.append((self.open[-1], None))


def densities(t: Tree) -> tuple[list[float], list[int], list[int], list[int]]:
    """Composite text density, characters, link characters and links of every node."""
    n = len(t.tag)
    link = [False] * n
    chars, tags, link_chars, links = [0] * n, [0] * n, [0] * n, [0] * n
    for k in range(1, n):
        link[k] = link[t.parent[k]] or t.tag[k] == "a"
    for k, s in t.pieces:
        if s:
            size = len(" ".join(s.split()))
            chars[k] += size
            if link[k]:
                link_chars[k] += size
    for k in range(n - 1, 0, -1):
        up = t.parent[k]
        if not t.gone[k]:
            chars[up] += chars[k]
            tags[up] += tags[k] + 1
            link_chars[up] += link_chars[k]
            links[up] += links[k] + (t.tag[k] == "a")
    share = link_chars[0] / max(1, chars[0])
    out = []
    for c, g, lc, a in zip(chars, tags, link_chars, links, strict=True):
        if not c:
            out.append(0.0)
            continue
        base = log(c / max(1, c - lc) * lc + share * c + e)
        out.append(c / max(1, g) * max(0.0, log(c / max(1, lc) * max(1, g) / max(1, a))) / base)
    return out, chars, link_chars, links


def main_text(page: str | None) -> str:
    if not page:
        return ""
    t = Tree(page)
    density, chars, link_chars, links = densities(t)
    n = len(t.tag)
    # Only blocks are summed, each by the nearest block around it: letters in bold are no part of their own.
    total, around = [0.0] * n, [0] * n
    for k in range(1, n):
        up = t.parent[k]
        around[k] = up if t.tag[up] in BLOCK else around[up]
        if not t.gone[k] and t.tag[k] in BLOCK:
            total[around[k]] += density[k]
    fit = [k for k in range(n) if not t.gone[k] and chars[k]]
    if not fit:
        return ""
    core = max(fit, key=lambda k: (total[k], k))
    frame = lambda k: not k or t.tag[k] in ("html", "body")
    up, threshold = core, density[core]
    while not frame(up):
        up = t.parent[up]
        threshold = min(threshold, density[up])
    whole = core
    while not frame(whole) and not frame(t.parent[whole]) and density[t.parent[whole]] >= WIDEN * density[whole]:
        whole = t.parent[whole]
    # The subtree of the largest sum below each node, itself included.
    peak = list(range(n))
    for k in range(n - 1, 0, -1):
        up = t.parent[k]
        if not t.gone[k] and total[peak[k]] > total[peak[up]]:
            peak[up] = peak[k]
    kept, reached = [False] * n, [True] * n
    kept[whole] = True
    for k in range(1, n):
        reached[k] = reached[t.parent[k]] and not t.gone[k] and (frame(k) or chars[k] > 0 and density[k] >= threshold)
        if reached[k] and not frame(k) and (t.tag[k] in HEADINGS or max(total[peak[k]], density[k]) >= SHARE * total[core]):
            kept[peak[k] if total[peak[k]] > density[k] else k] = True
    for k in range(1, n):
        kept[k] = kept[k] or kept[t.parent[k]]
    left = [False] * n  # out of the text: link lists inside whose density is below the threshold
    for k in range(1, n):
        left[k] = kept[t.parent[k]] and left[t.parent[k]] or kept[t.parent[k]] and t.tag[k] in ("ul", "ol", "div", "section", "table") and links[k] >= 3 and link_chars[k] > 0.66 * chars[k] and density[k] < threshold
    blocks, now = [], []
    for k, s in t.pieces:
        if s is not None and (not kept[k] or t.gone[k] or left[k]):
            continue
        if s is None:
            blocks.append(" ".join("".join(now).split()))
            now = []
        else:
            now.append(s)
    blocks.append(" ".join("".join(now).split()))
    return "\n\n".join(b for b in blocks if b)


def extract(page: str) -> Column:
    """The main text of a column of web pages."""

    @F.arrow_udf("string")
    def run(pages: pa.Array) -> pa.Array:
        return pa.array([main_text(p.as_py()) for p in pages], pa.string())

    return run(F.col(page))
