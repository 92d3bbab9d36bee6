"""Web pages as evidence: title and main text, from a tree of the page's elements with the density of text by node."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions._columns import Text, col
from ..functions.text import html_title

# Elements without text of the page, elements whose inside is no markup, elements without an end, elements
# that are lines of their own, elements that hold others, and classes or ids of what stands beside the content.
DROPPED = frozenset("head nav header footer aside form button select noscript template svg iframe".split())
RAW = frozenset("script style title textarea noscript template iframe svg".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("p div section article main body html h1 h2 h3 h4 h5 h6 ul ol li table thead tbody tfoot tr caption blockquote pre br hr dl dt dd figure figcaption".split())
CONTAINERS = frozenset("html body main article section div".split())
MARKS = frozenset("ad ads advert sidebar cookie comment comments menu footer banner".split())
# An element of the key ends an open element of the values.
ENDS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("td", "th", "tr"), "td": ("td", "th"), "th": ("td", "th")}

TAG = re.compile(r"<(/?)([a-zA-Z][^\s/<>]*+)((?>[^<>\"']+|\"[^\"]*+\"|'[^']*+')*+)>")
NAMED = re.compile(r"(?i)(?<![\w-])(?:class|id)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")

#: A node is left for a child that holds SHARE of its text, where the rest has at most THIN of the child's density.
SHARE, THIN = 0.6, 0.5
#: A block or list with more of its characters in links than this is a menu.
LINKED = 0.5


def _parts(html: str) -> Iterator[tuple[str, str, str]]:
    """(kind, name, rest): pieces of text, starts and ends of elements; one pass, whatever is left open."""
    at, n = 0, len(html)
    while at < n:
        low = html.find("<", at)
        low = n if low < 0 else low
        if low > at:
            yield "text", "", html[at:low]
        if low == n:
            return
        if html.startswith("<!--", low):
            end = html.find("-->", low + 4)
            at = n if end < 0 else end + 3
        elif html.startswith(("<!", "<?"), low):
            end = html.find(">", low)
            at = n if end < 0 else end + 1
        elif (m := TAG.match(html, low)) is None:
            yield "text", "", "<"
            at = low + 1
        else:
            at, name = m.end(), m[2].lower()
            if m[1]:
                yield "end", name, ""
            elif name in RAW:
                close = re.compile(rf"(?i)</{name}(?![\w-])[^>]*+>?").search(html, at)
                at = close.end() if close else n
            else:
                yield "start", name, m[3]


class _Page:
    """Nodes with their parents before them; what each holds itself, and lines of text with the node they lie in."""

    def __init__(self, html: str):
        self.name, self.parent, self.void = ["html"], [0], [False]
        self.lines: list[tuple[int, str, int]] = []
        self.stack, self.open = [0], Counter(["html"])
        self.piece: list[str] = []
        self.linked = 0
        for kind, name, rest in _parts(html):
            if kind == "text":
                if not self.void[self.stack[-1]]:
                    text = unescape(rest)
                    self.piece.append(text)
                    self.linked += bool(self.open["a"]) * len(text.strip())
            elif kind == "start":
                self._start(name, rest)
            elif self.open[name]:
                self._close(name)
        self._line()

    def _start(self, name: str, rest: str) -> None:
        for old in ENDS.get(name, ()):
            if self.name[self.stack[-1]] == old:
                self._close(old)
        if name in BLOCKS:
            if self.name[self.stack[-1]] == "p":
                self._close("p")
            self._line()
        elif name in ("td", "th") and "".join(self.piece).strip():
            self.piece.append(" | ")
        top = self.stack[-1]
        self.name.append(name)
        self.parent.append(top)
        marked = any(w.lower() in MARKS for m in NAMED.finditer(rest) for w in (m[1] or m[2] or m[3] or "").split()) if name in CONTAINERS or name in ("ul", "ol", "table") else False
        self.void.append(self.void[top] or name in DROPPED or marked)
        if name not in VOID:
            self.stack.append(len(self.name) - 1)
            self.open[name] += 1

    def _close(self, name: str) -> None:
        while len(self.stack) > 1:
            old = self.name[self.stack[-1]]
            if old in BLOCKS:
                self._line()
            self.stack.pop()
            self.open[old] -= 1
            if old == name:
                return

    def _line(self) -> None:
        text = " ".join("".join(self.piece).split())
        if text:
            self.lines.append((self.stack[-1], text, self.linked))
        self.piece, self.linked = [], 0

    def text(self) -> str:
        """The lines below the content node without those of menus."""
        n = len(self.name)
        plain, linked, tags = [0] * n, [0] * n, [1] * n
        for node, text, links in self.lines:
            plain[node] += max(len(text) - links, 0)
            linked[node] += links
        best = [0] * n
        for i in range(n - 1, 0, -1):
            up = self.parent[i]
            plain[up] += plain[i]
            linked[up] += linked[i]
            tags[up] += tags[i]
        for i in range(1, n):
            up = self.parent[i]
            if self.name[i] in CONTAINERS and plain[i] and (not best[up] or plain[i] > plain[best[up]]):
                best[up] = i
        top = 0
        while child := best[top]:
            rest = (plain[top] - plain[child]) / max(tags[top] - tags[child], 1)
            if plain[child] < SHARE * plain[top] or rest > THIN * plain[child] / tags[child]:
                break
            top = child
        inside, menu = [False] * n, [False] * n
        inside[top] = True
        for i in range(top + 1, n):
            up = self.parent[i]
            inside[i] = inside[up]
            menu[i] = menu[up] or (linked[i] > LINKED * (linked[i] + plain[i]) and self.name[i] in BLOCKS)
        return "\n".join(text for node, text, _ in self.lines if inside[node] and not menu[node])


@F.pandas_udf(T.StringType())
def _main_text(html: pd.Series) -> pd.Series:
    return html.map(lambda h: None if h is None else _Page(h).text())


def main_text(html: Text) -> Column:
    """The text of the node that holds the content, a block a line, cells of a row with ` | `; null for null.

    Scripts, menus, headers, footers, sidebars, forms and comments go with all they hold, as do blocks that are mostly links.
    The content node is found from the top: as long as one container below holds most of the text and the rest is thin. All
    character references are resolved. A page is read once, memory is bounded by the longest page.
    """
    return _main_text(col(html))


def content(pages: DataFrame, keep: list[str], html: str = "html", url: str = "url", least: int = 50, most: int | None = None) -> DataFrame:
    """The columns `keep` with title, text and success: whether there are `least` characters. `most`: where a reader cuts."""
    rows = pages.select(*keep, html_title(html, url).alias("title"), main_text(html).alias("_t"))
    good = F.coalesce(F.length("_t") >= least, F.lit(False))
    cut = F.col("_t") if most is None else F.substring("_t", 1, most)
    return rows.select(*keep, "title", F.when(good, cut).otherwise("").alias("text"), good.alias("success"))


def accessible(status: Text, content_type: Text, url: Text) -> Column:
    """Whether a paper behind an address can be read, from the answer to a HEAD request; without an answer yes."""
    barred = col(status).isin(401, 403)
    page = col(content_type).contains("text/html") & ~col(url).contains("arxiv.org") & ~col(url).contains("openreview.net")
    return F.coalesce(~(barred | page), F.lit(True))
