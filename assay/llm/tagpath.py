"""Main text of HTML pages by tag-path ratios (operator 10).

A page becomes the sequence of its text blocks, each with its root-to-leaf path of block tags. Per path, text length and
punctuation are summed and divided by the number of blocks with that path, and both are multiplied by their spread, so that
paths of running text stand out from lists of labels. Values are put back on the block sequence, smoothed, fused into one
value a path, and cut at a share of their standard deviation: paths above the cut are content paths, and their blocks are
content nodes. The smallest container that holds (nearly) all content nodes is the article. Blocks of the other paths in it
are the article's too (headings, short lines, cells), unless their path is one of links or they stand in a part of the page
that is marked as something else: menus, page headers, footers, sidebars, notices, adverts, forms, comments.

An element is marked by its name or by a class, id or role. A token such as `cookie-notice` marks it if one of its words
says what the element is and the others only name a place or a shape; `related-work` or `ad-free` do not. A `header` inside
an article is the article's own and stays.

Parsing takes time in proportion to the page: unclosed tags and quotes are looked for once, paths are numbered, and what an
element inherits is copied from its parent, so no step walks to the root.

Defined results: null or empty html gives the empty text; an empty table an empty result; a column named like an output is
replaced. Unclosed and crossing tags are closed as browsers do; a `<` that no `>` follows is text. Pages are judged one by
one, so repeated rows get equal results, and memory is bounded by the longest page.
"""

from __future__ import annotations

import html as references
import math
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Element names by their part in a page.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "br", "wbr", "img", "math", "mi", "mn", "mo", "mrow", "msub", "msup", "msubsup", "mfrac", "msqrt", "mroot", "mtext", "mspace", "mstyle", "munder", "mover", "semantics"}
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "select", "annotation", "xmp"}
APART = {"nav", "header", "footer", "aside", "form", "button", "dialog", "menu", "fieldset", "head"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
CLOSES_P = {"address", "article", "aside", "blockquote", "details", "div", "dl", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "main", "menu", "nav", "ol", "p", "pre", "section", "table", "ul"}
CONTAINERS = {"html", "body", "main", "article", "section", "div", "td", "table", "tbody", "tr", "center"}
# Elements that a new element of the same kind closes, the kind, and the elements beyond which it does not look.
KINDS = {"p": "p", "li": "li", "dt": "dd", "dd": "dd", "tr": "tr", "td": "td", "th": "td", "option": "option"}
BARRIERS = {"p": CONTAINERS | {"ul", "ol", "li"}, "li": {"ul", "ol", "menu"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "option": {"select"}}
# Words of class, id and role that say what an element is, and words that only name a place or a shape.
MARKS = {"ad", "ads", "advert", "adverts", "advertisement", "advertisements", "alert", "banner", "breadcrumb", "breadcrumbs", "comment", "comments", "complementary", "consent", "contentinfo", "cookie", "cookies", "dialog", "disqus", "footer", "gdpr", "header", "login", "masthead", "menu", "menubar", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "outbrain", "overlay", "pager", "pagination", "popup", "promo", "promotion", "recommended", "related", "replies", "reply", "respond", "search", "share", "sharing", "sidebar", "signin", "signup", "skip", "social", "sponsor", "sponsored", "subscribe", "subscription", "taboola", "toolbar", "widget"}
PLACES = {"bar", "big", "block", "bottom", "box", "button", "buttons", "center", "column", "container", "content", "cta", "desktop", "form", "global", "group", "icons", "inner", "item", "items", "left", "link", "links", "list", "main", "mobile", "outer", "page", "panel", "posts", "primary", "right", "row", "secondary", "section", "side", "site", "slot", "small", "sticky", "stories", "text", "thread", "top", "unit", "wrap", "wrapper", "area", "articles", "body"}

OPEN = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
STOP = re.compile(r"[\"'>]")
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
PUNCTUATION = re.compile(r"[.,;:!?…、。，！？]")
HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")
WORDS = re.compile(r"[a-z]+|[0-9]+")


class Node:
    """An element. What its position implies is copied from its parent: `near` has the innermost open element of each kind
    that a new one would close, `place` the number of its path."""

    __slots__ = ("tag", "place", "parent", "apart", "depth", "heading", "inside", "near", "number")

    def __init__(self, tag: str, parent: Node | None, place: int, apart: bool, number: int):
        self.tag, self.parent, self.place, self.apart, self.number = tag, parent, place, apart, number
        self.depth = parent.depth + 1 if parent else 0
        self.heading = bool(parent and parent.heading) or tag in HEADINGS
        self.inside = bool(parent and parent.inside) or tag in ("article", "main")
        near = parent.near if parent else {}
        closed = [k for k, limits in BARRIERS.items() if tag in limits and near.get(k) is not None]
        kind = KINDS.get(tag)
        if closed or kind:
            near = {k: v for k, v in near.items() if k not in closed}
            if kind:
                near[kind] = self
        self.near = near


class Block:
    __slots__ = ("node", "text", "linked", "heading")

    def __init__(self, node: Node, text: str, linked: int):
        self.node, self.text, self.linked, self.heading = node, text, linked, node.heading


def marked(value: str) -> bool:
    """Whether a class, id or role has a token that says that the element is something other than content."""
    for token in value.split():
        words = WORDS.findall(token)
        if any(w in MARKS for w in words) and all(w in MARKS or w in PLACES or w.isdigit() for w in words):
            return True
    return False


def _look(attributes: str) -> tuple[str, bool]:
    """(label for the path, whether the attributes mark something other than content)."""
    label, apart = "", False
    for m in ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if name == "hidden" or name == "aria-hidden" and value == "true" or name == "style" and HIDDEN.search(value):
            apart = True
        elif name in ("class", "id", "role"):
            apart |= marked(value)
            label += f".{value.split()[0]}" if value.split() else ""
    return label, apart


class Scanner:
    """(kind, name or text, attributes) of the pieces of a page in order; kinds are text, open, close, and raw, which is the
    content of an element that holds no tags.

    Every search goes forward from where the last one of its kind ended, so a page is read a bounded number of times.
    """

    def __init__(self, page: str):
        self.page = page
        self.last = page.rfind(">")
        self.found: dict[str, tuple[int, int]] = {}

    def find(self, what: str, at: int) -> int:
        """page.find(what, at); a search that an earlier one has answered is not repeated."""
        begin, end = self.found.get(what, (1, 0))
        if begin <= at and (at <= end or end < 0):
            return end
        end = self.page.find(what, at)
        self.found[what] = at, end
        return end

    def tag_end(self, at: int) -> int:
        """The position of the `>` that ends the tag, quoted values aside; -1 if there is none."""
        first = -1
        while m := STOP.search(self.page, at):
            if m[0] == ">":
                return m.start()
            close = self.find(m[0], m.end())
            if close < 0:
                # a quote that nothing closes is an ordinary character
                at = m.end()
                end = self.find(">", at)
                return end
            if first < 0:
                first = m.end()
            at = close + 1
            if at > self.last:
                # the tag would run to the end of the page: its quotes do not pair, the first > ends it
                return self.find(">", first)
        return -1

    def pieces(self) -> Iterator[tuple[str, str, str]]:
        page, at, n = self.page, 0, len(self.page)
        while at < n:
            lt = self.find("<", at)
            if lt < 0 or lt > self.last:
                yield "text", page[at:], ""
                return
            if lt > at:
                yield "text", page[at:lt], ""
            if page.startswith("<!--", lt):
                end = self.find("-->", lt + 4)
                at = end + 3 if end >= 0 else n
            elif page.startswith("<![CDATA[", lt):
                end = self.find("]]>", lt)
                at = end + 3 if end >= 0 else n
            elif page[lt + 1 : lt + 2] in ("!", "?"):
                at = self.find(">", lt) + 1
            elif m := OPEN.match(page, lt):
                end = self.tag_end(m.end())
                if end < 0:
                    yield "text", "<", ""
                    at = lt + 1
                    continue
                name, at = m[2].lower(), end + 1
                attributes = page[m.end() : end]
                yield ("close" if m[1] else "open"), name, attributes
                if not m[1] and name in RAW and not attributes.rstrip().endswith("/"):
                    close = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(page, at)
                    if close:
                        yield "raw", name, page[at : close.start()]
                    # what no end tag closes runs to the end of the page
                    at = (self.find(">", close.end()) + 1 or n) if close else n
            else:
                yield "text", "<", ""
                at = lt + 1


def blocks(page: str, pieces: Iterable[tuple[str, str, str]] | None = None) -> list[Block]:
    """The text blocks of a page in order, those of other parts than content included. pieces: what a scanner found in it."""
    paths: dict[tuple[int, str], int] = {}
    root = node = Node("#root", None, 0, False, 0)
    out, parts, linked, link, made = [], [], 0, 0, 1
    stack, opened = [root], defaultdict(int)

    def flush() -> None:
        nonlocal parts, linked
        if parts:
            text = " ".join(references.unescape("".join(parts)).split())
            if text:
                out.append(Block(node, text, linked))
        parts, linked = [], 0

    def leave(last: Node) -> None:
        """Closes the open elements down to `last` and itself."""
        while True:
            gone = stack.pop()
            opened[gone.tag] -= 1
            if gone is last:
                return

    for kind, name, attributes in Scanner(page).pieces() if pieces is None else pieces:
        if kind == "text":
            parts.append(name)
            if link:
                linked += len(name.strip())
        elif name in RAW:
            continue
        elif name in INLINE:
            if name == "a":
                link = int(kind == "open")
            elif name == "br":
                parts.append(" ")
        else:
            flush()
            link = 0
            if kind == "close":
                if opened[name] > 0:
                    last = next(x for x in reversed(stack) if x.tag == name)
                    leave(last)
                    node = stack[-1]
                continue
            if name in VOID:
                if name in CLOSES_P and node.near.get("p"):
                    leave(node.near["p"])
                    node = stack[-1]
                continue
            if name in CLOSES_P and node.near.get("p"):
                leave(node.near["p"])
                node = stack[-1]
            if name in KINDS and name != "p" and node.near.get(KINDS[name]):
                leave(node.near[KINDS[name]])
                node = stack[-1]
            label, apart = _look(attributes) if attributes else ("", False)
            own = apart or name in APART and not (name == "header" and node.inside)
            if name in ("html", "body", "main") or name == "article" and not node.inside:
                own = False
            node = Node(name, node, paths.setdefault((node.place, name + label), len(paths) + 1), node.apart or own, made)
            made += 1
            stack.append(node)
            opened[name] += 1
    flush()
    return out


def path_values(found: list[Block]) -> dict[int, float]:
    """The fused ratio of each path: length and punctuation a block, each raised by its spread over the path's blocks."""
    groups: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for b in found:
        if not b.node.apart:
            groups[b.node.place].append((max(0, len(b.text) - b.linked), len(PUNCTUATION.findall(b.text)) if 2 * b.linked < len(b.text) else 0))
    out: dict[int, float] = {}
    for place, values in groups.items():
        n = len(values)
        length, marks = sum(v[0] for v in values) / n, sum(v[1] for v in values) / n
        spread = lambda k, mean: math.sqrt(sum((v[k] - mean) ** 2 for v in values) / n)  # noqa: B023, E731
        out[place] = math.log1p(length * (1 + spread(0, length))) * (0.2 + math.log1p(marks * (1 + spread(1, marks))))
    return out


def content_paths(found: list[Block], radius: int = 1) -> set[int]:
    """The paths whose smoothed value reaches the cut.

    Values are smoothed along the page by a Gaussian, a block never below its own value, and averaged over the blocks of a
    path. The cut is the standard deviation of the smoothed values, at most 0.8 of the largest.
    """
    live = [b for b in found if not b.node.apart]
    if not live:
        return set()
    own = path_values(found)
    raw = [own[b.node.place] for b in live]
    smooth = []
    for i in range(len(raw)):
        near = [(raw[j], math.exp(-((i - j) ** 2) / 2)) for j in range(max(0, i - radius), min(len(raw), i + radius + 1))]
        smooth.append(max(raw[i], sum(v * w for v, w in near) / sum(w for _, w in near)))
    mean = sum(smooth) / len(smooth)
    cut = min(math.sqrt(sum((s - mean) ** 2 for s in smooth) / len(smooth)), 0.8 * max(smooth))
    totals: dict[int, list[float]] = defaultdict(list)
    for b, s in zip(live, smooth, strict=True):
        totals[b.node.place].append(s)
    return {place for place, values in totals.items() if (v := sum(values) / len(values)) > 0 and v >= cut}


def main_blocks(page: str) -> list[str]:
    found = blocks(page)
    chosen = content_paths(found)
    live = [b for b in found if not b.node.apart]
    # all elements with text below them, parents before children
    nodes: dict[int, Node] = {}
    for b in live:
        at = b.node
        while at is not None and at.number not in nodes:
            nodes[at.number] = at
            at = at.parent
    mass: dict[int, int] = defaultdict(int)
    for b in live:
        if b.node.place in chosen:
            mass[b.node.number] += len(b.text)
    total = sum(mass.values())
    if not total:
        return [b.text for b in live]
    order = sorted(nodes)
    for number in reversed(order):
        if nodes[number].parent is not None:
            mass[nodes[number].parent.number] += mass[number]
    best = None
    for number in order:
        node = nodes[number]
        enough = 0.5 if node.tag in ("article", "main") else 0.98
        if node.tag in CONTAINERS and mass[number] >= enough * total and (best is None or node.depth > best.depth):
            best = node
    inside: dict[int, bool] = {}
    for number in order:
        parent = nodes[number].parent
        inside[number] = best is None or nodes[number] is best or parent is not None and inside[parent.number]
    return [b.text for b in live if inside[b.node.number] and (b.node.place in chosen or 2 * b.linked <= len(b.text))]


def main_text(page: str | None) -> str:
    return "\n".join(main_blocks(page)) if page else ""


def extract(pages: DataFrame, keep: list[str], html: str = "html") -> DataFrame:
    """The columns `keep` of pages, the main text, and n_chars, its code points. One pass, no shuffle."""
    keep = [c for c in keep if c not in ("text", "n_chars")]
    source = pages.select(*keep, F.col(html).alias("__html"))
    schema = pages.select(*keep).schema.add("text", "string").add("n_chars", "long")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 500):
                part = batch.slice(k, 500)
                texts = [main_text(p.as_py()) for p in part.column("__html")]
                yield pa.RecordBatch.from_arrays([*part.select(keep).columns, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*keep, "text", "n_chars"])

    return source.mapInArrow(run, schema)
