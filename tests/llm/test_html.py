"""Main text: golden pages, an independent reading of the path ratios, and time in proportion to the page."""

from __future__ import annotations

import math
import time
from html.parser import HTMLParser

import pytest

from assay.llm import tagpath

LONG = "A sentence, with a comma, that runs on for a while; then it stops. "
GOLDEN = [
    # an article's own header, a formula, words that only look like marks
    (f"<body><header><h1>Site</h1></header><article><header><h1>Own title</h1></header><p>{LONG}Energy <math><mi>E</mi>=<mi>m</mi></math> is.</p><div class='related-work'><p>Related work, as others say, is cited.</p></div><div class='post ad-free'><p>{LONG}</p></div></article></body>", ["Own title", f"{LONG}Energy E=m is.", "Related work, as others say, is cited.", LONG.strip()]),
    # no article element: the container of the running text
    (f"<div id='page'><div class='top-nav'><a href=1>one</a> <a href=2>two</a></div><div class='story'><h2>Head</h2><p>{LONG}</p><p>{LONG}{LONG}</p><table><tr><td>a</td><td>1</td></tr></table></div><div class='side-bar widget'><p>{LONG}</p></div><div class='site-footer'>{LONG}</div></div>", ["Head", LONG.strip(), (LONG + LONG).strip(), "a", "1"]),
    # notices, adverts, forms, comments, hidden parts
    (f"<main><p>{LONG}</p><div class='cookie-notice'>{LONG}</div><div id=ad-slot-3>{LONG}</div><form><label>{LONG}</label></form><div style='display:none'>{LONG}</div><p>Short.</p></main><div class=comment-list><p>{LONG}</p></div><div role=complementary>{LONG}</div>", [LONG.strip(), "Short."]),
    # lists of links go, single links stay
    (f"<article><p>{LONG} <a href=x>link</a></p><ul><li><a href=1>First link here</a></li><li><a href=2>Second link here</a></li></ul><ol><li>Step, one.</li><li>Step, two.</li></ol></article>", [f"{LONG} link".replace("  ", " "), "Step, one.", "Step, two."]),
    # references, white space, line breaks, preformatted text
    (f"<article><p>&lt;b&gt; &amp;amp; &#233;&nbsp;x<br>y\n\t z</p><p>{LONG}</p><pre>a  b\nc</pre></article>", ["<b> &amp; é x y z", LONG.strip(), "a b c"]),
    ("<p>x < y and a <b>b</b> > c</p>", ["x < y and a b > c"]),
    ("<p>one<p>two<li>three<script>var a='</p>';</script><p>four", ["one", "two", "three", "four"]),
]


@pytest.mark.parametrize(("page", "want"), GOLDEN)
def test_golden_pages(page, want):
    assert tagpath.main_text(page).split("\n") == want


class Plain(HTMLParser):
    """Blocks with their paths by the standard library, for well-formed pages of div, p, ul, li."""

    def __init__(self):
        super().__init__()
        self.stack, self.out, self.parts = [], [], []

    def flush(self):
        text = " ".join("".join(self.parts).split())
        if text:
            self.out.append(("/".join(self.stack), text))
        self.parts = []

    def handle_starttag(self, tag, attrs):
        self.flush()
        self.stack.append(tag + "".join(f".{v}" for _, v in attrs))

    def handle_endtag(self, tag):
        self.flush()
        self.stack.pop()

    def handle_data(self, data):
        self.parts.append(data)


def test_paths_and_values_equal_brute_force():
    body = "".join(f"<div class=c{i % 3}><p>{'Words, and more. ' * (i * 7 % 5 + 1)}</p><ul><li>label {i}</li><li>{'x ' * i}.</li></ul></div>" for i in range(12))
    plain = Plain()
    plain.feed(f"<body>{body}</body>")
    found = tagpath.blocks(f"<body>{body}</body>")
    assert [t for _, t in plain.out] == [b.text for b in found]
    numbers = {}
    for (path, _), b in zip(plain.out, found, strict=True):
        assert numbers.setdefault(path, b.node.place) == b.node.place
    assert len(set(numbers.values())) == len(numbers)
    want = {}
    for path in numbers:
        lengths = [len(t) for p, t in plain.out if p == path]
        marks = [sum(t.count(c) for c in ".,;:!?") for p, t in plain.out if p == path]
        mean = lambda v: sum(v) / len(v)
        sd = lambda v: math.sqrt(mean([(x - mean(v)) ** 2 for x in v]))  # noqa: B023, E731
        want[numbers[path]] = math.log1p(mean(lengths) * (1 + sd(lengths))) * (0.2 + math.log1p(mean(marks) * (1 + sd(marks))))
    assert tagpath.path_values(found) == pytest.approx(want)
    assert tagpath.content_paths(found) >= {numbers[p] for p in numbers if p.endswith("/p")}


MEGABYTE = 1_000_000
SLOW = {
    "open tags without end": "<p>hello</p>" + "<a " * (MEGABYTE // 3),
    "nested elements": "<div>" * 50_000 + "x",
    "nested elements with text": "<div>x" * 50_000,
    "items in nested quotes": "<blockquote>" * 30_000 + "<li>x" * 30_000,
    "end tags without start": "<div>" * 30_000 + "</section>" * 50_000,
    "odd quotes": "<a '> " + '<b "x>' * 150_000,
    "quotes without end": '<a "' * 250_000 + ">",
    "comments without end": "<!--" * 200_000 + ">",
    "raw elements without end": "<script>" * 100_000,
    "signs": "<" * 500_000 + ">",
}


@pytest.mark.parametrize("name", SLOW)
def test_time_is_in_proportion_to_the_page(name):
    began = time.process_time()
    tagpath.main_text(SLOW[name])
    assert time.process_time() - began < 8  # a quadratic parser takes minutes


def test_empty_table_and_clashing_names(spark):
    pages = spark.createDataFrame([(1, None, None, "t", 5), (2, "u", "", "t", 5), (2, "u", "", "t", 5)], "page_id long, url string, html string, text string, n_chars int")
    assert tagpath.extract(pages.limit(0), ["page_id", "url"]).count() == 0
    out = tagpath.extract(pages, ["page_id", "url", "text", "n_chars"])
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    assert {(r["page_id"], r["text"], r["n_chars"]) for r in out.collect()} == {(1, "", 0), (2, "", 0)}
