"""Main text of pages: golden pages, odd markup, and time on hostile input."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from assay.sources import pages

LONG = "This paragraph says at some length what the article is about, so that it weighs more than a menu does."

GOLDEN = {
    "nested advert": (f'<body><div class="ad"><div><p>Buy</p></div><p>now</p></div><p>{LONG}</p></body>', LONG),
    "table": ("<body><p>Scores:</p><table><tr><th>Model<th>Score<tr><td>a<td>1</tr></table></body>", "Scores:\nModel | Score\na | 1"),
    "references": ("<p>a &amp; b &eacute; &#8212; &#x2014; &hellip; &copy;</p>", "a & b é — — … ©"),
    "menu by links": (f'<div><ul><li><a href="/">Home</a><li><a href="/x">Other pages</a></ul><p>{LONG}</p></div>', LONG),
    "content node": (f'<div id="w"><div><span>x</span><span>y</span><b>z</b></div><div><p>{LONG}</p><p>{LONG} Again.</p></div></div>', f"{LONG}\n{LONG} Again."),
    "even columns stay": (f"<div><div><p>{LONG}</p></div><div><p>{LONG} B</p></div></div>", f"{LONG}\n{LONG} B"),
    "unclosed paragraphs": ("<body><p>one<p>two<ul><li>three<li>four</ul>five", "one\ntwo\nthree\nfour\nfive"),
    "comment and script": ('<p>a<!-- <p>no</p> --> b</p><script>if (1 < 2) "<p>no</p>"</script><style>p > a {}</style><p>c</p>', "a b\nc"),
    "quoted brackets": ('<p title="1 > 0 < 2">kept</p>', "kept"),
    "less than": ("<p>1 < 2 and a<b</p>", "1 < 2 and a<b"),
    "open comment": ("<p>a</p><!-- rest <p>b</p>", "a"),
    "stray ends": ("</div></p><p>a</b></div></p>b", "a\nb"),
    "reader comments": (f'<article><p>{LONG}</p></article><div class="post comments"><div><p>I like it</p></div></div>', LONG),
    "link in text": ('<p>See the <a href="/">list</a> of all of the results.</p>', "See the list of all of the results."),
    "empty": ("", ""),
    "no markup": ("only text", "only text"),
}


@pytest.mark.parametrize("name", list(GOLDEN))
def test_golden(name):
    html, text = GOLDEN[name]
    assert pages._Page(html).text() == text


def test_as_a_column(spark):
    rows = spark.createDataFrame([(i, h) for i, (h, _) in enumerate(GOLDEN.values())] + [(99, None)], "id int, html string")
    got = {r["id"]: r["text"] for r in rows.select("id", pages.main_text("html").alias("text")).collect()}
    assert got == {i: t for i, (_, t) in enumerate(GOLDEN.values())} | {99: None}
    assert pages.content(rows.where("id = 99").withColumn("url", F.lit("http://a/b")), ["id"]).first()["success"] is False


@pytest.mark.parametrize("part", ["<a ", "<title>", "<!--", "<p>", "<div>", "</div>", '<a "', "<td>", "<", "&lt", "<li><ul>", "<script>", "<a '\"<b ", "</a"])
def test_a_megabyte_takes_linear_time(part):
    html = part * (1_000_000 // len(part))
    begin = time.perf_counter()
    pages._Page(html).text()
    assert time.perf_counter() - begin < 8
