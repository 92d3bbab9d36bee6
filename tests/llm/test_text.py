from __future__ import annotations

import random
import zlib

import numpy as np
import pytest

from assay.llm import compression_toxicity, mixture_langid, tagpath, token_attribution, warc

PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var a="</p><p>no";</script></head>
<body class="page"><header><h2>Site</h2></header><nav><ul><li><a href="/a">One</a></li><li><a href="/b">Two</a></li></ul></nav>
<div class="cookie-notice"><p>We use cookies, all of them, and we tell you so at some length.</p></div>
<main><article><h1>The  title</h1><p>First paragraph, with a comma &amp; an <b>inline</b>
tag. It goes on for a while, so that it has some length.</p><p>Second one.<p>Third, unclosed, and <a href="x">a link</a> in it.
<ul><li>item one, text</li><li>item two</ul><blockquote><p>Quoted words, said by someone.</p></blockquote>
<aside>Related things</aside><form><p>Your name</p></form></article>
<section id="comments"><article class="comment"><p>I disagree, strongly, with every word of this text.</p></article></section></main>
<div class="sidebar"><p>Popular, now, here.</p></div><footer><p>&copy; all rights, reserved.</p></footer></body></html>"""
WANT = ["The title", "First paragraph, with a comma & an inline tag. It goes on for a while, so that it has some length.", "Second one.", "Third, unclosed, and a link in it.", "item one, text", "item two", "Quoted words, said by someone."]


def test_main_text():
    assert tagpath.main_text(PAGE).split("\n") == WANT
    plain = PAGE.replace("<main><article>", "<div class='content'>").replace("</article>\n<section id", "</div>\n<section id").replace("</section></main>", "</section>")
    assert tagpath.main_text(plain).split("\n") == WANT


@pytest.mark.parametrize("page", [None, "", "   ", "<", "<p", "no tags at all", "</div></p>", "<p>a<div>b</p>c</div>", "<!-- only -->", "<script>never closed", "<p title='a>b'>x</p>"])
def test_odd_pages(page):
    assert isinstance(tagpath.main_text(page), str)


def test_extract_keeps_rows(spark):
    rows = [(1, "u", PAGE, "clash"), (1, "u", PAGE, "clash"), (2, None, None, None), (3, "v", "<p>x &lt; y</p>", None)]
    out = tagpath.extract(spark.createDataFrame(rows, "page_id long, url string, html string, text string"), ["page_id", "url", "text"]).collect()
    got = {r["page_id"]: (r["text"], r["n_chars"]) for r in out}
    assert len(out) == 4
    assert got[2] == ("", 0)
    assert got[3] == ("x < y", 5)
    assert got[1][1] == len("\n".join(WANT))


def test_warc_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://x.org/é?a=1", PAGE), (2, None, None), (3, "http://y", "<p>b</p>")], "page_id long, url string, html string")
    made = warc.derive(warc.responses(pages, ["page_id"]), ["page_id"])
    rows = made.collect()
    assert len(rows) == 6
    by = {(r["page_id"], r["headers"]["WARC-Type"]): r for r in rows}
    for r in rows:
        h, other = r["headers"], {"metadata": "conversion", "conversion": "metadata"}[r["headers"]["WARC-Type"]]
        assert h["WARC-Block-Digest"] == warc.digest(bytes(r["block"]))
        assert int(h["Content-Length"]) == len(r["block"])
        assert h["X-Linked-Record"] == by[r["page_id"], other]["headers"]["WARC-Record-ID"]
        assert h["WARC-Refers-To"] == by[r["page_id"], other]["headers"]["WARC-Refers-To"]
    assert by[1, "conversion"]["headers"]["X-Source-Payload-Digest"] == warc.digest(PAGE.encode())
    assert "First paragraph, with a comma & an inline tag." in bytes(by[1, "conversion"]["block"]).decode()
    assert '"title": "T & t"' in bytes(by[1, "metadata"]["block"]).decode()
    warc.write_warc(made, str(tmp_path / "out"))
    back = {(r["headers"]["WARC-Record-ID"]): (r["headers"], bytes(r["block"])) for r in warc.read_warc(spark, str(tmp_path / "out")).collect()}
    assert back == {r["headers"]["WARC-Record-ID"]: (r["headers"], bytes(r["block"])) for r in rows}
    assert warc.derive(warc.read_warc(spark, str(tmp_path / "out")), []).count() == 0


def brute_attribution(ends, bounds, rule):
    out, cross, begin = [0.0] * len(bounds), 0, 0
    section = lambda p: next(i for i, b in enumerate(bounds) if p < b)
    for e in ends:
        own = [section(p) for p in range(begin, e)]
        cross += len(set(own)) > 1
        if rule == "start":
            out[own[0]] += 1
        elif rule == "majority":
            out[max(sorted(set(own)), key=own.count)] += 1
        else:
            for s in own:
                out[s] += 1 / len(own)
        begin = e
    return out, cross


@pytest.mark.parametrize("rule", token_attribution.RULES)
def test_attribution_equals_brute_force(rule):
    rng = random.Random(2)
    for _ in range(200):
        n = rng.randint(1, 40)
        ends = np.array(sorted({*rng.sample(range(1, n + 1), rng.randint(1, n)), n}))
        bounds = np.array(sorted({*rng.sample(range(1, n + 1), rng.randint(1, n)), n}))
        got, cross = token_attribution.attribute(ends, bounds, rule)
        want, want_cross = brute_attribution(ends.tolist(), bounds.tolist(), rule)
        assert got == pytest.approx(want)
        assert cross == want_cross


def test_token_counts(spark):
    texts = ["Hello world\nthis is é\n\nend", "", None, "one line", "<|endoftext|> x", "\n\n\n"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    encoding, size = token_attribution.encoder(*token_attribution.vocabulary())
    for r in token_attribution.count_tokens(docs, ["doc_id"]).collect():
        t = texts[r["doc_id"]] or ""
        ids = encoding.encode_ordinary(t)
        assert encoding.decode(ids) == t
        assert r["n_tokens"] == len(ids) == sum(r["section_tokens"])
        assert size[ids].sum() == len(t.encode())
        want, cross = brute_attribution(np.cumsum(size[ids]).tolist(), token_attribution.lines(t).tolist(), "start") if t else ([0.0], 0)
        assert (r["section_tokens"], r["n_crossing"]) == (want, cross)
    both = token_attribution.count_field_tokens(spark.createDataFrame([(1, "ab cd", None, "x")], "k long, a string, b string, c string"), ["k"], ["a", "b", "c"]).first()
    assert len(both["section_tokens"]) == 3
    assert sum(both["section_tokens"]) == both["n_tokens"]


def invented(rng, syllables, n):
    return " ".join("".join(rng.choices(syllables, k=rng.randint(1, 3))) for _ in range(n))


def test_language_mixtures(spark):
    rng = random.Random(3)
    kinds = {"xx": ["ba", "bo", "ku", "ri"], "yy": ["the", "ing", "st", "er"], "zz": ["é", "oi", "aux", "ch"]}
    rows = [(i, invented(rng, kinds[k], 60), k) for i, k in enumerate(["xx", "yy", "zz"] * 40)]
    docs = spark.createDataFrame([*rows, (900, None, "xx"), (901, "12 !", "yy"), (902, "words", None)], "doc_id long, text string, lang string")
    learn, held = mixture_langid.learnable("doc_id", 4, 2)
    assert {r["doc_id"] for r in docs.where(held).collect()} == {d for d in [*range(120), 900, 901, 902] if zlib.crc32(str(d).encode()) % 4 == 2}
    model = mixture_langid.fit(docs.where(learn))
    mixed = invented(rng, kinds["xx"], 70) + " " + invented(rng, kinds["zz"], 30)
    test = spark.createDataFrame([(0, mixed, 1.0), (1, rows[1][1], 1.0), (2, None, 1.0), (3, "12 !", 1.0), (1, rows[1][1], 1.0)], "doc_id long, text string, score double").select("doc_id", "text")
    got = {r["doc_id"]: r for r in mixture_langid.identify(test, model, ["doc_id"], proportions=True).collect()}
    assert got[0]["lang_pred"] == "xx"
    assert set(got[0]["mixture"]) == {"xx", "zz"}
    assert abs(got[0]["mixture"]["xx"] - 0.7) < 0.08
    assert (got[1]["lang_pred"], got[1]["score"]) == ("yy", 1.0)
    assert {(got[d]["lang_pred"], got[d]["score"]) for d in (2, 3)} == {("und", 0.0)}
    right = mixture_langid.identify(docs.where(held).where("doc_id < 900"), model, ["doc_id", "lang"]).collect()
    assert all(r["lang"] == r["lang_pred"] for r in right)
    none = mixture_langid.fit(docs.limit(0))
    assert {r["lang_pred"] for r in mixture_langid.identify(test, none, ["doc_id"]).collect()} == {"und"}


def test_toxicity_on_held_out_rows(spark):
    rng = random.Random(4)
    plain = ["ba", "bo", "ku", "ri", "the", "ing", "st", "er"]
    rows, labels = [], []
    for i in range(600):
        t, bad = invented(rng, plain, 60).split(), i % 4 == 0
        for _ in range(3 * bad):
            t[rng.randrange(60)] = rng.choice(["nastyword", "vilething", "grimslur"]) + rng.choice(["", "s", "er"])
        rows.append((i, " ".join(t)))
        labels.append((i, int(bad)))
    docs = spark.createDataFrame([*rows, (1000, None), (1001, "")], "doc_id long, text string")
    lab = spark.createDataFrame([*labels, (1000, 1), (5000, None)], "doc_id long, toxic int")
    learn, held = mixture_langid.learnable("doc_id", 5, 0)
    model = compression_toxicity.fit(compression_toxicity.labelled(docs, lab.where(learn)))
    got = {r["doc_id"]: r["score"] for r in compression_toxicity.score(docs, model, ["doc_id"]).collect()}
    out = [i for i in range(600) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum((got[i] >= 0.5) == (i % 4 == 0) for i in out) >= 0.95 * len(out)
    assert got[1000] == got[1001] < 0.5
    assert all(0 <= s <= 1 for s in got.values())
    empty = compression_toxicity.fit(compression_toxicity.labelled(docs, lab.limit(0)))
    assert max(r["score"] for r in compression_toxicity.score(docs, empty, ["doc_id"]).collect()) < 1e-6
