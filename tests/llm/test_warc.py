from __future__ import annotations

import gzip
import json
import time
from pathlib import Path

import pyarrow.parquet as pq
import pytest

from assay.llm import warc

PAGE = "<html><head><title>A é</title></head><body><p>Text, é.</p><a href='/x?a=1&amp;b=2'>l</a></body></html>"


def record(headers, block, version="1.0"):
    lines = "".join(f"{k}: {v}\r\n" for k, v in [*headers, ("Content-Length", len(block))])
    return f"WARC/{version}\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def response(url, body, *http):
    head = "HTTP/1.1 200 OK\r\n" + "".join(f"{k}: {v}\r\n" for k, v in http) + "\r\n"
    return [("WARC-Type", "response"), ("WARC-Record-ID", f"<urn:{url}>"), ("WARC-Target-URI", url)], head.encode() + body


def chunked(body, n=7):
    return b"".join(b"%x;x=y\r\n%s\r\n" % (len(body[i : i + n]), body[i : i + n]) for i in range(0, len(body), n)) + b"0\r\n\r\n"


BODIES = [
    ("plain", PAGE.encode(), [("Set-Cookie", "a=1"), ("Set-Cookie", "b=2")]),
    ("gzip", gzip.compress(PAGE.encode()), [("Content-Encoding", "gzip")]),
    ("both", chunked(gzip.compress(PAGE.encode())), [("content-encoding", "GZIP"), ("Transfer-Encoding", "chunked")]),
    ("latin", PAGE.encode("latin-1"), [("Content-Type", "text/html; charset=ISO-8859-1")]),
]


@pytest.mark.parametrize(("name", "body", "http"), BODIES)
def test_bodies_are_decoded_and_headers_kept(name, body, http):
    headers, block = response(f"http://{name}", body, *http)
    (_, meta), (own, text) = warc.derivatives(dict(headers), block)
    about = json.loads(meta)
    assert text.decode() == "Text, é.\nl"
    assert about["title"] == "A é"
    assert about["http_headers"] == [list(x) for x in http]
    assert about["links"] == [{"element": "a", "url": "/x?a=1&b=2"}]
    assert about["payload_digest"] == own["X-Source-Payload-Digest"] == warc.digest(body)


def test_bodies_that_do_not_decode_stay():
    for http in ([("Content-Encoding", "gzip")], [("Transfer-Encoding", "chunked")], [("Content-Encoding", "br")]):
        assert warc.decoded(b"<p>x</p>", http) == b"<p>x</p>"


def files(spark, tmp_path, split):
    # records within a payload can be told from others only if one task has the file
    odd = (b"see WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nxyz and WARC/1.1\r\n" if split == "128m" else b"see WARC/1.0\r\nthere and WARC/1.1, 'WARC/1.0'\r\n") * 40
    made = [response("http://a", odd), response("http://b", bytes(range(256)) * 30), response("http://c", b""), response("http://d", PAGE.encode())]
    made[3][0].append(("WARC-Concurrent-To", "<urn:1>"))
    made[3][0].append(("WARC-Concurrent-To", "<urn:2>"))
    made[1][0].append(("X-Odd", "café"))
    data = b"".join(record(h, b, "1.0" if i % 2 else "1.1") for i, (h, b) in enumerate(made))
    data = data.replace("café".encode(), "café".encode("latin-1"))
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.warc").write_bytes(data)
    (tmp_path / "in" / "b.warc.gz").write_bytes(gzip.compress(data))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        return made, warc.read_warc(spark, str(tmp_path / "in")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


@pytest.mark.parametrize("split", ["128m", "700b"])
def test_records_are_framed_by_their_length(spark, tmp_path, split):
    made, got = files(spark, tmp_path, split)
    assert sorted(bytes(r["block"]) for r in got) == sorted(b for _, b in made for _ in range(2))
    assert all("X-Truncated" not in r["headers"] for r in got)
    by = {r["headers"]["WARC-Target-URI"]: r["headers"] for r in got}
    assert by["http://d"]["WARC-Concurrent-To"] == "<urn:1>\n<urn:2>"
    assert by["http://b"]["X-Odd"] == "café"


def test_responses_of_any_bytes_round_trip(spark, tmp_path):
    _, got = files(spark, tmp_path, "128m")
    df = spark.createDataFrame([(r["headers"], bytes(r["block"])) for r in got], warc.RESPONSE)
    warc.write_warc(df, str(tmp_path / "out"), "none")
    back = warc.read_warc(spark, str(tmp_path / "out")).collect()
    plain = lambda rows: sorted((sorted(r["headers"].items()), bytes(r["block"])) for r in rows)
    assert plain(back) == plain(got)


def test_a_cut_file_keeps_what_there_is(spark, tmp_path):
    data = record(*response("http://a", b"x" * 500))
    (tmp_path / "a.warc").write_bytes(b"junk before" + data + data[:300])
    got = sorted(warc.read_warc(spark, str(tmp_path)).collect(), key=lambda r: len(r["block"]))
    assert [r["headers"].get("X-Truncated") for r in got] == ["true", None]
    assert len(got[1]["block"]) > 500 > len(got[0]["block"]) > 0


def test_clashing_names_empty_table_and_long_page(spark):
    rows = [(1, "u", "<p>a</p>", "clash", "clash"), (2, "v", "<p>" + "word " * 400_000 + "</p>", None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, headers string, block string")
    keep = ["page_id", "headers", "block"]
    made = warc.derive(warc.responses(pages, keep), keep)
    assert made.columns == ["page_id", "headers", "block"]
    sizes = {(r["page_id"], r["headers"]["WARC-Type"]): len(r["block"]) for r in made.collect()}
    assert sizes[1, "conversion"] == 1
    assert sizes[2, "conversion"] == 5 * 400_000 - 1
    assert warc.derive(warc.responses(pages.limit(0), keep), keep).count() == 0


@pytest.mark.parametrize("unit", ["<a ", "<title>", "<meta ", "<a href=", "<a href=\"", "<a x='", "a=", "<p a", "<title></titl", "</a <a", "<!--", "<iframe src=x>"])
def test_hostile_pages_are_read_in_linear_time(unit):
    for tail in ("", ">", "</title>"):
        page = unit * (1_000_000 // len(unit)) + tail
        began = time.perf_counter()
        warc.title_and_links(page)
        assert time.perf_counter() - began < 10


@pytest.mark.parametrize("charset", ["undefined", "idna", "punycode", "unicode_escape", "no-such", "utf-7", "hex", "rot13", "x" * 500, "utf-16", "²"])
def test_odd_charsets_do_not_stop_a_job(charset):
    headers, block = response("http://x", b"<title>a+2AA-</title><p>b\xff\\x", ("Content-Type", f"text/html; charset={charset}"))
    (_, meta), (_, text) = warc.derivatives(dict(headers), block)
    assert json.loads(meta)["refers_to"] == "<urn:http://x>"
    text.decode()


@pytest.mark.parametrize("length", ["\u00b2", "9" * 5000, "-1", "+5", "1_0", "", " "])
def test_odd_lengths_are_none(length):
    found = warc._record(f"0\r\nWARC-Type: response\r\nContent-Length: {length}\r\n\r\nbody".encode())
    assert found is not None and found[2] == -1


def test_bodies_that_unpack_without_bound_are_taken_as_sent(monkeypatch):
    monkeypatch.setattr(warc, "MOST_DECODED", 1 << 20)
    bomb, fits = gzip.compress(b"<p>x" * 300_000), gzip.compress(b"<p>y</p>" * 1000)
    http = [("Content-Encoding", "gzip")]
    assert warc.decoded(bomb, http) == bomb
    assert warc.decoded(fits + fits, http) == b"<p>y</p>" * 2000
    assert warc.decoded(fits + b"junk", http) == b"<p>y</p>" * 1000
    assert warc.decoded(fits[:-20], http).startswith(b"<p>y</p>")


def test_links_of_all_elements_and_no_others():
    page = """<TITLE lang=en> A &amp;
 b</TITLE><!-- <a href=no> --><script src='s.js'>'<a href=no>'</script><area HREF="m?a=1&amp;b=2"><source src = v.mp4 ><object data=o></object><p data=no href>
<form action="/f"><video poster='p.png'></video><a title='href="no"' href=/x/y>t</a><a href="">e</a><title>second</title>"""
    title, links = warc.title_and_links(page)
    assert title == "A & b"
    assert [(x["element"], x["url"]) for x in links] == [("script", "s.js"), ("area", "m?a=1&b=2"), ("source", "v.mp4"), ("object", "o"), ("form", "/f"), ("video", "p.png"), ("a", "/x/y"), ("a", "")]


def test_derivatives_of_the_given_pages_equal_a_plain_parser():
    """Title and links against Python's own parser, page by page."""
    from html.parser import HTMLParser

    class Plain(HTMLParser):
        def __init__(self):
            super().__init__()
            self.links, self.title, self.inside = [], None, False

        def handle_starttag(self, tag, attrs):
            self.links += [(tag, v) for k, v in attrs if v is not None and (k in ("href", "src", "action", "poster") or (k, tag) == ("data", "object"))]
            if tag == "title" and self.title is None:
                self.inside, self.title = True, ""

        def handle_endtag(self, tag):
            self.inside &= tag != "title"

        def handle_data(self, data):
            if self.inside:
                self.title += data

    pages = pq.read_table("/root/testdata/sf0.001/pages.parquet", columns=["html"])["html"].to_pylist() if Path("/root/testdata/sf0.001/pages.parquet").exists() else [PAGE]
    for page in pages:
        plain = Plain()
        plain.feed(page or "")
        title, links = warc.title_and_links(page or "")
        assert title == (None if plain.title is None else " ".join(plain.title.split()))
        assert [(x["element"], x["url"]) for x in links] == plain.links
