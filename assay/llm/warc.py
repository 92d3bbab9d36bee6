"""WARC derivative builder (operator 5).

Every response record becomes two derivatives: a `metadata` record (JSON: title, links, the response's HTTP and WARC headers)
and a `conversion` record (the page's plain text). Both name the response in WARC-Refers-To, with its target URI and date, keep
its payload digest, and name each other in X-Linked-Record; each has its own block digest and a record id that follows from the
response's, so that a rerun yields the same records.

Records are made one by one in a single pass, without a shuffle. WARC files are read by Spark's text reader, which cuts them
before each version line; a record's Content-Length then says which pieces belong together, so a payload may hold a version
line. Pieces of a record that two tasks share are joined by file, and only those; where the shared part of such a payload is
itself made of whole records, it is read as these (compressed files are never shared). Files are written with the record
terminator as separator, so neither way needs a local path.

A header that occurs several times is one entry of `headers` whose values are separated by line feeds; it is written as
several lines again, and the metadata record lists HTTP headers as pairs in their order. Bodies are read as the client
would: chunked transfer coding and gzip or deflate content coding are undone for text and links; digests are those of the
body as it was sent. Bodies that do not decode, or that unpack to more than MOST_DECODED bytes, are taken as they are; an unknown
character set is read as UTF-8; a length that is no number of at most 18 digits is none. Links are the addresses in the tags of
all elements. A page is read a bounded number of times.

Defined results: null html or a response without a body gives an empty text and a metadata record without title and links;
a null url gives records without target URI; responses without a record id get one from their URI and payload; repeated rows
give repeated records with equal ids; an empty table gives none. Extra columns can be kept by name; those named `headers` or
`block` are replaced. A record whose end is missing keeps what there is, with `X-Truncated: true`; bytes that are no record
are left out.
"""

from __future__ import annotations

import base64
import codecs
import hashlib
import html as references
import json
import re
import uuid
import zlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import tagpath

VERSION = "WARC/1.0"
DATE = "1970-01-01T00:00:00Z"
SPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # the name space for URLs of RFC 4122
HEADERS = T.MapType(T.StringType(), T.StringType())
RESPONSE = T.StructType([T.StructField("headers", HEADERS), T.StructField("block", T.BinaryType())])
_MAP = pa.map_(pa.string(), pa.string())
#: A body that unpacks to more bytes is taken as it was sent, like one that does not decode.
MOST_DECODED = 128 << 20
# Attributes whose value is an address, and codecs of Python that are no character sets of pages.
ADDRESSES = {"href", "src", "action", "poster", "data"}
NO_CHARSETS = {"undefined", "idna", "punycode", "unicode_escape", "raw_unicode_escape", "mbcs", "oem"}
#: A name and its value, if it has one. Nothing is given back, so a run of characters is read a bounded number of times.
ATTRIBUTE = re.compile(r"([^\s=\"'/>]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"|'([^']*+)'|([^\s>\"']++)))?+")
LENGTH = re.compile(r"[0-9]{1,18}")


def digest(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(*parts: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(SPACE, chr(10).join(parts))}>"


def response(url: str | None, page: str | None, date: str = DATE) -> tuple[dict[str, str], bytes]:
    """A response record for a page that was fetched without its headers."""
    body = (page or "").encode()
    block = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(body) + body
    headers = {"WARC-Type": "response", "WARC-Record-ID": record_id(url or "", digest(body)), "WARC-Date": date}
    if url is not None:
        headers["WARC-Target-URI"] = url
    headers |= {"Content-Type": "application/http; msgtype=response", "WARC-Payload-Digest": digest(body), "WARC-Block-Digest": digest(block), "Content-Length": str(len(block))}
    return headers, block


def header_lines(head: bytes) -> list[tuple[str, str]]:
    """Names and values of header lines in order. Bytes that are no UTF-8 are read as Latin-1."""
    try:
        text = head.decode()
    except UnicodeDecodeError:
        text = head.decode("latin-1")
    lines: list[str] = []
    for line in text.split("\r\n"):
        if line[:1] in (" ", "\t") and lines:
            lines[-1] += " " + line.strip()  # a folded line
        else:
            lines.append(line)
    return [(k.strip(), v.strip()) for k, mark, v in (x.partition(":") for x in lines) if mark and k.strip()]


def as_map(pairs: list[tuple[str, str]]) -> dict[str, str]:
    """Headers by their first spelling; values of repeated ones one a line."""
    out: dict[str, str] = {}
    spelling: dict[str, str] = {}
    for k, v in pairs:
        k = spelling.setdefault(k.lower(), k)
        out[k] = f"{out[k]}\n{v}" if k in out else v
    return out


def http_parts(block: bytes) -> tuple[str, list[tuple[str, str]], bytes]:
    """(status line, headers, body) of an HTTP response."""
    head, found, body = block.partition(b"\r\n\r\n")
    if not found:
        head, body = (b"", block) if not block.startswith(b"HTTP/") else (block, b"")
    first, _, rest = head.partition(b"\r\n")
    return first.decode("latin-1"), header_lines(rest), body


def _first(http: list[tuple[str, str]], name: str) -> str:
    return next((v for k, v in http if k.lower() == name), "")


def dechunked(body: bytes) -> bytes:
    """The content of a chunked body; what is no chunk ends it."""
    out, at = [], 0
    while (end := body.find(b"\r\n", at)) >= 0:
        try:
            size = int(body[at:end].split(b";")[0], 16)
        except ValueError:
            return b"".join(out) if at else body
        if size <= 0:
            return b"".join(out)
        out.append(body[end + 2 : end + 2 + size])
        at = end + 2 + size + 2
    return b"".join(out) if out else body


def inflated(body: bytes, bits: int) -> bytes:
    """All members of a compressed body. An error if they are longer than MOST_DECODED."""
    out, size = [], 0
    while body:
        tool = zlib.decompressobj(bits)
        try:
            out.append(tool.decompress(body, MOST_DECODED - size + 1))
        except zlib.error:
            if not out:
                raise
            break  # what follows the last member
        size += len(out[-1])
        if size > MOST_DECODED:
            raise zlib.error("longer than MOST_DECODED")
        body = tool.unused_data if tool.eof else b""
    return b"".join(out)


def decoded(body: bytes, http: list[tuple[str, str]]) -> bytes:
    """The body without transfer and content coding."""
    if "chunked" in _first(http, "transfer-encoding").lower():
        body = dechunked(body)
    for coding in reversed([c.strip().lower() for c in _first(http, "content-encoding").split(",")]):
        for bits in {"gzip": (47,), "x-gzip": (47,), "deflate": (15, -15)}.get(coding, ()):
            try:
                body = inflated(body, bits)
                break
            except zlib.error:
                continue
    return body


def body_text(body: bytes, http: list[tuple[str, str]]) -> str:
    """The characters of a body, by the character set that its headers or its beginning name, else as UTF-8."""
    kind = _first(http, "content-type")
    m = re.search(r"charset=[\"']?([\w.:-]{1,40})", kind, re.I | re.A) or re.search(r"<meta[^>]{1,200}?charset=[\"']?([\w.:-]{1,40})", body[:2048].decode("latin-1"), re.I | re.A)
    try:
        name = codecs.lookup(m[1]).name if m else "utf-8"
        if name.replace("-", "_") not in NO_CHARSETS:
            # some character sets can spell half a surrogate pair, which is no text
            text = body.decode(name, "replace")
            return text if name == "utf-8" else text.encode("utf-8", "replace").decode()
    except (LookupError, UnicodeError, ValueError):
        pass
    return body.decode("utf-8", "replace")


def title_and_links(page: str, pieces: Iterable[tuple[str, str, str]] | None = None) -> tuple[str | None, list[dict[str, str]]]:
    """The first title, and the addresses in the tags of a page, in order. Comments and raw text have no tags."""
    title, links = None, []
    for kind, name, rest in tagpath.Scanner(page).pieces() if pieces is None else pieces:
        if kind == "raw" and name == "title" and title is None:
            title = " ".join(references.unescape(rest).split())
        elif kind == "open" and rest:
            for m in ATTRIBUTE.finditer(rest):
                attribute = m[1].lower()
                if attribute in ADDRESSES and m.lastindex > 1 and (attribute != "data" or name == "object"):
                    links.append({"element": name, "url": references.unescape(m[m.lastindex])})
    return title, links


def derivatives(headers: dict[str, str], block: bytes) -> list[tuple[dict[str, str], bytes]]:
    """The metadata and the conversion record of a response."""
    status, http, body = http_parts(block)
    page = body_text(decoded(body, http), http)
    source = {k.lower(): v.split("\n")[0] for k, v in headers.items()}
    payload = source.get("warc-payload-digest") or digest(body)
    refers = source.get("warc-record-id") or record_id(source.get("warc-target-uri", ""), payload)
    ids = {kind: record_id(refers, kind) for kind in ("metadata", "conversion")}
    pieces = list(tagpath.Scanner(page).pieces())
    title, links = title_and_links(page, pieces)
    about = {"refers_to": refers, "conversion": ids["conversion"], "warc_headers": headers, "http_status": status, "http_headers": [list(x) for x in http], "payload_digest": payload, "title": title, "links": links}
    text = "\n".join(b.text for b in tagpath.blocks(page, pieces))
    blocks = {"metadata": json.dumps(about, ensure_ascii=False, sort_keys=True).encode(), "conversion": text.encode()}
    out = []
    for kind, other in (("metadata", "conversion"), ("conversion", "metadata")):
        own = {"WARC-Type": kind, "WARC-Record-ID": ids[kind], "WARC-Date": source.get("warc-date", DATE), "WARC-Refers-To": refers}
        if "warc-target-uri" in source:
            own |= {"WARC-Target-URI": source["warc-target-uri"], "WARC-Refers-To-Target-URI": source["warc-target-uri"]}
        if "warc-date" in source:
            own["WARC-Refers-To-Date"] = source["warc-date"]
        own |= {"X-Linked-Record": ids[other], "X-Source-Payload-Digest": payload, "Content-Type": "application/json" if kind == "metadata" else "text/plain; charset=utf-8", "WARC-Block-Digest": digest(blocks[kind]), "Content-Length": str(len(blocks[kind]))}
        out.append((own, blocks[kind]))
    return out


def responses(pages: DataFrame, keep: list[str], url: str = "url", html: str = "html", date: str = DATE) -> DataFrame:
    """The columns `keep` with headers and block of a response record for each page."""
    keep = [c for c in keep if c not in ("headers", "block")]
    source = pages.select(*keep, F.col(url).alias("__url"), F.col(html).alias("__html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 500):
                part = batch.slice(k, 500)
                made = [response(u, h, date) for u, h in zip(part.column("__url").to_pylist(), part.column("__html").to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*part.select(keep).columns, pa.array([list(m[0].items()) for m in made], _MAP), pa.array([m[1] for m in made], pa.binary())], names=[*keep, "headers", "block"])

    schema = T.StructType([*pages.select(*keep).schema.fields, *RESPONSE.fields])
    return source.mapInArrow(run, schema)


def derive(records: DataFrame, keep: list[str]) -> DataFrame:
    """The columns `keep` with headers and block of two derivatives for each response among the records."""
    keep = [c for c in keep if c not in ("headers", "block")]
    is_response = F.coalesce(F.col("headers")["WARC-Type"], F.lit("response")) == "response"
    source = records.where(is_response).select(*keep, "headers", "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 200):
                part = batch.slice(k, 200)
                made = [d for h, b in zip(part.column("headers").to_pylist(), part.column("block").to_pylist(), strict=True) for d in derivatives(dict(h or []), b or b"")]
                twice = pa.array([i for i in range(part.num_rows) for _ in range(2)], pa.int64())
                yield pa.RecordBatch.from_arrays([*(c.take(twice) for c in part.select(keep).columns), pa.array([list(m[0].items()) for m in made], _MAP), pa.array([m[1] for m in made], pa.binary())], names=[*keep, "headers", "block"])

    return source.mapInArrow(run, source.schema)


SEPARATOR = "WARC/1."
HEAD = re.compile(rb"\d\r\n")
_PARSED = T.StructType([*RESPONSE.fields, T.StructField("path", T.StringType()), T.StructField("at", T.LongType()), T.StructField("nth", T.LongType()), T.StructField("piece", T.BinaryType())])


def _record(piece: bytes) -> tuple[dict[str, str], int, int] | None:
    """(headers, where the block begins, its length) of a piece that begins with the rest of a version line, else None."""
    end = piece.find(b"\r\n\r\n")
    if not HEAD.match(piece) or end < 0:
        return None
    headers = as_map(header_lines(piece[3:end]))
    size = next((v for k, v in headers.items() if k.lower() == "content-length"), "").split("\n")[0]
    return headers, end + 4, int(size) if LENGTH.fullmatch(size) else -1


class Assembler:
    """Joins the pieces of records, in order of the file."""

    def __init__(self) -> None:
        self.held: list[bytes] = []
        self.size = self.need = 0

    def add(self, piece: bytes) -> list[tuple[dict[str, str], bytes]]:
        """The records that the piece completes."""
        if self.held:
            self.held += [SEPARATOR.encode(), piece]
            self.size += len(SEPARATOR) + len(piece)
        else:
            found = _record(piece)
            if found is None:
                return []
            headers, begin, length = found
            if length < 0:
                return [(headers, piece[begin:].removesuffix(b"\r\n\r\n"))]
            self.held, self.size, self.need = [piece], len(piece), begin + length
        if self.size < self.need:
            return []
        return [self.rest(False)]

    def rest(self, truncated: bool = True) -> tuple[dict[str, str], bytes]:
        """The record that is held, as far as it goes."""
        whole = b"".join(self.held)
        self.held = []
        headers, begin, length = _record(whole)
        return headers | ({"X-Truncated": "true"} if truncated else {}), whole[begin : begin + length]


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """(headers, block) of the records of WARC 1.x files, gzipped or not; a record is held at a time, not a file."""
    lines = spark.read.option("lineSep", SEPARATOR).text(path).select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, now, nth, pieces, opened = Assembler(), None, 0, [], False

        def batch_of(records: list, kept: list) -> pa.RecordBatch:
            none = [None] * len(records)
            return pa.RecordBatch.from_arrays([pa.array([list(r[0].items()) for r in records] + [None] * len(kept), _MAP), pa.array([r[1] for r in records] + [None] * len(kept), pa.binary()), pa.array(none + [k[0] for k in kept], pa.string()), pa.array(none + [k[1] for k in kept], pa.int64()), pa.array(none + [k[2] for k in kept], pa.int64()), pa.array(none + [k[3] for k in kept], pa.binary())], names=["headers", "block", "path", "at", "nth", "piece"])

        def left() -> list:
            # what a split does not complete, and what comes before its first record, may go on in its neighbours
            held = [(*now, k, p) for k, p in pieces] if now and (tool.held or not opened) else []
            tool.held = []
            return held

        for batch in batches:
            records, kept = [], []
            for cell, *place in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if place != now:
                    kept += left()
                    now, nth, pieces, opened = place, 0, [], False
                piece, nth = cell or b"", nth + 1
                begins = not tool.held and _record(piece) is not None
                if begins:
                    if not opened:
                        kept += [(*now, k, p) for k, p in pieces]
                    pieces, opened = [], True
                if begins or tool.held or not opened:
                    pieces.append((nth, piece))
                done = tool.add(piece)
                if done:
                    records, pieces = records + done, []
            if records or kept:
                yield batch_of(records, kept)
        yield batch_of([], left())

    def stitch(pieces: pa.Table) -> pa.Table:
        tool, out = Assembler(), []
        pieces = pieces.sort_by([("at", "ascending"), ("nth", "ascending")])
        for piece in pieces.column("piece").to_pylist():
            out += tool.add(piece)
        if tool.held:
            out.append(tool.rest())
        return pa.table({"headers": pa.array([list(r[0].items()) for r in out], _MAP), "block": pa.array([r[1] for r in out], pa.binary())})

    parsed = lines.mapInArrow(run, _PARSED)
    torn = parsed.where("piece IS NOT NULL").select("path", "at", "nth", "piece").groupBy("path").applyInArrow(stitch, RESPONSE)
    return parsed.where("piece IS NULL").select("headers", "block").unionByName(torn)


def write_warc(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """Writes records, whatever the bytes of their blocks, as WARC files."""
    order = ["WARC-Type", "WARC-Record-ID"]
    entries = F.concat(F.filter(F.transform(F.array(*map(F.lit, order)), lambda k: F.struct(k.alias("key"), F.element_at("headers", k).alias("value"))), lambda e: e["value"].isNotNull()), F.filter(F.map_entries("headers"), lambda e: ~e["key"].isin(order)))
    lines = F.array_join(F.flatten(F.transform(entries, lambda e: F.transform(F.split(e["value"], "\n"), lambda v: F.concat(e["key"], F.lit(": "), v)))), "\r\n")
    record = F.concat(F.lit(f"{VERSION}\r\n").cast("binary"), lines.cast("binary"), F.lit("\r\n\r\n").cast("binary"), F.col("block")).cast("string")
    records.select(record.alias("value")).write.option("lineSep", "\r\n\r\n").option("compression", compression).text(path)
