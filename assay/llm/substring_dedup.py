"""Substring deduplication by a log-structured index of window fingerprints (operator 1).

A window is WINDOW consecutive words of one document. A word goes if some window that covers it has the same words as a
window that starts earlier: in an earlier batch, at a smaller doc_id, or earlier in the same document.

Each window is filed under an anchor: the ANCHOR-word gram inside it with the least hash (winnowing). Equal windows have
equal anchors at equal offsets, so an index entry is one anchor with a fingerprint (PRINT_BYTES) for each of the up to 13
consecutive windows that chose it: some 6 bytes a window instead of a row each.

The index is one table in the shared folder, bucketed by Spark. A batch's entries are dealt to the same buckets and appended
as an immutable run, sorted by anchor in each bucket. Merging a batch cogroups its entries with the bucketed table: only the
batch is shuffled. In a bucket the batch's entries, sorted by anchor, are merge-joined with each sorted run; windows are
compared only on anchors that both sides (or two of the batch's documents) have, the earliest owner of a window is kept, and
what is new becomes the next run. When FAN_IN runs have gathered, a merge of the sorted runs replaces them by one; it reads
and writes bucket by bucket. remove_repeats feeds its table in FAN_IN small batches, which are compacted, and a large one.

Fingerprints only make candidates. Every candidate passage is verified on its words: the texts of its document and of its
owner give a 128-bit hash of the passage's words, and the two must be equal. Passages that are not are split into windows,
which are settled among themselves by the same hash of their words, so results do not depend on the width of fingerprints.

Skew: windows that repeat among a task's next UNIT_WINDOWS are settled before the shuffle, so a passage that a third of all
documents share costs one entry a unit. An anchor with many unlike windows (a line shorter than a window in many documents)
is found in a sample of about SAMPLE_HITS / HOT_ENTRIES of the documents, and its windows are filed one by one under their own
hash, so they spread over all buckets; equal ones of them are settled in SALTS groups before they meet. The sample steers
only where windows are filed. Texts move twice, packed: to be verified and to be cut.

Bounds: the driver holds the list of hot anchors (at most HOT_LIST). Buckets grow in number with the words up to the
session's spark.sql.sources.bucketing.maxBuckets (100,000), beyond that in size. A row's own spans are one group.

Defined results: a null text has no words; texts with fewer than WINDOW words lose none; a null doc_id counts as the
largest; rows with equal doc_id and text are one document (none removes words of the other) and get equal results; among
rows with equal doc_id and unlike texts the order is that of a hash of the text; extra columns pass through, those named like
an output are replaced; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from . import kernels as K
from .storage import materialise, new_path, release

WINDOW, ANCHOR = 20, 8
LAST = np.iinfo(np.int64).max
#: Bytes of a window's fingerprint in the index; its words decide.
PRINT_BYTES = 4
#: Windows that one bucket should hold.
BUCKET_WINDOWS = 500_000
#: Windows of a task that are settled among themselves at once.
UNIT_WINDOWS = 400_000
#: Windows in one cell of a run.
PIECE_WINDOWS = 2_000_000
FAN_IN = 4
#: Entries from which an anchor counts as hot, the hits in a sample that show it, and how many hot anchors are kept.
HOT_ENTRIES, SAMPLE_HITS, HOT_LIST = 100_000, 8, 1_000_000
SALTS = 256
#: Bytes of text that one task verifies or cuts at a time.
SHELF_BYTES = 16 << 20

ENTRY = np.dtype([("anchor", "<u8"), ("doc", "<i8"), ("tag", "<u4"), ("start", "<i4"), ("offset", "u1"), ("count", "u1")])
SPAN = np.dtype([("doc", "<i8"), ("tag", "<u4"), ("start", "<i4"), ("end", "<i4"), ("owner", "<i8"), ("owner_tag", "<u4"), ("owner_start", "<i4")])
Entries = tuple[np.ndarray, np.ndarray]


def text_tag(text: str) -> Column:
    """32 bits of the hash of a text, which tell apart texts of one doc_id."""
    return F.shiftrightunsigned(F.xxhash64(F.col(text)), 32)


def _anchors(grams: np.ndarray, width: int) -> np.ndarray:
    """For each window of `width` grams the position of the least, the first of equals."""
    value, at, size, out = K.mix(grams ^ K.U(0x5DEECE66D)), np.arange(len(grams)), 1, None
    least = lambda a, b: (lambda right: (np.where(right, b[0], a[0]), np.where(right, b[1], a[1])))(b[0] < a[0])
    now, done, m = (value, at), 0, width
    while m:
        if m & 1:
            if out is None:
                out, done = now, size
            else:
                k = len(value) - done - size + 1
                out = least((out[0][:k], out[1][:k]), (now[0][done : done + k], now[1][done : done + k]))
                done += size
        m >>= 1
        if m:
            k = len(now[0]) - size
            now = least((now[0][:k], now[1][:k]), (now[0][size:], now[1][size:]))
            size *= 2
    return out[1]


def text_entries(raw: np.ndarray, offsets: np.ndarray, doc_id: np.ndarray, tag: np.ndarray) -> Entries:
    """The index entries of whole texts."""
    start, end, doc = K.words(raw, offsets)
    at = K.windows(doc, WINDOW)
    if not len(at):
        return np.zeros(0, ENTRY), np.zeros(0, K.U)
    h = K.span_hashes(raw, start, end)
    first = np.searchsorted(doc, np.arange(len(offsets) - 1))
    grams = K.ngrams(h, ANCHOR)
    anchor = _anchors(grams, WINDOW - ANCHOR + 1)[at]
    prints = K.ngrams(h, WINDOW)[at]
    owner = doc[at]
    return _pack(grams[anchor], doc_id[owner], tag[owner], (at - first[owner]).astype(np.int32), (anchor - at).astype(np.uint8), prints)


def _pack(anchor: np.ndarray, doc: np.ndarray, tag: np.ndarray, start: np.ndarray, offset: np.ndarray, prints: np.ndarray) -> Entries:
    """Windows, in order of position, as entries: consecutive windows with one anchor share an entry."""
    if not len(anchor):
        return np.zeros(0, ENTRY), np.zeros(0, K.U)
    new = np.ones(len(anchor), bool)
    new[1:] = (start[1:] != start[:-1] + 1) | (offset[1:] + 1 != offset[:-1]) | (anchor[1:] != anchor[:-1]) | (doc[1:] != doc[:-1]) | (tag[1:] != tag[:-1])
    at = np.flatnonzero(new)
    out = np.empty(len(at), ENTRY)
    out["anchor"], out["doc"], out["tag"], out["start"], out["offset"] = anchor[at], doc[at], tag[at], start[at], offset[at]
    out["count"] = np.diff(np.append(at, len(anchor)))
    return out, prints


def _windows(entries: Entries) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each window: its entry, its number in the entry, and its key of anchor, offset and fingerprint."""
    head, prints = entries
    entry = np.repeat(np.arange(len(head)), head["count"])
    step = np.arange(len(prints)) - np.repeat(np.cumsum(head["count"], dtype=np.int64) - head["count"], head["count"])
    place = (head["offset"][entry].astype(np.int64) - step).astype(K.U)
    return entry, step, K.mix(head["anchor"][entry] + (place << K.U(32)) * K.U(0x9E3779B97F4A7C15) + K.mix(prints + K.U(1)))


def _none() -> Entries:
    return np.zeros(0, ENTRY), np.zeros(0, K.U)


def settle(entries: Entries, history: Entries | None = None) -> tuple[Entries, np.ndarray]:
    """owned() without the owners of the spans."""
    first, spans = owned(entries, history)
    return first, spans[["doc", "tag", "start", "end"]]


def owned(entries: Entries, history: Entries | None = None) -> tuple[Entries, np.ndarray]:
    """(entries of the windows that are the first of their kind, spans of the other windows with their owners), for the batch
    `entries`.

    Windows of the history are earlier than all of the batch.
    """
    head, prints = entries
    if not len(head):
        return entries, np.zeros(0, SPAN)
    rank = np.empty(len(head), np.int64)
    by = np.lexsort((head["start"], head["tag"], head["doc"]))
    new = np.ones(len(by), bool)
    new[1:] = (head["doc"][by][1:] != head["doc"][by][:-1]) | (head["tag"][by][1:] != head["tag"][by][:-1]) | (head["start"][by][1:] != head["start"][by][:-1])
    rank[by] = np.cumsum(new)  # entries of repeated rows are at one position
    entry, step, key = _windows(entries)
    order_of = (rank[entry] << 5) | step
    doc, tag, start = head["doc"][entry], head["tag"][entry], head["start"][entry] + step.astype(np.int32)
    anchors, marks, old = head["anchor"][entry], prints, 0
    if history is not None and len(history[0]):
        h_entry, h_step, h_key = _windows(history)
        past, old = history[0], len(h_key)
        key, order_of = np.concatenate([h_key, key]), np.concatenate([np.full(old, -1), order_of])
        anchors, marks = np.concatenate([past["anchor"][h_entry], anchors]), np.concatenate([history[1], prints])
        doc, tag, start = np.concatenate([past["doc"][h_entry], doc]), np.concatenate([past["tag"][h_entry], tag]), np.concatenate([past["start"][h_entry] + h_step.astype(np.int32), start])
    by = np.lexsort((order_of, key))
    fresh = np.ones(len(by), bool)
    fresh[1:] = key[by][1:] != key[by][:-1]
    group = np.cumsum(fresh) - 1
    first = by[np.flatnonzero(fresh)][group]  # the earliest window with the key
    # a key stands for an anchor and a fingerprint; both must be those of the key's first window
    repeated = np.zeros(len(by), bool)
    repeated[by] = (order_of[by] > order_of[first]) & (anchors[by] == anchors[first]) & (marks[by] == marks[first])
    owner = np.empty(len(by), np.int64)
    owner[by] = first
    gone = np.flatnonzero(repeated)
    del by, fresh, group, first, key, anchors, marks
    spans = _spans(doc[gone], tag[gone], start[gone], doc[owner[gone]], tag[owner[gone]], start[owner[gone]])
    # order by position so that neighbours share an entry again
    stay = np.flatnonzero(~repeated[old:])
    stay = stay[np.argsort(order_of[old:][stay], kind="stable")]
    e, s = entry[stay], step[stay]
    return _pack(head["anchor"][e], head["doc"][e], head["tag"][e], (head["start"][e] + s).astype(np.int32), (head["offset"][e] - s).astype(np.uint8), prints[stay]), spans


def _spans(doc: np.ndarray, tag: np.ndarray, start: np.ndarray, owner: np.ndarray, owner_tag: np.ndarray, owner_start: np.ndarray) -> np.ndarray:
    """The passages that windows cover. Windows that touch and lie at one distance from their owner's are one passage."""
    if not len(doc):
        return np.zeros(0, SPAN)
    shift = owner_start.astype(np.int64) - start
    by = np.lexsort((start, shift, owner_tag, owner, tag, doc))
    columns = [x[by] for x in (doc, tag, owner, owner_tag, shift)]
    start, owner_start = start[by], owner_start[by]
    new = np.ones(len(doc), bool)
    new[1:] = start[1:] > start[:-1] + WINDOW
    for x in columns:
        new[1:] |= x[1:] != x[:-1]
    at = np.flatnonzero(new)
    out = np.empty(len(at), SPAN)
    out["doc"], out["tag"], out["owner"], out["owner_tag"] = (x[at] for x in columns[:4])
    out["start"], out["owner_start"] = start[at], owner_start[at]
    out["end"] = start[np.append(at[1:], len(doc)) - 1] + WINDOW
    return out


def _dump(entries: Entries, width: int = PRINT_BYTES) -> bytes:
    """Anchors and fingerprints as they are (hashes do not compress), the other columns as differences, byte by byte."""
    head, prints = entries
    columns = [np.diff(head["doc"], prepend=np.int64(0)), head["tag"], head["start"], head["offset"], head["count"]]
    planes = b"".join(np.ascontiguousarray(c).view(np.uint8).reshape(len(head), -1).T.tobytes() for c in columns) if len(head) else b""
    small = zstandard.ZstdCompressor(level=1).compress(planes)
    marks = np.ascontiguousarray(prints).view(np.uint8).reshape(-1, 8)[:, :width].tobytes()
    return np.array([len(head), len(prints), width], np.int64).tobytes() + np.ascontiguousarray(head["anchor"]).tobytes() + marks + small


def _load(blob: bytes) -> Entries:
    n, m, width = np.frombuffer(blob, np.int64, 3).tolist()
    head, at = np.empty(n, ENTRY), 24
    head["anchor"] = np.frombuffer(blob, np.uint64, n, at)
    at += 8 * n
    marks = np.zeros((m, 8), np.uint8)
    marks[:, :width] = np.frombuffer(blob, np.uint8, m * width, at).reshape(m, width)
    planes, begin = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[at + m * width :]), np.uint8), 0
    for name in ENTRY.names[1:]:
        kind = ENTRY[name]
        head[name] = np.ascontiguousarray(planes[begin : begin + kind.itemsize * n].reshape(kind.itemsize, n).T).view(kind).reshape(n)
        begin += kind.itemsize * n
    head["doc"] = np.cumsum(head["doc"])
    return head, marks.view(np.uint64).reshape(m)


def _join(parts: list[Entries]) -> Entries:
    return (np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])) if parts else _none()


def _order(entries: Entries, by: np.ndarray) -> Entries:
    """The entries in the order `by`."""
    head, prints = entries
    size = head["count"].astype(np.int64)
    begin, size = (np.cumsum(size) - size)[by], size[by]
    return head[by], prints[np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]


def _merged(parts: list[Entries]) -> Entries:
    """Runs that are sorted by anchor as one; a stable sort merges sorted runs."""
    whole = _join(parts)
    return _order(whole, np.argsort(whole[0]["anchor"], kind="stable"))


def merge_join(batch: Entries, runs: Iterator[Entries]) -> tuple[Entries, np.ndarray]:
    """(new entries by anchor, spans) of a batch that is sorted by anchor, against runs that are, too.

    Entries whose anchor no run and no other entry of the batch has are new without a look at their windows.
    """
    a = batch[0]["anchor"]
    same = a[1:] == a[:-1]
    hit = np.zeros(len(a) + 1, np.int64)
    hit[1:-1] += same
    hit[:-2] += same
    hit = hit[:-1] > 0
    past = []
    for run in runs:
        own = run[0]["anchor"]
        low, high = np.searchsorted(a, own, "left"), np.searchsorted(a, own, "right")
        both = np.flatnonzero(high > low)
        if len(both):
            past.append(_order(run, both))
            step = np.bincount(low[both], minlength=len(a) + 1) - np.bincount(high[both], minlength=len(a) + 1)
            hit |= np.cumsum(step[:-1]) > 0
    if not hit.any():
        return batch, np.zeros(0, SPAN)
    first, spans = owned(_order(batch, np.flatnonzero(hit)), _join(past))
    return _merged([_order(batch, np.flatnonzero(~hit)), _order(first, np.argsort(first[0]["anchor"], kind="stable"))]), spans


REMOVED = T.ArrayType(T.StructType([T.StructField("from_word", T.IntegerType()), T.StructField("to_word", T.IntegerType())]))
NEW, DONE, HOT = 1, 2, 3
BLOBS = "bucket int, kind int, data binary"
RUNS = "bucket int, kind int, nth int, data binary"


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32()] * (len(rows[0]) - 1) + [pa.binary()] if rows else [pa.int32(), pa.int32(), pa.binary()]
    names = ["bucket", "kind", "data"] if len(kinds) == 3 else ["bucket", "kind", "nth", "data"]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names=names)


def route(entries: Entries, buckets: int, hot: np.ndarray, width: int = PRINT_BYTES) -> list[tuple[int, int, Entries]]:
    """(bucket, kind, entries): entries by their anchor, windows of hot anchors one by one by their own key."""
    out = []
    is_hot = np.isin(entries[0]["anchor"], hot) if len(hot) else np.zeros(len(entries[0]), bool)
    for kind, part in ((NEW, entries if not is_hot.any() else _order(entries, np.flatnonzero(~is_hot))), (HOT, _order(entries, np.flatnonzero(is_hot)) if is_hot.any() else _none())):
        if not len(part[0]):
            continue
        value = part[0]["anchor"]
        if kind == HOT:
            short = part[1] & K.U((1 << 8 * width) - 1)
            entry, step, value = _windows((part[0], short))
            h = part[0][entry].copy()
            h["start"] += step.astype(np.int32)
            h["offset"] -= step.astype(np.uint8)
            h["count"] = 1
            part = h, part[1]
        bucket = (K.mix(value) >> K.U(33)).astype(np.int64) % buckets
        by = np.argsort(bucket, kind="stable")
        heads, prints = _order(part, by)
        bounds = np.append(0, np.cumsum(heads["count"], dtype=np.int64))
        edge = np.append(np.flatnonzero(np.diff(bucket[by], prepend=-1)), len(by))
        out += [(int(bucket[by[i]]), kind, (heads[i:j], prints[bounds[i] : bounds[j]])) for i, j in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)]
    return out


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), text_tag(text).alias("tag"))


def _entries_of(batch: pa.RecordBatch) -> Iterator[Entries]:
    raw, offsets = K.string_parts(batch.column("text"))
    ids = batch.column("doc_id").fill_null(int(LAST)).to_numpy(zero_copy_only=False).astype(np.int64)
    tags = batch.column("tag").to_numpy(zero_copy_only=False).astype(np.uint32)
    for i, j, r, o in K.chunks(raw, offsets):
        yield text_entries(r, o, ids[i:j], tags[i:j])


def batch_blobs(docs: DataFrame, buckets: int, hot: np.ndarray, doc_id: str = "doc_id", text: str = "text", width: int = PRINT_BYTES) -> DataFrame:
    """(bucket, kind, data): what a batch has for each bucket, with the repeats inside each unit settled."""

    def blobs(first: Entries, spans: np.ndarray) -> Iterator[pa.RecordBatch]:
        rows = [(b, kind, _dump(part, width)) for b, kind, part in route(first, buckets, hot, width)]
        if len(spans):
            rows.append((int(spans["doc"][0] % buckets), DONE, spans.tobytes()))
        for i in range(0, len(rows), 256):
            yield _rows(rows[i : i + 256])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for part in _entries_of(batch):
                held.append(part)
                size += len(part[1])
                if size >= UNIT_WINDOWS:
                    yield from blobs(*owned(_join(held)))
                    held, size = [], 0
        if size:
            yield from blobs(*owned(_join(held)))

    return _keyed(docs, doc_id, text).mapInArrow(run, BLOBS)


def _settled_hot(blobs: DataFrame, width: int) -> DataFrame:
    """Windows of hot anchors, settled in SALTS groups for each bucket before they meet in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, bucket = [], 0
        for batch in batches:
            bucket = batch.column("bucket")[0].as_py()
            parts += [_load(d) for d in batch.column("data").to_pylist()]
        first, spans = owned(_join(parts))
        yield _rows([(bucket, NEW, _dump(first, width)), (bucket, DONE, spans.tobytes())])

    hot = blobs.where(F.col("kind") == HOT).select("bucket", F.pmod(F.xxhash64("data"), F.lit(SALTS)).alias("salt"), "data")
    return blobs.where(F.col("kind") != HOT).unionByName(hot.groupBy("bucket", "salt").applyInArrow(run, BLOBS))


def _pieces(entries: Entries) -> Iterator[Entries]:
    """Parts of about PIECE_WINDOWS windows, in order."""
    bounds = np.append(0, np.cumsum(entries[0]["count"], dtype=np.int64))
    i = 0
    while i < len(entries[0]):
        j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + PIECE_WINDOWS, "right")) - 1)
        yield entries[0][i:j], entries[1][bounds[i] : bounds[j]]
        i = j


def _span_rows(spans: np.ndarray) -> pa.RecordBatch:
    """SPANS rows of spans; a span is from_word << 32 | to_word."""
    start, end, from_ = (spans[n].astype(np.int64) for n in ("start", "end", "owner_start"))
    columns = [spans["doc"], spans["tag"].astype(np.int64), (start << 32) | end, spans["owner"], spans["owner_tag"].astype(np.int64), (from_ << 32) | (from_ + end - start)]
    return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["doc_id", "tag", "span", "owner", "owner_tag", "owner_span"])


def _merge_bucket(bucket: int, new: list[bytes], done: list[bytes], runs: Iterator[Entries], width: int) -> list[tuple]:
    first, spans = merge_join(_merged([_load(d) for d in new]), runs)
    spans = np.concatenate([spans, *(np.frombuffer(d, SPAN) for d in done)])
    rows = [(bucket, NEW, k, _dump(p, width)) for k, p in enumerate(_pieces(first))]
    return rows + [(bucket, DONE, k, spans[i : i + 500_000].tobytes()) for k, i in enumerate(range(0, len(spans), 500_000))]


class FingerprintIndex:
    """Sorted immutable runs of the windows seen so far, in a bucketed table in the shared folder.

    `hot`: anchors whose windows are filed one by one, for all runs. close() drops the table.
    """

    def __init__(self, spark: SparkSession, buckets: int, fan_in: int = FAN_IN, hot: np.ndarray | None = None, width: int = PRINT_BYTES):
        self.spark, self.fan_in, self.width = spark, fan_in, width
        self.buckets = min(buckets, int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets", "100000")))
        self.hot = np.zeros(0, K.U) if hot is None else hot
        self.runs: list[int] = []
        self.made = 0
        self._new_table()

    def _new_table(self) -> None:
        self.table, self.path = f"window_runs_{uuid.uuid4().hex}", new_path(self.spark, "window-runs")

    def _append(self, rows: DataFrame) -> None:
        rows.write.format("parquet").option("compression", "zstd").option("path", self.path).bucketBy(self.buckets, "bucket").mode("append").saveAsTable(self.table)

    def _drop(self, table: str, path: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        release(self.spark, path)

    def history(self) -> DataFrame | None:
        return self.spark.table(self.table).where(F.col("kind") == NEW) if self.runs else None

    def add(self, docs: DataFrame, last: bool = False, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
        """The spans (doc_id, tag, span, owner, owner_tag, owner_span) of the batch that earlier windows seem to cover; the
        batch joins the index.

        With `last` no further batch comes, and the batch's own run is not written.
        """
        width = self.width
        blobs = batch_blobs(docs, self.buckets, self.hot, doc_id, text, width)
        if len(self.hot):
            blobs = _settled_hot(blobs, width)
        split = lambda t: ([d for k, d in zip(t.column("kind").to_pylist(), t.column("data").to_pylist(), strict=True) if k == NEW], [d for k, d in zip(t.column("kind").to_pylist(), t.column("data").to_pylist(), strict=True) if k == DONE])

        def settled(batch: pa.Table, runs: Iterator[Entries]) -> pa.Table:
            new, done = split(batch)
            if not last:
                return pa.Table.from_batches([_rows(_merge_bucket(batch.column("bucket")[0].as_py(), new, done, runs, width))])
            _, spans = merge_join(_merged([_load(d) for d in new]), runs)
            return pa.Table.from_batches([_span_rows(np.concatenate([spans, *(np.frombuffer(d, SPAN) for d in done)]))])

        def beside(batch: pa.Table, past: pa.Table) -> pa.Table:
            if not batch.num_rows:
                return pa.Table.from_batches([_span_rows(np.zeros(0, SPAN))]) if last else _empty_runs()
            return settled(batch, (_load(d.as_py()) for d in past.column("data")))

        old, out = self.history(), SPANS if last else RUNS
        if old is None:
            merged = blobs.groupBy("bucket").applyInArrow(lambda batch: settled(batch, iter(())), out)
        else:
            merged = blobs.groupBy("bucket").cogroup(old.select("bucket", "data").groupBy("bucket")).applyInArrow(beside, out)
        if last:
            # straight from the merge: a second Python step in its tasks would hold as many workers again
            spans, _ = materialise(merged, "window-spans")
            return spans
        self.made += 1
        run, path = materialise(merged, "window-run")
        self._append(run.where(F.col("kind") == NEW).select(F.lit(self.made).alias("run"), "bucket", "kind", "nth", "data"))
        spans, _ = materialise(spans_of(run.where(F.col("kind") == DONE)), "window-spans")
        release(self.spark, path)
        self.runs.append(self.made)
        if len(self.runs) >= self.fan_in:
            self.compact()
        return spans

    def compact(self) -> None:
        """All runs become one: in each bucket their sorted entries are merged."""
        width, old, table, path = self.width, self.history(), self.table, self.path

        def run(past: pa.Table) -> pa.Table:
            bucket = past.column("bucket")[0].as_py()
            return pa.Table.from_batches([_rows([(bucket, NEW, k, _dump(p, width)) for k, p in enumerate(_pieces(_merged([_load(d.as_py()) for d in past.column("data")])))])])

        self._new_table()
        self.made += 1
        self._append(old.select("bucket", "data").groupBy("bucket").applyInArrow(run, RUNS).select(F.lit(self.made).alias("run"), "bucket", "kind", "nth", "data"))
        self.runs = [self.made]
        self._drop(table, path)

    def close(self) -> None:
        self._drop(self.table, self.path)
        self.runs = []


def _empty_runs() -> pa.Table:
    return pa.table({"bucket": pa.array([], pa.int32()), "kind": pa.array([], pa.int32()), "nth": pa.array([], pa.int32()), "data": pa.array([], pa.binary())})


SPANS = "doc_id long, tag long, span long, owner long, owner_tag long, owner_span long"


def spans_of(done: DataFrame) -> DataFrame:
    """The spans in DONE cells as rows; a span is from_word << 32 | to_word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for d in batch.column("data").to_pylist():
                s = np.frombuffer(d, SPAN)
                for i in range(0, len(s), 100_000):
                    yield _span_rows(s[i : i + 100_000])

    return done.select("data").mapInArrow(run, SPANS)


def survey(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", hot_entries: int = HOT_ENTRIES) -> tuple[int, np.ndarray]:
    """(bytes of all texts, hot anchors): one pass; anchors are counted in a sample by a hash of the text."""
    parts = 1 << 20
    share = min(parts, max(1, int(parts * 4 * SAMPLE_HITS / hot_entries)))
    sampled = F.pmod(F.xxhash64(F.lit(17), F.col(text), F.col(doc_id)), F.lit(parts)) < share
    source = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.when(sampled, F.col(text)).alias("text"), text_tag(text).alias("tag"), F.coalesce(F.octet_length(text), F.lit(0)).cast("long").alias("size"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, anchors = 0, []
        for batch in batches:
            total += int(batch.column("size").to_numpy().sum())
            anchors += [e[0]["anchor"] for e in _entries_of(batch)]
        value, n = np.unique(np.concatenate(anchors) if anchors else np.zeros(0, K.U), return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array([None, *value.view(np.int64).tolist()], pa.int64()), pa.array([total, *n.tolist()], pa.int64())], names=["anchor", "n"])

    counted = source.mapInArrow(run, "anchor long, n long").groupBy("anchor").agg(F.sum("n").alias("n"))
    found = counted.where(F.col("anchor").isNull() | (F.col("n") >= SAMPLE_HITS)).orderBy(F.col("anchor").isNull().desc(), F.desc("n"), "anchor").limit(HOT_LIST + 1).collect()
    return sum(r["n"] for r in found if r["anchor"] is None), np.sort(np.array([r["anchor"] for r in found if r["anchor"] is not None], np.int64).view(K.U))


def packed(docs: DataFrame, columns: list[Column], shelves: int, doc_id: str, text: str) -> DataFrame:
    """(shelf, rows): the columns, __text, __key and __tag of docs, whole rows packed and compressed, on the shelf of their key.

    Texts too short for a window have no spans and go to any shelf.
    """
    source = docs.select(*columns, F.coalesce(F.col(doc_id).cast("long"), F.lit(int(LAST))).alias("__key"), F.col(text).alias("__text"), text_tag(text).alias("__tag"), F.coalesce(F.octet_length(text) < 2 * WINDOW - 1, F.lit(True)).alias("__short"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = zstandard.ZstdCompressor(level=3)
        turn = 0
        for batch in batches:
            shelf = _shelf(batch.column("__key").to_numpy(), batch.column("__tag").to_numpy(), shelves)
            short = batch.column("__short").to_numpy(zero_copy_only=False)
            shelf[short] = (np.arange(int(short.sum())) + turn) % shelves
            turn += int(short.sum())
            by = np.argsort(shelf, kind="stable")
            edge = np.append(np.flatnonzero(np.diff(shelf[by], prepend=-1)), len(by)).tolist()
            for i, j in zip(edge[:-1], edge[1:], strict=True):
                sink = pa.BufferOutputStream()
                part = batch.take(pa.array(by[i:j]))
                with pa.ipc.new_stream(sink, part.schema) as out:
                    out.write_batch(part)
                yield pa.RecordBatch.from_arrays([pa.array([int(shelf[by[i]])], pa.int32()), pa.array([tool.compress(sink.getvalue().to_pybytes())], pa.binary())], names=["shelf", "rows"])

    return source.mapInArrow(run, "shelf int, rows binary")


def _unpacked(shelf: pa.Table) -> Iterator[pa.RecordBatch]:
    tool = zstandard.ZstdDecompressor()
    for cell in shelf.column("rows"):
        yield from pa.ipc.open_stream(tool.decompress(cell.as_py()))


def _shelf(key: np.ndarray, tag: np.ndarray, shelves: int) -> np.ndarray:
    return (K.mix(key.astype(K.U) + K.mix(tag.astype(K.U) + K.U(3))) >> K.U(33)).astype(np.int64) % shelves


def _on_shelves(spans: DataFrame, shelves: int) -> DataFrame:
    """(shelf, doc_id, tag, spans): one row for each text, with its distinct spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shelf = _shelf(batch.column("doc_id").to_numpy(), batch.column("tag").to_numpy(), shelves)
            yield pa.RecordBatch.from_arrays([pa.array(shelf.astype(np.int32)), *batch.columns], names=["shelf", *batch.schema.names])

    return spans.groupBy("doc_id", "tag").agg(F.collect_set("span").alias("spans")).mapInArrow(run, "shelf int, doc_id long, tag long, spans array<long>")


def _by_text(wanted: pa.Table) -> dict[tuple[int, int], list[int]]:
    return {(d, t): s for d, t, s in zip(*(wanted.column(c).to_pylist() for c in ("doc_id", "tag", "spans")), strict=True)}


def passage_hashes(texts: DataFrame, spans: DataFrame, shelves: int) -> DataFrame:
    """(doc_id, tag, span, low, high): 128 bits of the words of each distinct span (doc_id, tag, span)."""

    def run(shelf: pa.Table, wanted: pa.Table) -> pa.Table:
        asked, out = _by_text(wanted), []
        for batch in _unpacked(shelf) if asked else ():
            raw, offsets = K.string_parts(batch.column("__text"))
            for i, (d, t) in enumerate(zip(batch.column("__key").to_pylist(), batch.column("__tag").to_pylist(), strict=True)):
                # of repeated rows one answers
                own = asked.pop((d, t), None)
                if own:
                    r = raw[offsets[i] : offsets[i + 1]]
                    start, end, _ = K.words(r, np.array([0, len(r)]))
                    memory = r.tobytes()
                    for s in own:
                        low, high = s >> 32, s & 0xFFFFFFFF
                        h = xxhash.xxh3_128_intdigest(b" ".join([memory[a:b] for a, b in zip(start[low:high].tolist(), end[low:high].tolist(), strict=True)]))
                        out.append((d, t, s, (h & (1 << 64) - 1) - (1 << 63), (h >> 64) - (1 << 63)))
        return pa.table({n: pa.array([o[k] for o in out], pa.int64()) for k, n in enumerate(("doc_id", "tag", "span", "low", "high"))})

    return texts.groupBy("shelf").cogroup(_on_shelves(spans, shelves).groupBy("shelf")).applyInArrow(run, "doc_id long, tag long, span long, low long, high long")


def coalesced(spans: DataFrame) -> DataFrame:
    """The spans without overlaps: those of one text and owner that lie at one distance and touch are one."""
    shift = F.shiftright("owner_span", 32) - F.shiftright("span", 32)
    keys = ["doc_id", "tag", "owner", "owner_tag", "shift"]
    grouped = spans.withColumn("shift", shift).groupBy(*keys).agg(F.sort_array(F.collect_set("span")).alias("spans"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 20_000):
                part = batch.slice(k, 20_000)
                lists = part.column("spans")
                size = np.diff(lists.offsets.to_numpy())
                value = lists.flatten().to_numpy()
                group = np.repeat(np.arange(len(size)), size)
                start, end = value >> 32, value & 0xFFFFFFFF
                reach = np.maximum.accumulate((group << 32) | end)
                new = np.ones(len(value), bool)
                new[1:] = (group[1:] != group[:-1]) | (start[1:] > (reach[:-1] & 0xFFFFFFFF))
                at = np.flatnonzero(new)
                low, high, own = start[at], (reach & 0xFFFFFFFF)[np.append(at[1:], len(value)) - 1], group[at]
                doc, tag, owner, owner_tag, shift = (part.column(c).to_numpy()[own] for c in keys)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (doc, tag, (low << 32) | high, owner, owner_tag, ((low + shift) << 32) | (high + shift))], names=["doc_id", "tag", "span", "owner", "owner_tag", "owner_span"])

    return grouped.mapInArrow(run, SPANS)


def verified(texts: DataFrame, spans: DataFrame, shelves: int) -> DataFrame:
    """(doc_id, tag, span): the candidate spans whose words are their owner's.

    Spans whose words are not are taken apart; their windows are compared with their owners', and those that differ still
    with each other: fingerprints that stand for several windows hide none of them.
    """
    spans, p_spans = materialise(coalesced(spans), "window-candidates")
    right, wrong, paths = _compared(texts, spans, shelves)
    if wrong.limit(1).count():
        step = F.explode(F.sequence(F.lit(0).cast("long"), (F.col("span").bitwiseAND(0xFFFFFFFF)) - F.shiftright("span", 32) - WINDOW))
        one = lambda c: F.shiftleft(F.shiftright(c, 32) + F.col("k"), 32).bitwiseOR(F.shiftright(c, 32) + F.col("k") + WINDOW)
        windows, p_windows = materialise(wrong.select(*wrong.columns, step.alias("k")).select("doc_id", "tag", one("span").alias("span"), "owner", "owner_tag", one("owner_span").alias("owner_span")).distinct(), "window-disputes")
        same, unlike, more = _compared(texts, windows, shelves, own=True)
        first = unlike.groupBy("low", "high").agg(F.min(F.struct("doc_id", "tag", "span")).alias("first"))
        again = unlike.join(first, ["low", "high"]).where(F.struct("doc_id", "tag", "span") != F.col("first"))
        right = right.unionByName(same.select("doc_id", "tag", "span")).unionByName(again.select("doc_id", "tag", "span"))
        paths += [*more, p_windows]
    out, _ = materialise(right.distinct(), "window-verified")
    release(texts.sparkSession, p_spans, *paths)
    return out


def _compared(texts: DataFrame, spans: DataFrame, shelves: int, own: bool = False) -> tuple[DataFrame, DataFrame, list[str]]:
    """(spans whose words are their owner's, the others with all columns and, if `own`, the hash of their words, tables)."""
    asked = spans.select("doc_id", "tag", "span").unionByName(spans.select(F.col("owner").alias("doc_id"), F.col("owner_tag").alias("tag"), F.col("owner_span").alias("span")))
    found, path = materialise(passage_hashes(texts, asked, shelves), "window-words")
    theirs = found.select(F.col("doc_id").alias("owner"), F.col("tag").alias("owner_tag"), F.col("span").alias("owner_span"), F.col("low").alias("_low"), F.col("high").alias("_high"))
    both, p_both = materialise(spans.join(found, ["doc_id", "tag", "span"]).join(theirs, ["owner", "owner_tag", "owner_span"]).withColumn("same", (F.col("low") == F.col("_low")) & (F.col("high") == F.col("_high"))), "window-compared")
    return both.where("same").select("doc_id", "tag", "span"), both.where("NOT same").select(*spans.columns, *(["low", "high"] if own else [])), [path, p_both]


def find_spans(docs: DataFrame, batches: list[int] | None = None, doc_id: str = "doc_id", text: str = "text", bucket_windows: int = BUCKET_WINDOWS, hot_entries: int = HOT_ENTRIES, width: int = PRINT_BYTES, surveyed: tuple[int, np.ndarray] | None = None) -> DataFrame:
    """(doc_id, tag, span, owner, owner_tag, owner_span) of the words that seem repeated. batches: ascending doc_ids at which
    a new batch begins."""
    spark = docs.sparkSession
    n_bytes, hot = surveyed or survey(docs, doc_id, text, hot_entries)
    index = FingerprintIndex(spark, max(12, int(n_bytes / 6.2 / bucket_windows) + 1), hot=hot, width=width)
    key = F.col(doc_id)
    edges = [None, *(batches or []), None]
    out = None
    for low, high in zip(edges, edges[1:], strict=False):
        part = docs
        if low is not None:
            part = part.where((key >= low) if high is not None else (key >= low) | key.isNull())
        if high is not None:
            part = part.where(key < high)
        found = index.add(part, last=high is None, doc_id=doc_id, text=text)
        out = found if out is None else out.unionByName(found)
    index.close()
    return out


def quantile_batches(docs: DataFrame, shares: list[float], doc_id: str = "doc_id") -> list[int]:
    found = docs.select(F.col(doc_id).cast("long").alias("d")).approxQuantile("d", shares, 0.01)
    return sorted({int(x) for x in found})


def remove_repeats(docs: DataFrame, keep: list[str], share: float = 0.2, doc_id: str = "doc_id", text: str = "text", shelf_bytes: int = SHELF_BYTES, hot_entries: int = HOT_ENTRIES, **how) -> DataFrame:
    """The columns `keep` with `n_words`, `n_removed`, `kept_text` and the removed spans of each document.

    The first `share` of the documents by doc_id comes in FAN_IN batches, whose runs are compacted; the others are merged with
    that run.
    """
    keep = [c for c in keep if c not in ("n_words", "n_removed", "kept_text", "removed")]
    surveyed = survey(docs, doc_id, text, hot_entries)
    shelves = max(8, surveyed[0] // shelf_bytes + 1)
    batches = quantile_batches(docs, [share * (k + 1) / FAN_IN for k in range(FAN_IN)], doc_id) if share else []
    candidates = find_spans(docs, batches, doc_id, text, surveyed=surveyed, **how)
    spans = verified(packed(docs, [], shelves, doc_id, text), candidates, shelves)
    texts = packed(docs, [F.struct(*keep).alias("__row")], shelves, doc_id, text)
    schema = docs.select(F.struct(*keep).alias("__row")).schema.add("n_words", "long").add("n_removed", "long").add("kept_text", "string").add("removed", REMOVED)
    kind = pa.list_(pa.struct([("from_word", pa.int32()), ("to_word", pa.int32())]))

    def cut(batch: pa.RecordBatch, asked: dict) -> Iterator[pa.RecordBatch]:
        raw, offsets = K.string_parts(batch.column("__text"))
        keys = list(zip(batch.column("__key").to_pylist(), batch.column("__tag").to_pylist(), strict=True))
        for i, j, r, o in K.chunks(raw, offsets):
            start, end, doc = K.words(r, o)
            n = np.bincount(doc, minlength=j - i)
            first = np.cumsum(n) - n
            gone, texts, removed = np.zeros(j - i, np.int64), [], []
            memory = r.tobytes()
            for k in range(j - i):
                own = asked.get(keys[i + k])
                s, e = start[first[k] : first[k] + n[k]], end[first[k] : first[k] + n[k]]
                found: list[dict] = []
                if own:
                    step = np.zeros(n[k] + 1, np.int64)
                    spans = np.array(own, np.int64)
                    np.add.at(step, spans >> 32, 1)
                    np.add.at(step, spans & 0xFFFFFFFF, -1)
                    out = np.cumsum(step[:-1]) > 0
                    gone[k] = out.sum()
                    edge = np.flatnonzero(np.diff(np.concatenate([[0], out.view(np.int8), [0]])))
                    found = [{"from_word": a, "to_word": b} for a, b in zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True)]
                    s, e = s[~out], e[~out]
                removed.append(found)
                texts.append(b" ".join([memory[a:b] for a, b in zip(s.tolist(), e.tolist(), strict=True)]).decode())
            yield pa.RecordBatch.from_arrays([batch.column("__row").slice(i, j - i), pa.array(n.astype(np.int64)), pa.array(gone), pa.array(texts, pa.string()), pa.array(removed, kind)], names=["__row", "n_words", "n_removed", "kept_text", "removed"])

    def run(shelf: pa.Table, wanted: pa.Table) -> pa.Table:
        asked = _by_text(wanted)
        parts = [p for batch in _unpacked(shelf) for p in cut(batch, asked)]
        return pa.Table.from_batches(parts) if parts else to_arrow_schema(schema).empty_table()

    out = texts.groupBy("shelf").cogroup(_on_shelves(spans, shelves).groupBy("shelf")).applyInArrow(run, schema)
    return out.select(*[F.col("__row")[c].alias(c) for c in keep], "n_words", "n_removed", "kept_text", "removed")


def dedup_documents(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", **how) -> DataFrame:
    """docs with the repeated words taken out of the texts. Texts that lose nothing stay as they are, white space included."""
    whole = docs.select(F.struct(*docs.columns).alias("__doc"), F.col(doc_id).alias("__id"), F.col(text).alias("__body"))
    out = remove_repeats(whole, ["__doc"], doc_id="__id", text="__body", **how)
    kept = F.when(F.col("n_removed") == 0, F.col("__doc")[text]).otherwise(F.col("kept_text"))
    return out.select(*[(kept if c == text else F.col("__doc")[c]).alias(c) for c in docs.columns])
