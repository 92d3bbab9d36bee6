"""Toxicity by compression distance (operator 9).

Separate zstandard dictionaries are trained on labelled rows: one on windows of ordinary text, and on toxic text a narrow one
(what ordinary rows hardly have) and a broad one (what toxic rows have more often). A document is cut into windows of WORDS
words, and each window is compressed with all; where a toxic dictionary saves bytes against the ordinary one, the window shares
strings with toxic text. Savings become a score by a logistic calibration, whose threshold is 0.5.

Most of a toxic document is ordinary text. A dictionary trained on all of it learns ordinary strings, and windows differ by
chance: with whole windows as samples, refined by cross-fitting in up to 8 rounds, the area under the curve was at most 0.91
on the check table. So the toxic dictionaries are trained on what ordinary rows leave of toxic ones: the strings in their words
whose 5-byte grams are over-represented, text by text, as often as they occur. They stand behind the ordinary dictionary, so
that ordinary strings cost the same with both.

Rows are split by a hash of doc_id: dictionaries learn from LEARN tenths of them, the calibration from the others. Bounds, all
parameters of labelled() and fit(): LABELLED_ROWS labelled rows a class, chosen by a hash of doc_id before any text is read;
about BASE_ROWS ordinary rows, whose windows of up to WINDOW_BYTES are the ordinary samples, about BASE_WINDOWS of them;
FRAGMENTS different strings, and DICTIONARY bytes of ordinary and TOXIC_BYTES of toxic text in a dictionary (longer ones make
references to ordinary strings dearer). Gram statistics cover all rows of the sample; counts of at
most 2 ** BITS hashed grams reach the driver. A class that is sampled is weighted back in the calibration.

Defined results: null and empty texts have no windows and get the score of a text without savings; so does every text if a
class has no training rows (score 0 then). A label that is null, and a doc_id that is null, are not learned from. Rows are
scored one by one, so repeated rows get equal scores; an empty table gives an empty result; extra columns, lang, source and
doc_id are no inputs of a score, a column named like it is replaced. Memory is bounded by the longest text.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .decontaminate import lowered
from .storage import materialise, release

WORDS = 8
BITS, GRAM = 20, 5
LABELLED_ROWS, LEARN = 40_000, 7
FRAGMENTS, DICTIONARY, TOXIC_BYTES = 400, 1 << 15, 1 << 11
BASE_ROWS, BASE_WINDOWS, WINDOW_BYTES = 4000, 20_000, 512
LEAST_SCORE, LEAST_DOCS = 8.0, 5
#: Log odds from which a gram is over-represented, of the narrow and of the broad toxic dictionary.
LIFTS = (3.0, 0.8)


def normal_form(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, word starts, word ends, text numbers): lower-cased words, each between two blanks."""
    start, end, doc = K.words(raw, offsets)
    size = end - start
    at = np.cumsum(size + 1) - size
    line = np.full(int((size + 1).sum()) + 1, 32, np.uint8)
    own = np.arange(int(size.sum()))
    line[np.repeat(at - (np.cumsum(size) - size), size) + own] = lowered(raw)[np.repeat(start - (np.cumsum(size) - size), size) + own]
    return line, at, at + size, doc


def word_grams(line: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word number, position, hash) of the grams inside each word with the blanks around it."""
    n = np.maximum(end - start + 2 - GRAM + 1, 0)
    word = np.repeat(np.arange(len(start)), n)
    at = np.repeat(start - 1 - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    code = np.zeros(len(at), K.U)
    for k in range(GRAM):
        code = code * K.U(257) + line[at + k]
    return word, at, (K.mix(code) >> K.U(64 - BITS)).astype(np.int64)


def _unique_words(line: np.ndarray, start: np.ndarray, end: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """One of the equal words of each text."""
    key = K.mix(K.span_hashes(line, start, end) + doc.astype(K.U) * K.U(0x9E3779B97F4A7C15))
    return np.sort(np.unique(key, return_index=True)[1])


def gram_statistics(rows: DataFrame) -> DataFrame:
    """(gram, ordinary, toxic, docs) over rows (text, toxic): different words of a document that have the gram."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((3, 1 << BITS), np.int64)
        for batch in batches:
            raw, offsets = K.string_parts(batch.column("text"))
            toxic = batch.column("toxic").to_numpy(zero_copy_only=False).astype(np.int64)
            for i, j, r, o in K.chunks(raw, offsets):
                line, start, end, doc = normal_form(r, o)
                one = _unique_words(line, start, end, doc)
                word, _, gram = word_grams(line, start[one], end[one])
                owner = doc[one][word]
                bad = toxic[i:j][owner] == 1
                total[0] += np.bincount(gram[~bad], minlength=1 << BITS)
                total[1] += np.bincount(gram[bad], minlength=1 << BITS)
                total[2] += np.bincount(np.unique((owner[bad] << BITS) | gram[bad]) & ((1 << BITS) - 1), minlength=1 << BITS)
        at = np.flatnonzero(total.any(axis=0))
        for k in range(0, len(at), 50_000):
            part = at[k : k + 50_000]
            yield pa.RecordBatch.from_arrays([pa.array(part), *(pa.array(t[part]) for t in total)], names=["gram", "ordinary", "toxic", "docs"])

    return rows.select("text", "toxic").mapInArrow(run, "gram long, ordinary long, toxic long, docs long").groupBy("gram").agg(*[F.sum(c).alias(c) for c in ("ordinary", "toxic", "docs")])


def strong_grams(stats, lift: float = LIFTS[0]) -> np.ndarray:
    """Hashes of the grams over-represented in toxic rows, from a pandas frame of gram_statistics."""
    o, t = stats["ordinary"].to_numpy(float), stats["toxic"].to_numpy(float)
    if not o.sum() or not t.sum():
        return np.zeros(0, np.int64)
    expected = (o + 0.5) * t.sum() / o.sum()
    keep = (stats["docs"].to_numpy() >= LEAST_DOCS) & ((t - expected) / np.sqrt(expected + 1) > LEAST_SCORE) & (np.log((t + 0.5) / expected) > lift)
    return np.sort(stats["gram"].to_numpy()[keep])


def fragments(rows: DataFrame, strong: np.ndarray) -> DataFrame:
    """(fragment, n) of rows (text): the part of each word that strong grams cover."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = K.string_parts(batch.column("text"))
            count: Counter[bytes] = Counter()
            for _, _, r, o in K.chunks(raw, offsets):
                line, start, end, _ = normal_form(r, o)
                word, at, gram = word_grams(line, start, end)
                hit = np.isin(gram, strong)
                word, at = word[hit], at[hit]
                edge = np.flatnonzero(np.diff(word, prepend=-1))
                if len(edge):
                    last = np.append(edge[1:], len(word)) - 1
                    count.update(line[a : b + GRAM].tobytes() for a, b in zip(at[edge].tolist(), at[last].tolist(), strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(list(count), pa.binary()), pa.array(list(count.values()), pa.int64())], names=["fragment", "n"])

    return rows.select("text").mapInArrow(run, "fragment binary, n long").groupBy("fragment").agg(F.sum("n").alias("n"))


def residues(rows: DataFrame, known: list[bytes], longest: int = WINDOW_BYTES) -> DataFrame:
    """(window) of rows (text): of each text the strings `known` that its words hold, as often as they do, joined to pieces of
    about `longest` bytes. What is left of a toxic text without what it shares with ordinary ones."""
    strings = sorted(known, key=len, reverse=True)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = regex.compile(b"|".join(regex.escape(x) for x in strings)) if strings else None
        for batch in batches:
            raw, offsets = K.string_parts(batch.column("text"))
            out = []
            for _, _, r, o in K.chunks(raw, offsets) if tool else ():
                line, start, end, doc = normal_form(r, o)
                for d in np.unique(doc).tolist():
                    own = np.flatnonzero(doc == d) if len(o) == 2 else np.arange(*np.searchsorted(doc, [d, d + 1]))
                    whole = b"".join(tool.findall(line[start[own[0]] - 1 : end[own[-1]] + 1].tobytes(), overlapped=True))
                    out += [whole[i : i + longest] for i in range(0, len(whole), longest)]
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["window"])

    return rows.select("text").mapInArrow(run, "window binary")


def windows(rows: DataFrame, longest: int = WINDOW_BYTES) -> DataFrame:
    """(window) of rows (text): their windows of at most `longest` bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, offsets = K.string_parts(batch.column("text"))
            for _, _, r, o in K.chunks(raw, offsets):
                line, begin, end, _ = _cut(r, o)
                short = end - begin <= longest
                yield pa.RecordBatch.from_arrays([pa.array([line[a:b].tobytes() for a, b in zip(begin[short].tolist(), end[short].tolist(), strict=True)], pa.binary())], names=["window"])

    return rows.select("text").mapInArrow(run, "window binary")


def _cut(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, window starts, window ends, text numbers), blanks at both ends included."""
    line, start, end, doc = normal_form(raw, offsets)
    first = np.searchsorted(doc, np.arange(len(offsets)))
    begin = np.flatnonzero((np.arange(len(doc)) - first[doc]) % WORDS == 0) if len(doc) else np.zeros(0, np.int64)
    owner = doc[begin]
    last = np.minimum(begin + WORDS, first[owner + 1]) - 1
    return line, start[begin] - 1, end[last] + 1, owner


def _collected(rows: DataFrame, bound: int) -> list[bytes]:
    """About `bound` of the windows, by a hash, in a fixed order."""
    rows, path = materialise(rows, "toxic-windows")
    n = rows.count()
    some = rows.where(F.pmod(F.xxhash64(F.lit(9), "window"), F.lit(1_000_000)) < int(1_000_000 * min(1.0, bound / max(n, 1))) + 1).collect()
    release(rows.sparkSession, path)
    return sorted((bytes(r["window"]) for r in some), key=lambda w: (zlib.crc32(w), w))


def trained(samples: list[bytes], size: int) -> bytes:
    """A dictionary of at most `size` bytes trained on the samples; of too few to train on, the samples themselves."""
    try:
        return zstandard.train_dictionary(size, samples, k=64, d=8).as_bytes()
    except (zstandard.ZstdError, ValueError):
        return b"".join(dict.fromkeys(samples))[-size:]


class Meter:
    """Compresses windows with the ordinary and with each toxic dictionary."""

    def __init__(self, ordinary: bytes, toxic: list[bytes]):
        params = zstandard.ZstdCompressionParameters(window_log=17, hash_log=14, chain_log=14, search_log=8, min_match=5, target_length=32, strategy=zstandard.STRATEGY_BTLAZY2, write_content_size=False, write_checksum=False, write_dict_id=False)
        self.tools = []
        for content in (ordinary, *toxic):
            known = zstandard.ZstdCompressionDict(content or b" " * 16, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            known.precompute_compress(compression_params=params)
            self.tools.append(zstandard.ZstdCompressor(dict_data=known, compression_params=params))

    def savings(self, line: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Bytes that each toxic dictionary saves on each span, as (spans, dictionaries)."""
        if not len(start):
            return np.zeros((0, len(self.tools) - 1))
        parts = np.empty((len(start), 2), np.uint64)
        parts[:, 0], parts[:, 1] = start, end - start
        data = zstandard.BufferWithSegments(line.tobytes(), parts.tobytes())
        size = []
        for tool in self.tools:
            done = tool.multi_compress_to_buffer(data)
            size.append(np.fromiter((len(done[k]) for k in range(len(done))), np.int64, len(done)))
        return np.stack([size[0] - x for x in size[1:]], axis=1).astype(float)


FEATURES = 5 * len(LIFTS)


def features(meter: Meter, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(texts, FEATURES): by dictionary the largest saving, sum, sum a window, windows with savings, their share; logarithms."""
    n = len(offsets) - 1
    line, begin, end, owner = _cut(raw, offsets)
    saved = meter.savings(line, begin, end)
    count, columns = np.bincount(owner, minlength=n), []
    for own in saved.T:
        over = np.maximum(own - 1, 0)
        top, total, strong = np.zeros(n), np.bincount(owner, over, minlength=n), np.bincount(owner, over > 1, minlength=n)
        np.maximum.at(top, owner, own)
        columns += [top, total, total / (count + 2), strong, strong / (count + 2)]
    return np.log1p(np.column_stack(columns))


@dataclass
class ToxicityModel:
    ordinary: bytes
    toxic: list[bytes]
    weights: np.ndarray

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -700, 700)))


def calibrate(x: np.ndarray, y: np.ndarray, weight: np.ndarray | None = None, ridge: float = 1e-2, rounds: int = 60) -> np.ndarray:
    """Logistic regression of weighted rows by Newton steps; the last weight is the intercept."""
    x = np.column_stack([x, np.ones(len(x))])
    weight = np.ones(len(y)) if weight is None else weight
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x.T * (weight * p * (1 - p))) @ x + ridge * np.eye(len(w)), x.T @ (weight * (p - y)) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-10:
            break
    return w


def measured(rows: DataFrame, ordinary: bytes, toxic: list[bytes], keep: list[str]) -> DataFrame:
    """The columns `keep` of rows and the array `x` of the features of text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        meter = Meter(ordinary, toxic)
        for batch in batches:
            raw, offsets = K.string_parts(batch.column("__text"))
            for i, j, r, o in K.chunks(raw, offsets):
                yield pa.RecordBatch.from_arrays([*batch.select(keep).slice(i, j - i).columns, pa.array(list(features(meter, r, o)), pa.list_(pa.float64()))], names=[*keep, "x"])

    schema = rows.select(*keep).schema.add("x", _doubles())
    return rows.select(*keep, F.col("text").alias("__text")).mapInArrow(run, schema)


def _doubles():
    from pyspark.sql import types as T

    return T.ArrayType(T.DoubleType())


def labelled(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", bound: int = LABELLED_ROWS) -> DataFrame:
    """(doc_id, text, toxic, weight) of about `bound` labelled documents of each class at most, by a hash of doc_id.

    The sampled labels are few by that bound, so they go to the documents where these lie.
    """
    known = labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    share, weight = F.lit(0.0), F.lit(1.0)
    for value, n in sorted(counts.items()):
        share = F.when(F.col("toxic") == value, F.lit(min(1.0, bound / n))).otherwise(share)
        weight = F.when(F.col("toxic") == value, F.lit(max(1.0, n / bound))).otherwise(weight)
    few = known.where(F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(1_000_000)) < share * 1_000_000).withColumn("weight", weight)
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(few), "doc_id")


def fit(rows: DataFrame, fragments_bound: int = FRAGMENTS, dictionary: int = DICTIONARY, toxic_bytes: int = TOXIC_BYTES, base_rows: int = BASE_ROWS, base_windows: int = BASE_WINDOWS) -> ToxicityModel:
    """A model from rows (doc_id, text, toxic, weight)."""
    spark = rows.sparkSession
    rows, path = materialise(rows.where(F.col("text").isNotNull()), "toxic-train")
    learn = F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(10)) < LEARN
    own = rows.where(learn)
    stats = gram_statistics(own).toPandas()
    share = base_rows / max(own.where("toxic = 0").count(), 1)
    base = own.where("toxic = 0").where(F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(1_000_000)) < int(1_000_000 * min(1.0, share)) + 1)
    ordinary, toxic = trained(_collected(windows(base), base_windows), dictionary), []
    for lift in LIFTS:
        top = fragments(own.where("toxic = 1"), strong_grams(stats, lift)).where("n >= 4").orderBy(F.desc("n"), "fragment").limit(fragments_bound).collect()
        left = residues(own.where("toxic = 1"), [bytes(r["fragment"]) for r in top])
        # short texts are ignored by the trainer
        toxic.append(ordinary + trained(_collected(left.where(F.length("window") > 8), base_windows), toxic_bytes))
    sample = measured(rows.where(~learn), ordinary, toxic, ["doc_id", "toxic", "weight"]).toPandas().sort_values("doc_id")
    release(spark, path)
    y = sample["toxic"].to_numpy(float)
    if not len(y) or y.min() == y.max():
        return ToxicityModel(ordinary, toxic, np.append(np.zeros(FEATURES), -30.0))
    return ToxicityModel(ordinary, toxic, calibrate(np.stack(sample["x"].to_list()), y, sample["weight"].to_numpy(float)))


def score(docs: DataFrame, model: ToxicityModel, keep: list[str], text: str = "text") -> DataFrame:
    """The columns `keep` with `score`, the calibrated probability of the toxic label. One pass, no shuffle."""
    keep = [c for c in keep if c != "score"]
    schema = docs.select(*keep).schema.add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        meter = Meter(model.ordinary, model.toxic)
        for batch in batches:
            raw, offsets = K.string_parts(batch.column("__text"))
            for i, j, r, o in K.chunks(raw, offsets):
                yield pa.RecordBatch.from_arrays([*batch.select(keep).slice(i, j - i).columns, pa.array(model.score(features(meter, r, o)))], names=[*keep, "score"])

    return docs.select(*keep, F.col(text).alias("__text")).mapInArrow(run, schema)
