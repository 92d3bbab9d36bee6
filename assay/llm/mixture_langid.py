"""Language identification as mixture inference (operator 8).

Words are runs of Unicode letters with their combining marks. Hashed 4-byte grams of lower-cased words are counted per language over all labelled training rows; the counts are summed
by the cluster and bounded by (languages) * 2 ** BITS, whatever the corpus. A word's likelihood in a language is the product
of its grams' smoothed probabilities. For each document expectation-maximisation estimates the proportion of its words in
each language; then languages are given up one by one, weakest first, as long as the likelihood penalised by
PENALTY * ln(words) a language does not fall. The prediction is the language with the largest proportion, its score that
proportion.

Defined results: a null text or one without a letter is "und" with score 0, as is every text if nothing can be learned
(no labelled row, empty table). A null doc_id is neither learned from nor held out. Ties go to the language first in code
point order. Extra columns, `lang` and `source` are no inputs of a prediction; columns named like an output are replaced.
Equal words of a text are one row of its mixture with their number as weight, so memory follows a text's different words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import kernels as K
from .decontaminate import lowered

BITS, GRAM = 16, 4
SMOOTHING = 0.5
PENALTY = 1.5
FULL_ROUNDS, SHORT_ROUNDS = 12, 5
UNKNOWN = "und"


def grams(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(word number, hashed gram) of all grams of the different words of each text, padded by blanks; the text number of each
    word, and how often the text has it."""
    low = lowered(raw)
    bits = K.byte_classes(raw)
    start, end = K.runs((bits & (K.LETTER | K.MARK)) > 0, offsets)
    letters = np.flatnonzero(bits & K.LETTER)
    full = np.searchsorted(letters, start) < np.searchsorted(letters, end)
    start, end = start[full], end[full]
    doc = np.searchsorted(offsets, start, "right") - 1
    key = K.mix(K.span_hashes(low, start, end) + doc.astype(K.U) * K.U(0x9E3779B97F4A7C15))
    _, first, times = np.unique(key, return_index=True, return_counts=True)
    by = np.argsort(first)
    start, end, doc, times = start[first[by]], end[first[by]], doc[first[by]], times[by]
    # words laid out with two blanks before and one after them
    size = end - start
    at = np.cumsum(size + 3) - size - 1
    line = np.full(int((size + 3).sum()) + GRAM, 32, np.uint32)
    inside = np.repeat(at - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    line[inside] = low[np.repeat(start - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]
    n = len(line) - GRAM
    code = (line[:n] << np.uint32(24)) | (line[1 : n + 1] << np.uint32(16)) | (line[2 : n + 2] << np.uint32(8)) | line[3 : n + 3]
    hashed = ((code.astype(np.uint32) * np.uint32(2654435761)) >> np.uint32(32 - BITS)).astype(np.int64)
    # a word of s bytes has s grams: those that begin at its two blanks and at its bytes but the last two
    word = np.repeat(np.arange(len(size)), size)
    begin = np.repeat(at - 2 - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
    return word, hashed[begin] if len(begin) else np.zeros(0, np.int64), doc, times


def learnable(doc_id: str, parts: int, held: int) -> tuple[Column, Column]:
    """(rows to learn from, rows held out) by crc32 of doc_id as text."""
    rest = F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(parts))
    return F.coalesce(rest != held, F.lit(False)), F.coalesce(rest == held, F.lit(False))


def gram_counts(rows: DataFrame, label: str, text: str) -> DataFrame:
    """(label, gram, n) over all rows with a label; each task sends its own sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            raw, offsets = K.string_parts(batch.column("text"))
            labels = np.array(batch.column("label").to_pylist(), object)
            for i, j, r, o in K.chunks(raw, offsets):
                word, gram, doc, times = grams(r, o)
                weight = times[word]
                own = labels[i:j][doc[word]] if len(word) else np.zeros(0, object)
                for name in set(labels[i:j]):
                    total[name] = total.get(name, 0) + np.bincount(gram[own == name], weight[own == name], minlength=1 << BITS)
        for name in sorted(total):
            at = np.flatnonzero(total[name])
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at), pa.array(total[name][at].astype(np.int64))], names=["label", "gram", "n"])

    source = rows.select(F.col(label).alias("label"), F.col(text).alias("text")).where("label IS NOT NULL AND text IS NOT NULL")
    return source.mapInArrow(run, "label string, gram long, n long").groupBy("label", "gram").agg(F.sum("n").alias("n"))


@dataclass
class GramModel:
    names: list[str]
    log_p: np.ndarray  # (grams, languages), float32

    def predict(self, raw: np.ndarray, offsets: np.ndarray) -> tuple[list[str], np.ndarray, np.ndarray]:
        """(language, score, proportions) of each text."""
        n, k = len(offsets) - 1, len(self.names)
        if not k:
            return [UNKNOWN] * n, np.zeros(n), np.zeros((n, 0))
        word, gram, doc, times = grams(raw, offsets)
        share = np.zeros((n, k))
        if len(word):
            edge = np.flatnonzero(np.diff(word, prepend=-1))
            like = np.add.reduceat(self.log_p[gram], edge, axis=0).astype(np.float64)
            like -= like.max(axis=1, keepdims=True)
            share = mixtures(np.exp(like), doc, n, times)
        pick = share.argmax(axis=1)
        score = share.max(axis=1)
        lang = [self.names[p] if s > 0 else UNKNOWN for p, s in zip(pick.tolist(), score.tolist(), strict=True)]
        return lang, np.clip(score, 0, 1), share


def mixtures(like: np.ndarray, doc: np.ndarray, n: int, times: np.ndarray | None = None) -> np.ndarray:
    """Proportions of the languages for each of n texts, from the relative likelihoods of their words and how often they occur."""
    k = like.shape[1]
    times = np.ones(len(doc)) if times is None else times.astype(float)
    used, first, rows = np.unique(doc, return_index=True, return_counts=True)
    own = np.repeat(np.arange(len(used)), rows)
    size = np.bincount(own, times)

    def climb(share: np.ndarray, rounds: int, take: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        some = slice(None) if take is None else take[own]
        data, weight = like[some], times[some]
        total, n_rows = (size, rows) if take is None else (size[take], rows[take])
        begin = np.cumsum(n_rows) - n_rows
        who = np.repeat(np.arange(len(n_rows)), n_rows)
        for _ in range(rounds):
            part = data * share[who]
            part *= (weight / (part.sum(axis=1) + 1e-300))[:, None]
            share = np.add.reduceat(part, begin, axis=0) / total[:, None]
        value = np.add.reduceat(weight * np.log((data * share[who]).sum(axis=1) + 1e-300), begin)
        return share, value

    share, value = climb(np.full((len(used), k), 1.0 / k), FULL_ROUNDS)
    cost = PENALTY * np.log(size + 1.0)
    going = (share > 0).sum(axis=1) > 1
    while going.any():
        weakest = np.where(share > 0, share, 2.0).argmin(axis=1)
        less = share.copy()
        less[np.arange(len(used)), weakest] = 0
        less /= less.sum(axis=1, keepdims=True) + 1e-300
        tried, new = climb(less[going], SHORT_ROUNDS, going)
        better = new + cost[going] >= value[going]
        at = np.flatnonzero(going)
        share[at[better]], value[at[better]] = tried[better], new[better]
        going[at[~better]] = False
        going &= (share > 0).sum(axis=1) > 1
    out = np.zeros((n, k))
    out[used] = share
    return out


def fit(rows: DataFrame, label: str = "lang", text: str = "text") -> GramModel:
    """A model of all labels in rows. The counts that reach the driver are at most (labels) * 2 ** BITS."""
    counts = gram_counts(rows, label, text).toPandas()
    names = sorted(counts["label"].unique().tolist())
    table = np.zeros((1 << BITS, len(names)))
    if names:
        table[counts["gram"].to_numpy(), np.searchsorted(np.array(names, object), counts["label"].to_numpy())] = counts["n"].to_numpy()
    used = max(int((table.sum(axis=1) > 0).sum()), 1)
    return GramModel(names, np.log((table + SMOOTHING) / (table.sum(axis=0) + SMOOTHING * used)).astype(np.float32))


def identify(docs: DataFrame, model: GramModel, keep: list[str], text: str = "text", proportions: bool = False) -> DataFrame:
    """The columns `keep` with lang_pred, score and, if asked for, the proportions of all languages."""
    keep = [c for c in keep if c not in ("lang_pred", "score", "mixture")]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    schema = docs.select(*keep).schema.add("lang_pred", "string").add("score", "double")
    if proportions:
        from pyspark.sql import types as T

        schema = schema.add("mixture", T.MapType(T.StringType(), T.DoubleType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = shared.value
        limit = max(1 << 14, K.CHUNK * 4 // max(4, len(found.names)))
        for batch in batches:
            raw, offsets = K.string_parts(batch.column("__text"))
            for i, j, r, o in K.chunks(raw, offsets, limit):
                lang, score, share = found.predict(r, o)
                columns = [*batch.select(keep).slice(i, j - i).columns, pa.array(lang, pa.string()), pa.array(score)]
                names = [*keep, "lang_pred", "score"]
                if proportions:
                    columns.append(pa.array([[(a, float(b)) for a, b in zip(found.names, row, strict=True) if b > 0] for row in share], pa.map_(pa.string(), pa.float64())))
                    names.append("mixture")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(*keep, F.col(text).alias("__text")).mapInArrow(run, schema)
