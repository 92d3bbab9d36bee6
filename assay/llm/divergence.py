"""Audit of how far the sources of one language differ in their words (operator 11), as relational steps over counts.

Terms are runs of ASCII letters and of all characters beyond ASCII, with A-Z in lower case. A language keeps the terms that at
least LEAST of its documents hold; each of its sources, and the language itself, gives each kept term a smoothed share in
billionths, p = 1 + floor(10^9 * (count + 1) / (all counts + kept terms)). Where q is another share of the same term, the
term counts f = floor((p - q)^2 / q). All of it is integer arithmetic: products that a long may not hold are decimals.

1. One pass over the texts counts occurrences and documents by (lang, source, term) within each Arrow batch; the counts of all
   batches are added up by a grouping. A row without a term keeps groups that have no terms at all.
2. The vocabulary of each language, its sums, and the sums of each group.
3. Groups are crossed with the vocabulary of their language by an equi-join on (lang, part of the vocabulary), of which there
   are PARTS, so that no language lands in one task; counts that are missing are 0.
4. Shares of one term meet in a self-join on the number of (lang, term), in which each pair of sources occurs once and yields both of its
   directions. Each key has one row a source, so no key is hotter than another.
5. Ranks: all other sources of a group, and its first TOP terms, of which each task passes on TOP a group at most.

The steps are cut by tables in the shared folder; only the result's table stays.

Defined results: null text, language and source are read as ''; a text without terms still makes its group occur; every row is
a document, repeated rows too; equal values are ranked by item in the order of its UTF-8 bytes; a language without kept terms
has pairs of value 0 and no terms; a single source has no pairs; an empty table gives an empty result; other columns take no
part; very long texts count whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import kernels as K
from .storage import materialise, release

LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
#: Bytes of terms: [^\x00-\x40\x5B-\x60\x7B-\x7F] in UTF-8.
LETTERS = (LOWER >= 0x80) | ((LOWER >= ord("a")) & (LOWER <= ord("z")))
#: Bytes of text that are counted at once.
CHUNK = 8 << 20
CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST = 3
TOP = 200
#: Parts of each language's vocabulary in the join that densifies it.
PARTS = 64
SCALE = 1_000_000_000


def ascii_lower(text: str | Column) -> Column:
    """A-Z in lower case, everything else as it is. Texts of ASCII alone take the faster built-in."""
    t = F.col(text) if isinstance(text, str) else text
    return F.when(F.octet_length(t) == F.char_length(t), F.lower(t)).otherwise(F.translate(t, CAPITALS, SMALL))


def _counted(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The counts of one batch (lang, source, text), whole texts of about CHUNK bytes at a time; strings are compared, not hashes."""
    raw, offsets = K.string_parts(batch.column("text"))
    for i, j, r, o in K.chunks(raw, offsets, CHUNK):
        lang, source = (batch.column(c).slice(i, j - i).dictionary_encode() for c in ("lang", "source"))
        group = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
        inside = LETTERS[r]
        start, end = K.runs(inside, o)
        ends = np.append(0, np.cumsum(end - start)).astype(np.int32)
        found = pa.StringArray.from_buffers(len(start), pa.py_buffer(ends), pa.py_buffer(LOWER[r[inside]])).dictionary_encode()
        size = max(1, len(found.dictionary))
        doc = np.searchsorted(o, start, "right") - 1
        held, times = np.unique(doc * size + found.indices.to_numpy(), return_counts=True)
        key, at = np.unique(group[held // size] * size + held % size, return_inverse=True)
        n, df = np.bincount(at, times, len(key)).astype(np.int64), np.bincount(at, minlength=len(key))
        marks = np.unique(group)
        term = pa.concat_arrays([found.dictionary.take(pa.array(key % size)), pa.array([""] * len(marks), pa.string())])
        group, zero = np.append(key // size, marks), np.zeros(len(marks), np.int64)
        names = [x.dictionary.take(pa.array(k)) for x, k in ((lang, group // len(source.dictionary)), (source, group % len(source.dictionary)))]
        yield pa.RecordBatch.from_arrays([*names, term, pa.array(np.append(n, zero)), pa.array(np.append(df, zero))], names=["lang", "source", "term", "n", "df"])


def term_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(lang, source, term, n, df): occurrences in a group, and how many of its documents hold the term. Term '' marks groups."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from _counted(batch)

    found = docs.select(blank("lang"), blank("source"), F.col(text).alias("text")).mapInArrow(run, "lang string, source string, term string, n long, df long")
    return found.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def share(n: str, total: str, terms: str) -> Column:
    """1 + floor(SCALE * (n + 1) / (total + terms)), exactly: the product is a decimal of at most 30 digits."""
    return F.expr(f"1 + CAST({SCALE} AS DECIMAL(10, 0)) * CAST({n} + 1 AS DECIMAL(19, 0)) div CAST({total} + {terms} AS DECIMAL(19, 0))")


def excess(p: str, q: str) -> Column:
    """floor((p - q)^2 / q) of shares, which are at least 1 and at most SCALE + 1, so that the square fits a long."""
    return F.expr(f"({p} - {q}) * ({p} - {q}) div {q}")


def _dense(vocabulary: DataFrame, groups: DataFrame, kept: DataFrame) -> DataFrame:
    """(term_id, lang, source, p): the share of every kept term in every group of its language."""
    part = F.pmod(F.xxhash64("term"), F.lit(PARTS)).cast("int")
    each = groups.select("lang", "source", "total", "terms", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))).alias("_part"))
    crossed = vocabulary.select("lang", "term_id", part.alias("_part")).join(each, ["lang", "_part"])
    counted = crossed.join(kept.select("term_id", "source", "n"), ["term_id", "source"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return counted.select("term_id", "lang", "source", share("n", "total", "terms").alias("p"))


def audit(docs: DataFrame, text: str = "text", least: int = LEAST, top: int = TOP) -> DataFrame:
    """(lang, source, part, item, value, rank), as the module's docstring says."""
    spark = docs.sparkSession
    counts, p_counts = materialise(term_counts(docs, text), "divergence-counts")
    all_terms = counts.where("term <> ''").groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("df").alias("df"))
    # term_id stands for (lang, term) in the joins below; the numbers are those of the table once it is written
    numbered = all_terms.where(F.col("df") >= least).select("lang", "term", "lang_n", F.monotonically_increasing_id().alias("term_id"))
    vocabulary, p_vocabulary = materialise(numbered, "divergence-vocabulary")
    kept, p_kept = materialise(counts.where("term <> ''").select("lang", "source", "term", "n").join(vocabulary, ["lang", "term"]), "divergence-kept")
    sums = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = vocabulary.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("lang_n").alias("lang_total"))
    groups = counts.where("term = ''").select("lang", "source").join(sums, ["lang", "source"], "left").join(langs, "lang", "left")
    groups, p_groups = materialise(groups.fillna(0, ["total", "terms", "lang_total"]), "divergence-groups")

    dense = _dense(vocabulary, groups, kept)
    met = dense.withColumnsRenamed({"source": "a", "p": "pa"}).join(dense.withColumnsRenamed({"source": "b", "p": "pb"}).drop("lang"), "term_id").where("a < b")
    far = met.groupBy("lang", "a", "b").agg(F.sum(excess("pa", "pb")).alias("ab"), F.sum(excess("pb", "pa")).alias("ba"))
    names = groups.select("lang", F.col("source").alias("a")).join(groups.select("lang", F.col("source").alias("b")), "lang").where("a < b")
    both = F.array(F.struct(F.col("a").alias("source"), F.col("b").alias("item"), F.col("ab").alias("value")), F.struct(F.col("b").alias("source"), F.col("a").alias("item"), F.col("ba").alias("value")))
    pairs = names.join(far, ["lang", "a", "b"], "left").fillna(0, ["ab", "ba"]).select("lang", F.inline(both))

    shares = kept.join(groups, ["lang", "source"]).select("lang", "source", F.col("term").alias("item"), share("n", "total", "terms").alias("p"), share("lang_n", "lang_total", "terms").alias("q"))
    terms = shares.where("p > q").select("lang", "source", "item", excess("p", "q").alias("value"))

    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), F.col("item"))
    ranked = lambda rows, part: rows.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    out, _ = materialise(ranked(pairs, "pair").unionByName(ranked(terms, "term").where(F.col("rank") <= top)), "divergence")
    release(spark, p_counts, p_vocabulary, p_kept, p_groups)
    return out
