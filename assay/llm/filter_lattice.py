"""Audit of how filters overlap and what each order of them removes (operator 12), by lattice-edge aggregation.

What a filter removes depends only on the set of filters applied before it, not on their order. The sets of five filters form a
lattice of 32 nodes, and each of its 80 edges (set applied, next filter) takes part in many of the 120 orders. A document has
one mask, the set of filters that it fails, and adds to each edge: it is still there if its mask and the applied set share
nothing. So documents are counted by (part, mask) first, which tasks do before anything is shuffled, then each of the at most
32 counts a part adds to its 80 edges, and the 600 (order, step) rows of a part look their edges up.

The five filters of documents are at `failures`. Four depend on the text alone; E, being a copy of a document with a smaller
doc_id, needs all texts: they are compared by their SHA-256, of which a table without the texts is kept in the shared folder.
Of hashes that occur more than once the smallest doc_id goes to the others by a plain equi-join, whose tables both are shuffled
for it, so that adaptive execution can split the copies of one text.

Defined results: null text is empty, and equal to other empty texts; a null doc_id has no place in the order, so such a row is
nobody's copy and nobody is its copy; rows that share doc_id and text are documents of their own, none a copy of the other; null
and '' are one part; of several label rows of a document it is enough that one says 1; an empty table gives an empty result;
other columns take no part; very long texts count whole.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations, permutations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .storage import materialise, release

WORD = r"[^\x20\x09-\x0D]+"
FILTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 200, 50, 3
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def text_failures() -> dict[str, Column]:
    """The filters that judge a text by itself, from the columns `_text`, which is never null, and `_words`."""
    t, words = F.col("_text"), F.col("_words")
    return {
        "A": F.size(words) < LEAST_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < LEAST_DISTINCT * F.size(words),
        "C": 100 * F.regexp_count(t, F.lit("[A-Z]")) > MOST_CAPITALS * F.char_length(t),
        "D": t.rlike(r"[#$%&*|]"),
    }


def failures(docs: DataFrame, text: str = "text", key: str = "doc_id", part: str = "lang") -> tuple[DataFrame, list[str]]:
    """(key, part, mask) of every document, bit k of the mask set if it fails the k-th filter; and the tables that it reads."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("_id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), F.coalesce(F.col(text), F.lit("")).alias("_text"))
    rows = rows.withColumn("_words", F.regexp_extract_all("_text", F.lit(WORD), F.lit(0)))
    bits = [F.when(c, 1 << k).otherwise(0) for k, c in enumerate(text_failures().values())]
    narrow, p_narrow = materialise(rows.select("_id", "part", reduce(lambda a, b: a + b, bits).alias("_mask"), F.unhex(F.sha2(F.col("_text").cast("binary"), 256)).alias("_hash")), "lattice-texts")
    copies = narrow.groupBy("_hash").agg(F.min("_id").alias("_first"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    copies, p_copies = materialise(copies, "lattice-copies")
    copy = F.coalesce(F.col("_id") > F.col("_first"), F.lit(False))
    masks = narrow.join(copies, "_hash", "left").select(F.col("_id").alias(key), "part", (F.col("_mask") + F.when(copy, 1 << FILTERS.index("E")).otherwise(0)).alias("mask"))
    return masks, [p_narrow, p_copies]


def edges(n: int) -> list[tuple[int, int]]:
    """(set applied, next filter) for n filters: n * 2^(n - 1) of them."""
    return [(sum(1 << k for k in some), f) for size in range(n) for some in combinations(range(n), size) for f in range(n) if f not in some]


def steps(spark: SparkSession, letters: str) -> DataFrame:
    """(filter_order, step, applied, filter): every order as a path through the lattice."""
    at = {c: k for k, c in enumerate(letters)}
    rows = [("".join(p), i + 1, sum(1 << at[c] for c in p[:i]), at[p[i]]) for p in permutations(letters) for i in range(len(letters))]
    return spark.createDataFrame(rows, "filter_order string, step int, applied int, filter int")


def lattice(masks: DataFrame, letters: str = FILTERS) -> DataFrame:
    """(part, applied, filter, COUNTS) of every edge from (part, mask, n, good, toxic)."""
    all_edges = F.array(*[F.struct(F.lit(a).alias("applied"), F.lit(f).alias("filter"), F.lit(1 << f).alias("_bit")) for a, f in edges(len(letters))])
    rows = masks.select("*", F.inline(all_edges))
    there, fails = F.col("mask").bitwiseAND(F.col("applied")) == 0, F.col("mask").bitwiseAND(F.col("_bit")) != 0
    of = lambda where, c: F.sum(F.when(where, F.col(c)).otherwise(0)).alias
    return rows.groupBy("part", "applied", "filter").agg(
        of(there & ~fails, "n")("kept"),
        of(there & fails, "n")("removed"),
        of(~there & fails, "n")("redundant"),
        of(F.col("mask") == F.col("_bit"), "n")("unique_fails"),
        of(there & fails, "good")("good_lost"),
        of(there & fails, "toxic")("toxic_lost"),
    )


def paths(found: DataFrame, letters: str = FILTERS) -> DataFrame:
    """The edges of every order, step by step, with what a filter removes over all orders."""
    joined = found.join(F.broadcast(steps(found.sparkSession, letters)), ["applied", "filter"])
    shapley = F.sum("removed").over(Window.partitionBy("part", "filter"))
    return joined.select("part", "filter_order", "step", *COUNTS, shapley.alias("shapley"))


def audit(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", part: str = "lang") -> DataFrame:
    """(part, filter_order, step, COUNTS, shapley) of the five filters over documents."""
    masks, tables = failures(docs, text, key, part)
    said = labels.groupBy(F.col(key)).agg(F.max((F.col("quality") == 1).cast("int")).alias("_good"), F.max((F.col("toxic") == 1).cast("int")).alias("_toxic"))
    of = lambda c: F.sum(F.coalesce(F.col(c), F.lit(0))).cast("long")
    counts = masks.join(said, key, "left").groupBy("part", "mask").agg(F.count("*").alias("n"), of("_good").alias("good"), of("_toxic").alias("toxic"))
    out, _ = materialise(paths(lattice(counts)), "lattice")
    release(docs.sparkSession, *tables)
    return out
