"""The most similar partner of each name, without comparing all names with all.

Similarity is 200 * common / (lengths), common being the longest common subsequence. Three steps, each an equi-join that loses
nothing it answers for; only names that a step leaves open go on to the next:

1. Equal names.
2. Deletion neighbourhood, for names of at most NEAR characters: if a name loses at most one character and its partner at most
   two to become equal, the two share a string that these deletions leave. Keys are hashes of those strings. All other partners
   are less similar than a bound that follows from the length, so a name with a partner above it is settled.
3. q-gram prefixes, threshold by threshold: a partner of at least the threshold shares a least number of the name's n grams,
   whatever the lengths; so of each name's grams, in one order of all grams, only the first n - least + 1 need to meet. Grams
   come in order of the pairs that they would make, so common ones stay out. Names too short for the guarantee are met by
   single characters. A name is settled at the first threshold that it reaches.

Candidates are compared in Arrow batches. All joins are hinted to shuffle: names that are alike take little room in a file, and
exploded keys are not in Spark's estimate at all, so a side that seems small enough for a broadcast need not be. Grams that most names share make many candidates only where names are so alike that
most pairs have to be looked at.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.fuzzy import ratio
from ..storage import materialise, release

NEAR = 32
#: Thresholds of the third step above the caller's, and the length of its grams.
LEVELS = (92.0, 86.0)
GRAM = 2


def deletions(x: Column, most: int, lengths: list[int] | None = None) -> Column:
    """The different strings that x becomes by the loss of at most `most` characters; only those of some lengths, if given."""
    without = lambda s: F.transform(F.sequence(F.lit(1), F.char_length(s)), lambda i: F.concat(F.substr(s, F.lit(1), i - 1), F.substr(s, i + 1)))
    none = F.array().cast("array<string>")
    some = lambda s: F.when(F.char_length(s) > 0, without(s)).otherwise(none)
    found = []
    step = F.array(x)
    for lost in range(most + 1):
        if lost:
            step = F.array_distinct(F.flatten(F.transform(step, some)))
        found.append(step if lengths is None else F.when((F.char_length(x) - lost).isin(lengths), step).otherwise(none))
    return F.concat(*found)


def settled_above(length: Column) -> Column:
    """The most similar that a partner outside of the deletion neighbourhood of a name of this length can be."""
    inserted = F.lit(200.0) * length / (2 * length + 3)
    deleted = F.lit(200.0) * (length - 2) / (2 * length - 2)
    return F.when(length > 1, F.greatest(inserted, deleted)).otherwise(inserted)


def needed(least: float, q: int) -> tuple[float, int]:
    """(slope, shortest): a name of n characters shares at least slope * n - (q - 1) grams with any partner of similarity `least`
    or more; from `shortest` characters on that is at least one.

    With c in common, n - c characters are lost, each with at most q grams, and m - c put in, each between at most q - 1; c is at
    least `least` * (n + m) / 200. That is linear in m, so the extreme lengths of a partner decide.
    """
    t = least / 200
    slope = min(1 - q * (1 - t * (1 + r)) - (q - 1) * (r - t * (1 + r)) for r in ((200 - least) / least, least / (200 - least)))
    return slope, math.ceil(q / slope) if slope > 0 else 1 << 30


def numbered_grams(q: int):
    """The grams of a name, a repeated one with its number."""

    @F.pandas_udf("array<string>")
    def cut(x: pd.Series) -> pd.Series:
        def of(s: str) -> list[str]:
            seen: Counter[str] = Counter()
            out = []
            for i in range(len(s) - q + 1):
                g = s[i : i + q]
                out.append(f"{q}{g}{seen[g]}")
                seen[g] += 1
            return out

        return x.map(of)

    return cut


def _best(pairs: DataFrame) -> DataFrame:
    return pairs.withColumn("_r", F.row_number().over(Window.partitionBy("a").orderBy(F.desc("similarity"), "b"))).where("_r = 1").drop("_r")


def _compared(pairs: DataFrame, least: float) -> DataFrame:
    """(a, na, b, similarity) of the candidates (a, na, b, nb) of at least `least`."""
    return pairs.distinct().select("a", "na", "b", ratio("na", "nb").alias("similarity")).where(F.col("similarity") >= least)


def near(a: DataFrame, b: DataFrame, least: float) -> DataFrame:
    """Candidates within the deletion neighbourhood, compared."""
    # a few names make many keys, so they are dealt to all tasks first
    tasks = int(a.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = F.char_length("na")
    # at most NEAR + 1 numbers; partners' keys of other lengths meet nothing and are not made
    met = sorted({n - lost for (n,) in a.where(size <= NEAR).select(size).distinct().collect() for lost in (0, 1)})
    keys = lambda d, n, most, longest, lengths: d.where(F.char_length(n) <= longest).repartition(tasks, n).select("*", F.explode(F.transform(deletions(F.col(n), most, lengths), lambda s: F.xxhash64(s))).alias("_s"))
    # a partner may be longer by what it loses
    pairs = keys(a.select("na").distinct(), "na", 1, NEAR, None).hint("merge").join(keys(b, "nb", 2, NEAR + 2, met), "_s").select("na", "b", "nb")
    found = _compared(pairs.withColumn("a", F.col("na")), least).select("na", "b", "similarity")
    return a.hint("merge").join(found, "na").select("a", "na", "b", "similarity")


def _met(a: DataFrame, b: DataFrame, least: float, q: int, fits: Callable[[Column], Column]) -> DataFrame:
    """(a, na, b, nb) of names that fit and share a gram of their prefixes."""
    slope, _ = needed(least, q)
    grams = {c: d.where(fits(F.char_length(f"n{c}"))).select(c, f"n{c}", F.explode(numbered_grams(q)(F.col(f"n{c}"))).alias("gram")) for c, d in (("a", a), ("b", b))}
    counts = {c: g.groupBy("gram").agg(F.count("*").alias(f"_{c}")) for c, g in grams.items()}
    weight = counts["a"].hint("merge").join(counts["b"], "gram", "full").select("gram", (F.coalesce("_a", F.lit(0)) * F.coalesce("_b", F.lit(0))).alias("_w"))

    def prefix(c: str) -> DataFrame:
        n = F.char_length(f"n{c}")
        first = (n - q + 1) - F.ceil(F.lit(slope) * n - (q - 1) - F.lit(1e-9)) + 1
        ordered = grams[c].hint("merge").join(weight, "gram").withColumn("_i", F.row_number().over(Window.partitionBy(c).orderBy("_w", "gram")))
        # grams that only one side has count in the order, but meet nothing
        return ordered.where((F.col("_i") <= first) & (F.col("_w") > 0)).select(c, f"n{c}", "gram")

    return prefix("a").hint("merge").join(prefix("b"), "gram").drop("gram")


def by_grams(a: DataFrame, b: DataFrame, least: float, q: int = GRAM) -> DataFrame:
    """All pairs of similarity `least` or more, compared."""
    _, shortest = needed(least, q)
    longest = shortest * (200 - least) / least
    la, lb = F.char_length("na"), F.char_length("nb")
    long = _met(a, b, least, q, lambda n: n >= shortest)
    # pairs with a name that is too short for q-grams meet by characters; its partners are at most a little longer
    short = _met(a, b, least, 1, lambda n: n <= longest).where(F.least(la, lb) < shortest)
    return _compared(long.unionByName(short).where(200 * F.least(la, lb) >= F.lit(least) * (la + lb)), least)


def best_partners(left: DataFrame, right: DataFrame, least: float) -> DataFrame:
    """(a, b, similarity): for each a (a, na) the b (b, nb) with the most similar nb of at least `least`, the least b of equals.

    Equal names have similarity 101. Names that are null have no partner.
    """
    spark = left.sparkSession
    a, p_a = materialise(left.where("na IS NOT NULL"), "names-left")
    b, p_b = materialise(right.where("nb IS NOT NULL"), "names-right")
    exact, p_exact = materialise(_best(a.hint("merge").join(b, F.col("na") == F.col("nb")).select("a", "b", F.lit(101.0).alias("similarity"))), "names-equal")
    found, paths, open_ = [exact], [p_exact], a.hint("merge").join(exact, "a", "left_anti")
    step, p_step = materialise(_best(near(open_, b, least)), "names-near")
    done = step.where(F.col("similarity") > settled_above(F.char_length("na"))).select("a", "b", "similarity")
    found, paths, open_ = [*found, done], [*paths, p_step], open_.hint("merge").join(done, "a", "left_anti")
    for level in [*[x for x in LEVELS if x > least], least]:
        open_, p_open = materialise(open_, "names-open")
        paths.append(p_open)
        if not open_.limit(1).count():
            break
        step, p_step = materialise(_best(by_grams(open_, b, level)).select("a", "b", "similarity"), "names-grams")
        found, paths, open_ = [*found, step], [*paths, p_step], open_.hint("merge").join(step, "a", "left_anti")
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    out, _ = materialise(out, "names-matched")
    release(spark, p_a, p_b, *paths)
    return out
