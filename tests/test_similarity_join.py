"""The similarity join against comparing all with all."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from assay.functions.fuzzy import similarity
from assay.operators import similarity_join as J


def frames(spark, left, right):
    a = spark.createDataFrame([(f"a{i:03}", n) for i, n in enumerate(left)], "a string, na string")
    b = spark.createDataFrame([(f"b{i:03}", n) for i, n in enumerate(right)], "b string, nb string")
    return a, b


def plain(left, right, least):
    out = set()
    for i, x in enumerate(left):
        best = max(((101.0 if x == y else similarity(x, y), -j) for j, y in enumerate(right) if x is not None and y is not None), default=(0, 0))
        if best[0] >= least:
            out.add((f"a{i:03}", f"b{-best[1]:03}", round(best[0], 9)))
    return out


def changed(rng, s, most):
    s = list(s)
    for _ in range(rng.randint(0, most)):
        at = rng.randrange(len(s) + 1)
        if rng.random() < 0.5 and s:
            s.pop(min(at, len(s) - 1))
        else:
            s.insert(at, rng.choice("abcd é"))
    return "".join(s)


@pytest.mark.parametrize(("least", "alphabet"), [(80.0, "abc"), (80.0, "abcdefghijklmnop"), (91.0, "ab"), (70.0, "abcdefg")])
def test_equals_comparing_all(spark, least, alphabet):
    rng = random.Random(len(alphabet) + int(least))
    right = ["".join(rng.choices(alphabet, k=rng.choice([1, 2, 3, 5, 8, 13, 20, 34, 60]))) for _ in range(70)] + ["", None, "x" * 40, right_long := "lorem ipsum dolor " * 12]
    left = [changed(rng, rng.choice([r for r in right if r is not None]), 6) for _ in range(70)] + ["", None, "zz", right_long[:190], right_long + "x", "y" * 32, "y" * 33]
    got = {(r.a, r.b, round(r.similarity, 9)) for r in J.best_partners(*frames(spark, left, right), least).collect()}
    assert got == plain(left, right, least)
    assert len(got) > 25


def test_every_pair_of_the_threshold_shares_a_gram_of_its_prefix(spark):
    rng = random.Random(9)
    right = ["".join(rng.choices("abc", k=rng.randint(1, 25))) for _ in range(60)]
    left = [changed(rng, r, 5) for r in right]
    a, b = frames(spark, left, right)
    got = {(r.a, r.b) for r in J.by_grams(a, b, 75.0).collect()}
    assert got == {(f"a{i:03}", f"b{j:03}") for i, x in enumerate(left) for j, y in enumerate(right) if similarity(x, y) >= 75 and x and y}


def test_what_lies_outside_of_the_neighbourhood_is_below_the_bound(spark):
    n = 12
    bound = spark.range(1).select(J.settled_above(F.lit(n))).first()[0]
    for lost in range(5):
        for put_in in range(6):
            s = 200 * (n - lost) / (2 * n - lost + put_in)
            assert (lost <= 1 and put_in <= 2) or s <= bound
    some = spark.createDataFrame([("abca",)], "x string").select(F.explode(J.deletions(F.col("x"), 2)).alias("s"))
    assert {r.s for r in some.collect()} == {"abca", "bca", "aca", "aba", "abc", "ca", "ba", "bc", "aa", "ac", "ab"}


def test_candidates_do_not_grow_with_the_square(spark):
    """Names that differ in a number: each meets few others."""
    names = [f"customer#{i:09}" for i in range(1, 801)]
    a, b = frames(spark, [n.replace("#0", "#-") for n in names], names)
    met = J.near(a, b, 0.0).count()
    assert met <= 4 * len(names)


def test_no_side_is_broadcast_by_the_size_of_its_file(spark, tmp_path):
    """Names that are alike make a small file and many keys."""
    at = f"file://{tmp_path}/names"
    spark.range(3000).select(F.format_string("name-%09d", "id").alias("n")).write.parquet(at)
    a, b = (spark.read.parquet(at).select(F.col("n").alias(c), F.col("n").alias(f"n{c}")) for c in "ab")
    for found in (J.near(a, b, 80.0), J.by_grams(a, b, 80.0)):
        assert "Broadcast" not in found._jdf.queryExecution().sparkPlan().toString()


def test_only_keys_that_can_meet_are_made(spark):
    some = spark.createDataFrame([("abca",)], "x string").select(F.explode(J.deletions(F.col("x"), 2, [4, 3])).alias("s"))
    assert {r.s for r in some.collect()} == {"abca", "bca", "aca", "aba", "abc"}
