from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from assay.llm import decontaminate, mixing, quality_rules
from tests.llm.brute import base_statistics, words

TEXTS = [None, "", "\n\n", "one", "a b\na b\na b", "x # $ |\n<y> & é", " ".join(str(i % 9) for i in range(60)), "line é\nline é\nother", "the quick brown fox. " * 12]


def test_base_statistics_equal_brute_force(spark):
    rng = random.Random(1)
    texts = TEXTS + [rng.choice(" \n").join(rng.choices(["a", "b", "cé", "#", "d."], k=rng.randint(1, 60))) for _ in range(60)]
    docs = spark.createDataFrame([(i, t, -1) for i, t in enumerate(texts)], "doc_id long, text string, n_words int")
    out = quality_rules.assess(docs, ["doc_id"])
    for r in out.collect():
        want = base_statistics(texts[r["doc_id"]])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert r["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r["kept"] and r["base_failed"])
    assert quality_rules.filter_quality(docs).columns == docs.columns
    assert quality_rules.assess(docs.limit(0), ["doc_id"]).count() == 0


def test_rules_find_a_planted_kind_of_junk():
    rng = np.random.default_rng(0)
    good = np.where(rng.random((5000, 6)) < 0.01, -1, 1)
    junk = good[:300].copy()
    junk[:, :2] = -1
    rows, counts = np.unique(np.concatenate([good, junk]), axis=0, return_counts=True)
    model = quality_rules.fit(rows.astype(float), counts.astype(float))
    base, gain = model.log_odds()
    score = lambda v: base + sum(gain[k][x + 1] for k, x in enumerate(v))
    assert score([-1, -1, 1, 1, 1, 1]) < 0 < score([1, 1, -1, 1, 1, 1])
    assert 0.9 < model.prior < 0.98


def fill(sizes, weights=(5, 2, 1), share=1.5, cap=2.0):
    """Targets by repeated resharing."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, fixed = share * sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        left = total - sum(fixed.values())
        out = fixed | {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if out[s] > cap * sizes[s]]
        if not over:
            return out
        fixed |= {s: cap * sizes[s] for s in over}


def mixture(seed, n):
    rng = random.Random(seed)
    return [(i, " ".join(["w"] * int(rng.paretovariate(1.1) * 8)), rng.choice([None, "", "a", "b", "é", "z"]), i) for i in range(n)] + [(n, None, "a", 0), (n + 1, "", "only-empty", 0)]


@pytest.mark.parametrize("cell", [10_000, 7])
def test_mix_meets_targets(spark, cell):
    rows = mixture(1, 1500)
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, size long")
    out = mixing.mix(docs, cell=cell).collect()
    sizes = {}
    for _, t, s, _ in rows:
        sizes[s] = sizes.get(s, 0) + len(words(t))
    want, taken, by_id = fill(sizes), {}, {r[0]: r for r in rows}
    for r in out:
        s = by_id[r["doc_id"]][2]
        assert r["size"] == len(words(by_id[r["doc_id"]][1]))
        assert 0 <= r["taken"] <= 2 * r["size"]
        assert (r["source_size"], round(r["target"], 6)) == (sizes[s], round(want[s], 6))
        taken[s] = taken.get(s, 0) + r["taken"]
    assert len(out) == len(rows)
    for s, n in sizes.items():
        assert abs(taken[s] - want[s]) <= max(2, 0.01 * n)
    assert sorted(map(tuple, mixing.mix(docs, cell=cell).collect())) == sorted(map(tuple, out))


def test_mix_rates_are_exponential_tilts(spark):
    rows = [(i, " ".join(["w"] * (1 + i % 30)), "a" if i % 3 else "b") for i in range(900)]
    out = mixing.mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).where("rate > 0 AND rate < 2").select("s", F.col("size").cast("double").alias("x"), F.log("rate").alias("y"))
    for r in out.groupBy("s").agg(F.corr("x", "y").alias("c"), F.stddev("y").alias("d")).collect():
        assert r["d"] < 1e-9 or abs(abs(r["c"]) - 1) < 1e-9


def test_mixed_documents_repeat_rows(spark):
    rows = [(1, "a b c", "s", 5), (1, "a b c", "s", 5), (2, "d", "s", 6), (None, "e f", None, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, copy long")
    out = mixing.mixed_documents(docs)
    assert out.columns == ["doc_id", "text", "source", "copy"]
    plan = mixing.mix(docs).groupBy("doc_id").agg(F.sum("copies").alias("n")).where("n > 0")
    assert sorted(map(str, out.groupBy("doc_id").count().collect())) == sorted(str(r).replace("n=", "count=") for r in plan.collect())
    assert mixing.mix(docs.limit(0)).count() == 0


ITEM = "A farmer named Alice has 12 apples and gives 5 apples to Bob before she walks 3 miles to the market in Paris today."


def found(spark, texts, items=(ITEM,)):
    docs = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, found string")
    bench = spark.createDataFrame([(100 + i, t) for i, t in enumerate(items)], "item_id long, text string")
    return {r["doc_id"]: r["found"] for r in decontaminate.find(docs.select("doc_id", "text"), bench, ["doc_id"]).collect()}, docs, bench


def test_leaks_are_found(spark):
    other = ITEM.replace("12", "40").replace("5", "7").replace("Alice", "Carla").replace("3 miles", "8 km")
    torn = other.replace("gives 7 apples", "gives 7 apples").replace("Carla has 40 apples", "Carla has 40 pears")
    texts = ["Before. " + ITEM + " After.", "before " + ITEM.upper(), ITEM.replace(" ", "\n"), "Intro words here. " + other + " And so on.", torn, "A farmer walks to the market.", None, "", "12 5 3 " * 40]
    got, docs, bench = found(spark, texts)
    kinds = {d: [(x["item_id"], x["kind"]) for x in v] for d, v in got.items()}
    assert kinds[0] == kinds[2] == [(100, "verbatim")]
    assert kinds[1] and kinds[3] == [(100, "reparameterised")]
    assert not any(kinds[d] for d in (5, 6, 7, 8))
    w = words(texts[3])
    span = got[3][0]
    assert w[span["from_word"] : span["to_word"]] == words(other)
    assert {r["doc_id"] for r in decontaminate.clean(docs, bench).collect()} >= {5, 6, 7, 8}
    assert decontaminate.clean(docs, bench).columns == docs.columns


def test_slots_must_agree(spark):
    item = "There are 7 red cubes on the table and also 7 blue cubes under the wide old wooden table there."
    got, _, _ = found(spark, [item.replace("7", "9"), item.replace("7", "9", 1)], [item])
    assert [x["kind"] for x in got[0]] == ["reparameterised"]
    assert got[1] == []


def test_benchmark_in_blocks(spark):
    items = [" ".join(f"k{i}w{j}" for j in range(20)) for i in range(40)]
    docs = spark.createDataFrame([(i, "x y z " + t) for i, t in enumerate(items)] + [(99, "none of them")], "doc_id long, text string")
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {r["doc_id"]: [x["item_id"] for x in r["found"]] for r in decontaminate.find(docs, bench, ["doc_id"], limit=500).collect()}
    assert got == {i: [i] for i in range(40)} | {99: []}
    assert decontaminate.find(docs, bench.limit(0), ["doc_id"]).where("size(found) > 0").count() == 0
