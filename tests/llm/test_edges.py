"""Nulls, empty and very long texts, ties, repeated rows, clashing names and empty tables, operator by operator; and plain
restatements of the label model and of the language mixture."""

from __future__ import annotations

import math
import random
import unicodedata

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from assay.llm import compression_toxicity, hyperminhash, kernels, mixing, mixture_langid, quality_rules, token_attribution
from tests.llm.brute import near_components

LONG = " ".join(f"word{i % 977}" for i in range(200_000))
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def plain_em(patterns, counts, prior, belief, weight, rounds):
    """The label model, one pattern and one rule at a time."""
    n, m = sum(counts), len(patterns[0])
    rates = [[list(belief[c]) for _ in range(m)] for c in (0, 1)]
    p = prior
    for _ in range(rounds):
        good = []
        for v in patterns:
            odds = math.log(p / (1 - p)) + sum(math.log(rates[1][k][x + 1] / rates[0][k][x + 1]) for k, x in enumerate(v))
            good.append(1 / (1 + math.exp(-odds)))
        new = [[[0.0] * 3 for _ in range(m)] for _ in (0, 1)]
        for v, w, g in zip(patterns, counts, good, strict=True):
            for k, x in enumerate(v):
                new[1][k][x + 1] += w * g
                new[0][k][x + 1] += w * (1 - g)
        for c in (0, 1):
            for k in range(m):
                row = [new[c][k][j] + n * weight[c] * belief[c][j] for j in range(3)]
                rates[c][k] = [x / sum(row) for x in row]
        p = (sum(w * g for w, g in zip(counts, good, strict=True)) + 0.1 * n * prior) / (1.1 * n)
    return p, rates


def test_label_model_equals_plain_restatement():
    rng = random.Random(4)
    patterns = sorted({tuple(rng.choice([-1, 0, 1, 1, 1]) for _ in range(4)) for _ in range(30)})
    counts = [rng.randint(1, 50) for _ in patterns]
    p, rates = plain_em(patterns, counts, 0.85, quality_rules.BELIEF, quality_rules.WEIGHT, 7)
    model = quality_rules.fit(np.array(patterns, float), np.array(counts, float), rounds=7)
    assert model.prior == pytest.approx(p)
    assert model.rates == pytest.approx(np.array(rates))


def test_variety_is_judged_block_by_block():
    """Words that are new within their block of 1,000 words, in a text of several blocks."""
    text = " ".join(["a"] * 999 + ["b"] + [f"w{i}" for i in range(1000)] + ["c", "c"])
    stats = quality_rules.text_statistics(*kernels.string_parts(pa.array([text, "x x", None])))
    assert stats["n_fresh_words"].tolist() == [2 + 1000 + 1, 1, 0]


def test_quality_of_long_texts_ties_and_scripts(spark):
    han = "这是一个很长的句子，没有空格。" * 8
    unlike = " ".join(f"u{i}" for i in range(200_000)) + "."
    rows = [(1, unlike), (2, None), (3, " ".join([han] * 25)), (1, unlike)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("kept", F.lit("clash")).withColumn("quality", F.lit("clash"))
    out = quality_rules.assess(docs, ["doc_id", "kept", "quality"])
    got = [r.asDict() for r in out.collect()]
    assert [r["n_words"] for r in got if r["doc_id"] == 1] == [200_000] * 2
    han_row = next(r for r in got if r["doc_id"] == 3)
    assert han_row["n_unspaced"] > 0.9 * han_row["n_letters"]
    assert han_row["n_stops"] == 8 * 25
    # a posterior that equals the threshold passes
    model = quality_rules.LabelModel(0.5, np.full((2, len(quality_rules.RULES), 3), 1 / 3))
    judged = quality_rules.judge(quality_rules.with_statistics(docs.where("doc_id = 1"), "text", ["doc_id"]), model)
    assert {(r["quality"], r["kept"]) for r in judged.collect()} == {(0.5, True)}


def test_code_point_classes_equal_the_database():
    text = "aÉß€—1٣अि中あ🙂 .。́"
    at, bits = kernels.code_points(np.frombuffer(text.encode(), np.uint8))
    assert len(at) == len(text)
    for c, b in zip(text, bits.tolist(), strict=True):
        assert bool(b & kernels.LETTER) == unicodedata.category(c).startswith("L")
        assert bool(b & kernels.MARK) == unicodedata.category(c).startswith("M")


def test_near_duplicates_of_rows_that_share_an_id(spark):
    a, b = [f"a{i}" for i in range(30)], [f"b{i}" for i in range(30)]
    rows = [(1, " ".join(a), "p"), (1, " ".join(b), "q"), (2, " ".join([*a[:-1], "z"]), "r"), (3, " ".join([*b[:-1], "z"]), "s"), (4, LONG, "t"), (5, LONG + " more", "u"), (6, None, "v"), (6, "", "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, component_id string").withColumn("kept", F.lit("clash"))
    got = sorted((r["doc_id"], r["component_id"], r["kept"]) for r in hyperminhash.near_duplicates(docs, 2).collect())
    # both texts of 1 are the first of their group; no group takes the other's links
    assert got == [(1, 1, True), (1, 1, True), (2, 1, False), (3, 1, False), (4, 4, True), (5, 4, False), (6, 6, True), (6, 6, True)]
    kept = hyperminhash.keep_one(docs, 2)
    assert kept.columns == docs.columns
    assert sorted((r["doc_id"], r["component_id"]) for r in kept.collect()) == [(1, "p"), (1, "q"), (4, "t"), (6, "v"), (6, "w")]


def test_near_duplicates_recall_at_the_threshold(spark):
    """Pairs of unlike size just above 80 % are all found, just below none is."""
    rng, docs, linked = random.Random(8), [], set()
    for g in range(60):
        n = rng.choice([6, 12, 40, 150, 600])
        base = [f"g{g}w{i}" for i in range(n)]
        drop = rng.randint(0, max(1, n // 4))
        docs += [(2 * g, " ".join(base)), (2 * g + 1, " ".join(base[: n - drop]))]
    want, _ = near_components(docs, 2)
    got = {r["doc_id"]: r["component_id"] for r in hyperminhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string"), 2).collect()}
    assert got == want
    assert 10 < sum(want[d] != d for d, _ in docs) < 60
    assert not linked


def test_mixing_many_sources_long_texts_and_ties(spark):
    rows = [(i, " ".join(["w"] * (1 + i % 7)), f"s{i % 50:02d}", 0) for i in range(600)] + [(1000, LONG, "s00", 0)] + [(2000, "a b c", "same", 0)] * 9 + [(None, "d e f", None, 0)] * 5
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, copy long").withColumn("target", F.lit("clash"))
    plan = mixing.mix(docs)
    totals = plan.groupBy("s").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max("size").alias("m")).collect()
    assert all(abs(r["taken"] - r["target"]) <= max(2, r["m"]) for r in totals)
    few = {}
    for bound in (10**6, 0):
        out = mixing.mixed_documents(docs, broadcast_cells=bound)
        assert out.columns == ["doc_id", "text", "source", "target", "copy"]
        few[bound] = sorted(map(tuple, out.select("doc_id", "source", "copy").collect()), key=str)
    assert few[10**6] == few[0]
    want = {(str(r["doc_id"]), r["n"]) for r in plan.groupBy("doc_id").agg(F.sum("copies").alias("n")).where("n > 0").collect()}
    assert {(str(r["doc_id"]), r["n"]) for r in out.groupBy("doc_id").agg(F.count("*").alias("n")).collect()} == want
    tasks = mixing.targets(plan.groupBy("s", "size").agg(F.count("*").alias("n")))._jdf.queryExecution().toString()
    assert "SinglePartition" not in tasks


def test_tokens_of_fields_as_they_are(spark):
    rows = [(1, "a\x00b", "c", "clash"), (2, None, None, None), (3, LONG, "", "clash")]
    table = spark.createDataFrame(rows, "k long, a string, b string, n_tokens string")
    out = token_attribution.count_field_tokens(table, ["k", "n_tokens"], ["a", "b"])
    assert out.columns == ["k", "n_tokens", "n_crossing", "section_tokens"]
    got = {r["k"]: (r["n_tokens"], r["section_tokens"]) for r in out.collect()}
    encoding, _ = token_attribution.encoder(*token_attribution.vocabulary())
    assert got[1][0] == len(encoding.encode_ordinary("a\x00b\nc"))
    assert sum(got[3][1]) == got[3][0] > 200_000
    assert token_attribution.count_field_tokens(table.limit(0), ["k"], ["a", "b"]).count() == 0
    docs = table.select("k", F.col("a").alias("text"), F.lit("x").alias("section_tokens"))
    assert token_attribution.count_tokens(docs, ["k", "section_tokens"]).columns == ["k", "n_tokens", "n_crossing", "section_tokens"]
    assert token_attribution.count_tokens(docs.limit(0), ["k"]).count() == 0


def plain_mixture(like, rounds):
    share = [1 / len(like[0])] * len(like[0])
    for _ in range(rounds):
        total = [0.0] * len(share)
        for row in like:
            z = sum(a * b for a, b in zip(row, share, strict=True))
            total = [t + a * b / z for t, a, b in zip(total, row, share, strict=True)]
        share = [t / len(like) for t in total]
    return share


def test_mixture_equals_plain_restatement():
    rng = np.random.default_rng(3)
    like = rng.random((40, 3)) ** 3
    times = rng.integers(1, 4, 40)
    whole = np.repeat(like, times, axis=0)
    doc = np.repeat([0, 1], 20)
    # weights stand for repeated rows, whatever languages are given up
    assert mixture_langid.mixtures(like, doc, 2, times) == pytest.approx(mixture_langid.mixtures(whole, np.repeat(doc, times), 2))
    free = plain_mixture([list(r) for r in whole[np.repeat(doc, times) == 0]], mixture_langid.FULL_ROUNDS)
    kept = mixture_langid.mixtures(like[:20], doc[:20], 1, times[:20])[0]
    if (kept > 0).all():
        assert kept == pytest.approx(free)
    assert kept.sum() == pytest.approx(1)


def test_language_edges(spark):
    rows = [(i, ("the quick fox jumps " if i % 2 else "der schnelle fuchs springt ") * 5, "en" if i % 2 else "de") for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = mixture_langid.fit(docs)
    odd = ["— … €", "🙂🙂", "١٢٣ 456", "́", "", None, "über den fuchs", LONG]
    test = spark.createDataFrame([(i, t, "x") for i, t in enumerate(odd)], "doc_id long, text string, score string").withColumn("lang_pred", F.lit("clash"))
    out = mixture_langid.identify(test, model, ["doc_id", "score", "lang_pred"])
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in out.collect()}
    assert {got[i] for i in range(6)} == {("und", 0.0)}
    assert got[6][0] == "de"
    assert got[7][0] in ("de", "en")
    assert mixture_langid.identify(test.limit(0), model, ["doc_id"]).count() == 0


def test_toxicity_edges(spark):
    model = compression_toxicity.ToxicityModel(b"ordinary words here " * 20, [b" nastyword ", b" vilething "], np.append(np.ones(compression_toxicity.FEATURES), -1.0))
    rows = [(1, "a nastyword b", "x"), (1, "a nastyword b", "x"), (2, None, "x"), (3, "", "x"), (4, LONG, "x"), (5, "x" * 3_000_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    out = compression_toxicity.score(docs, model, ["doc_id", "score"])
    assert out.columns == ["doc_id", "score"]
    got = sorted((r["doc_id"], r["score"]) for r in out.collect())
    assert len(got) == 6
    assert got[0] == got[1]
    assert got[2][1] == got[3][1] < got[0][1] <= 1
    assert compression_toxicity.score(docs.limit(0), model, ["doc_id"]).count() == 0


def test_dictionaries_are_trained_by_the_library():
    import zstandard

    rng = random.Random(2)
    samples = [" ".join(rng.choices(["alpha", "beta", "gamma", "delta", "epsilon"], k=8)).encode() for _ in range(400)]
    made = compression_toxicity.trained(samples, 1024)
    assert zstandard.ZstdCompressionDict(made, dict_type=zstandard.DICT_TYPE_FULLDICT).dict_id()
    assert compression_toxicity.trained([b"few"], 1024) == b"few"


def test_pipeline_edges(spark, tmp_path):
    good = lambda k: ". ".join(" ".join(f"w{k}x{i * 7 + j}" for j in range(8)) for i in range(8)) + "."
    rows = [(1, good(1), "en", "a", 1), (1, good(1), "en", "a", 1), (2, None, None, None, None), (3, "", "en", "a", 0), (None, good(4), "en", None, 2), (5, good(5), None, "b", 3), (6, " ".join(good(k) for k in range(10, 260)), "en", "b", 4)]
    docs = spark.createDataFrame(rows, DOCS).withColumn("copy", F.lit("clash")).withColumn("__doc", F.lit("clash"))
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, "nothing like that is in any of the documents here")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    out = corpus_pipeline.run(spark, str(tmp_path))
    assert set(out.columns) == {*docs.columns}
    got = sorted(str(r["doc_id"]) for r in out.select("doc_id").distinct().collect())
    assert set(got) <= {"1", "5", "6", "None"}
    assert "2" not in got and "3" not in got
