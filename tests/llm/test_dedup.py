from __future__ import annotations

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest

from assay.llm import components, hyperminhash, kernels, substring_dedup
from tests.llm.brute import near_components, repeats, words

SCHEMA = "doc_id long, text string, tag string, copies long"


def corpus(seed, n=60):
    rng = random.Random(seed)
    vocabulary = [f"w{i}é" for i in range(50)]
    passage = " ".join(rng.choices(vocabulary, k=40))
    docs = [(0, None), (1, ""), (2, " \n "), (3, "one"), (4, "one two"), (5, "ONE two")]
    for d in range(6, n):
        t = rng.choices(vocabulary, k=rng.randint(1, 90))
        kind = rng.random()
        if kind < 0.3:
            at = rng.randint(0, len(t))
            t[at:at] = passage.split()[rng.randint(0, 12) :]
        elif kind < 0.6 and d > 10:
            t = words(docs[rng.randint(6, d - 1)][1]) or ["x"]
            for _ in range(rng.randint(0, 2)):
                t[rng.randrange(len(t))] = rng.choice(vocabulary)
        docs.append((d, rng.choice([" ", "\n", "  "]).join(t)))
    docs.append((n, " ".join(["same"] * 70)))
    return docs


def frame(spark, docs):
    return spark.createDataFrame([(d, t, "x", 1) for d, t in docs], SCHEMA).repartition(3)


@pytest.mark.parametrize("seed", [1, 2])
def test_repeats_equal_brute_force(spark, seed):
    docs = corpus(seed)
    want = repeats(docs)
    for share in (0.0, 0.4):
        got = {r["doc_id"]: r for r in substring_dedup.remove_repeats(frame(spark, docs), ["doc_id"], share=share).collect()}
        for d, t in docs:
            w = words(t)
            kept = " ".join(x for i, x in enumerate(w) if i not in want[d])
            assert (got[d]["n_words"], got[d]["n_removed"], got[d]["kept_text"]) == (len(w), len(want[d]), kept)
            assert sum(s["to_word"] - s["from_word"] for s in got[d]["removed"]) == len(want[d])


def test_runs_are_compacted_and_keep_the_first(spark):
    docs = corpus(3, 40)
    index = substring_dedup.FingerprintIndex(spark, 3, fan_in=2)
    parts = [docs[i : i + 11] for i in range(0, len(docs), 11)]
    spans = None
    for i, part in enumerate(parts):
        new = index.add(frame(spark, part), last=i + 1 == len(parts))
        spans = new if spans is None else spans.unionByName(new)
    assert len(index.runs) == 1
    got = {}
    for r in spans.collect():
        got.setdefault(r["doc_id"], set()).update(range(r["span"] >> 32, r["span"] & 0xFFFFFFFF))
    assert got == {d: g for d, g in repeats(docs).items() if g}


def test_dedup_keeps_columns_nulls_and_equal_rows(spark):
    t = " ".join(f"a{i}" for i in range(30))
    rows = [(1, t), (1, t), (2, t), (None, t), (None, None)]
    out = substring_dedup.dedup_documents(frame(spark, rows))
    assert out.columns == ["doc_id", "text", "tag", "copies"]
    got = {(r["doc_id"], r["text"]) for r in out.collect()}
    clash = frame(spark, rows).withColumnRenamed("tag", "n_words").withColumnRenamed("copies", "span")
    assert {(r["doc_id"], r["text"], r["n_words"], r["span"]) for r in substring_dedup.dedup_documents(clash).collect()} == {(*g, "x", 1) for g in got}
    assert got == {(1, t), (2, ""), (None, ""), (None, None)}
    assert substring_dedup.remove_repeats(frame(spark, []), ["doc_id"]).count() == 0


def test_long_words_and_texts(spark):
    big = "x" * (kernels.BLOCK + 5)
    docs = [(1, f"{big} a b " * 2), (2, " ".join(f"q{i}" for i in range(60_000)))]
    got = {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in substring_dedup.remove_repeats(frame(spark, docs), ["doc_id"]).collect()}
    assert got == {1: (6, 0), 2: (60_000, 0)}


@pytest.mark.parametrize(("seed", "size"), [(1, 2), (2, 5)])
def test_near_components_equal_brute_force(spark, seed, size):
    docs = corpus(seed)
    want, sets = near_components(docs, size)
    got = {r["doc_id"]: r for r in hyperminhash.near_duplicates(frame(spark, docs), size).collect()}
    assert {d: r["component_id"] for d, r in got.items()} == want
    assert all(r["n_shingles"] == len(sets[d]) and r["kept"] == (want[d] == d) for d, r in got.items())


def test_rest_is_tested_without_rounds(spark):
    rng = random.Random(5)
    base = [f"v{i}" for i in range(60)]
    docs = []
    for d in range(80):
        t = list(base)
        for _ in range(rng.randint(2, 8)):
            t[rng.randrange(60)] = f"n{rng.randrange(400)}"
        docs.append((d, " ".join(t)))
    want, _ = near_components(docs, 2)
    for rounds in (0, 2):
        got = {r["doc_id"]: r["component_id"] for r in hyperminhash.near_duplicates(frame(spark, docs), 2, rounds=rounds).collect()}
        assert got == want


def test_near_edges(spark):
    assert hyperminhash.near_duplicates(frame(spark, [])).count() == 0
    rows = [(7, "a b c"), (7, "a b c"), (None, "a b c"), (8, None), (9, None)]
    got = sorted(((str(r["doc_id"]), r["component_id"], r["kept"]) for r in hyperminhash.near_duplicates(frame(spark, rows)).collect()), key=str)
    assert got == [("7", 7, True), ("7", 7, True), ("8", 8, True), ("9", 9, True), ("None", 7, False)]
    kept = hyperminhash.keep_one(frame(spark, [*rows, (None, "quite another text"), (None, "and one more")]))
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["7", "8", "9", "None", "None"]
    assert kept.columns == ["doc_id", "text", "tag", "copies"]


def test_estimate_is_close():
    rng = np.random.default_rng(1)
    for overlap in (0.5, 0.8, 0.95):
        n = 4000
        values = kernels.mix(rng.integers(0, 2**62, 2 * n).astype(np.uint64))
        common = int(2 * n * overlap / (1 + overlap))
        a, b = values[:n], np.concatenate([values[:common], values[n : 2 * n - common]])
        sketches = [hyperminhash.sketch(np.zeros(len(x), np.int64), x, 1) for x in (a, b)]
        j, used = hyperminhash.estimate(*sketches, np.array([n]), np.array([n]))
        true = common / (2 * n - common)
        assert used[0] == hyperminhash.REGISTERS
        assert abs(j[0] - true) < 5 * np.sqrt(true * (1 - true) / used[0])
        assert (np.maximum(*sketches) == hyperminhash.sketch(np.zeros(2 * n, np.int64), np.concatenate([a, b]), 1)).all()


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(i + 1, i) for i in range(30)] + [(101, 100)], "u long, v long")
    got = {r["node"]: r["label"] for r in components.components(links).collect()}
    assert got == {i: 0 for i in range(31)} | {100: 100, 101: 100}


def test_kernel_words_equal_regex():
    texts = ["a  b\tc", None, "", "\x0bé\x0c", "ends ", " ü\r\nß"]
    raw, offsets = kernels.string_parts(pa.array(texts))
    start, end, doc = kernels.words(raw, offsets)
    got = [[raw[a:b].tobytes().decode() for a, b, d in zip(start, end, doc, strict=True) if d == i] for i in range(len(texts))]
    assert got == [words(t) for t in texts]


def test_sets_are_sent_only_where_registers_pass(spark, monkeypatch):
    """One template with similarities of about a half: classes share buckets, and no set of shingles meets another.

    The texts are long enough to fill the registers; estimates of short ones are too rough to rule out a half.
    """
    rng = random.Random(9)
    docs = []
    for d in range(150):
        t = [f"v{i}" for i in range(420)]
        for k in range(0, 420, 6):
            t[k] = f"n{rng.randrange(10_000)}"
        docs.append((d, " ".join(t)))
    counts, plain = {}, hyperminhash.materialise

    def counted(df, name):
        table, path = plain(df, name)
        counts[name] = table.count()
        return table, path

    monkeypatch.setattr(hyperminhash, "materialise", counted)
    got = {r["doc_id"]: r["component_id"] for r in hyperminhash.near_duplicates(frame(spark, docs), 2, rounds=0).collect()}
    assert got == near_components(docs, 2)[0]
    assert counts["sketch-open"] > 0 and counts["sketch-sifted"] == 0


def test_links_of_a_group_of_near_copies_do_not_grow_with_its_square(spark, monkeypatch):
    """Near copies that all link with each other: the last step yields a forest, not one link for each class and label."""
    rng, docs = random.Random(12), []
    for d in range(120):
        t = [f"v{i}" for i in range(200)]
        for k in rng.sample(range(200), 3):
            t[k] = f"n{rng.randrange(10_000)}"
        docs.append((d, " ".join(t)))
    counts, plain = {}, hyperminhash.materialise

    def counted(df, name):
        table, path = plain(df, name)
        counts[name] = table.count()
        return table, path

    monkeypatch.setattr(hyperminhash, "materialise", counted)
    got = {r["doc_id"]: r["component_id"] for r in hyperminhash.near_duplicates(frame(spark, docs), 2, rounds=0).collect()}
    assert got == near_components(docs, 2)[0] and len(set(got.values())) == 1
    assert len(docs) <= counts["near-links"] + 1 < 3 * len(docs)
