"""The three-way search for evidence, and the search for the first variable that holds a pattern, against plain loops."""

from __future__ import annotations

import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from assay import providers
from assay.functions.text import keywords
from assay.operators import factuality, retrieval
from assay.plans import evidence

VOCABULARY = [f"term{i}" for i in range(80)]


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(11)
    texts = [" ".join(rng.choices(VOCABULARY, k=rng.randint(4, 40))) for _ in range(120)]
    texts += ["Zürich rules, said nobody about nothing", texts[0], texts[1], "short", "mmlu dataset " + texts[2]]
    # a word of most texts: its idf is negative, so only vectors and keywords find it
    texts = [f"{t} common" if i % 4 and i < 120 else t for i, t in enumerate(texts)]
    said = ["The term3 is near term70 and term5", "A benchmark has 1000 examples of term9", "zürich rules", "x", "MMLU dataset", " ".join(VOCABULARY[20:30]), "common"]
    embed = providers.hashed_vectors()
    chunks = embed(spark.createDataFrame(list(enumerate(texts)), "chunk_id long, text string"))
    statements = embed(spark.createDataFrame(list(enumerate(said)), "atom_id long, text string"))
    return chunks, statements


def plain_bm25(texts, query):
    docs = {i: re.findall(r"\w+", t.lower()) for i, t in texts.items()}
    n, avg = len(docs), sum(map(len, docs.values())) / len(docs)
    out = {}
    for i, d in docs.items():
        s, hit = 0.0, False
        for w in re.findall(r"\w+", query.lower()):
            tf, df = d.count(w), sum(w in x for x in docs.values())
            if tf:
                hit = True
                s += math.log((n - df + 0.5) / (df + 0.5)) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * len(d) / avg))
        if hit:
            out[i] = s
    best = sorted(out, key=lambda i: (-round(out[i], 9), i))[:15]
    return [i for i in best if out[i] > 0]


def plain_candidates(texts, vectors, text, vector, three, words, k):
    near = lambda q, n: sorted(vectors, key=lambda i: (-round(float(vectors[i] @ q), 12), i))[:n]
    wide, chosen = near(vector, 2 * k + 5), []
    while len(chosen) < min(k, len(wide)):
        value = {i: (0.8 * float(vectors[i] @ vector) - 0.2 * max(float(vectors[i] @ vectors[c]) for c in chosen)) if chosen else float(vectors[i] @ vector) for i in wide if i not in chosen}
        chosen.append(max(value, key=lambda i: (round(value[i], 12), -wide.index(i))))
    holds = [i for i in near(three, 20) if any(w.lower() in texts[i].lower() for w in words)][:10] if words else []
    out, seen = [], set()
    for way, some in (("vector", chosen), ("bm25", plain_bm25(texts, text)), ("keyword", holds)):
        for i in some:
            if texts[i] not in seen:
                seen.add(texts[i])
                out.append((i, way))
    return out[:20] if len(out[:20]) >= 5 else [(i, "vector") for i in chosen]


def test_candidates_equal_plain_search_and_every_way_adds_some(spark, tables):
    chunks, statements = tables
    texts = {r.chunk_id: r.text for r in chunks.collect()}
    vectors = {r.chunk_id: np.array(r.embedding, float) for r in chunks.collect()}
    asked = statements.withColumn("w", keywords("text")).withColumn("three", F.array_join(F.slice("w", 1, 3), " "))
    asked = providers.hashed_vectors("three", out="k")(asked).collect()
    for k in (3, 9):
        got = {}
        for r in evidence.candidates(chunks, statements, k).orderBy("place").collect():
            got.setdefault(r.atom_id, []).append((r.chunk_id, r.way))
        want = {r.atom_id: plain_candidates(texts, vectors, r.text, np.array(r.embedding, float), np.array(r.k, float), r.w, k) for r in asked}
        assert {a: [i for i, _ in x] for a, x in got.items()} == {a: [i for i, _ in x] for a, x in want.items() if x}
        assert {way for x in got.values() for _, way in x} == {"vector", "bm25", "keyword"}


def test_hybrid_reranks_and_widens(spark, tables):
    chunks, statements = tables
    plain, reranked = (evidence.hybrid(chunks, statements, rerank=x).collect() for x in (False, True))
    assert {r.atom_id for r in plain} >= {0, 1, 5} and max(r.place for r in plain) == 3
    found = {r.atom_id: {(c.chunk_id, c.place) for c in evidence.candidates(chunks, statements, 9).where(f"atom_id = {r.atom_id}").collect()} for r in reranked[:1]}
    vectors = {r.chunk_id: np.array(r.embedding, float) for r in chunks.collect()}
    q = {r.atom_id: np.array(r.embedding, float) for r in statements.collect()}
    for r in reranked:
        assert round(max(0.0, float(vectors[r.chunk_id] @ q[r.atom_id])) * 10, 4) >= 6
        assert r.atom_id not in found or r.chunk_id in {c for c, place in found[r.atom_id] if place <= 10}
    parents = spark.createDataFrame([(r.chunk_id, f"around {r.chunk_id}") for r in plain[:2]], "chunk_id long, parent_text string")
    wide = {(r.atom_id, r.chunk_id): r.text for r in evidence.hybrid(chunks, statements, parents=parents).collect()}
    some = {r.chunk_id for r in plain[:2]}
    assert all(t == f"around {c}" if c in some else not t.startswith("around") for (_, c), t in wide.items())


def test_a_rewritten_query_searches_with_its_own_words(spark, tables, monkeypatch):
    chunks, statements = tables
    monkeypatch.setitem(providers.REGISTRY, "rewrite", lambda text="text", out="query": lambda rows: rows.withColumn(out, F.lit("zürich rules nobody")))
    found = evidence.candidates(chunks, statements.where("atom_id = 3"), 3).where("place = 1").first()
    assert found.chunk_id == 120


def test_ungraded_candidates_stay_in_order(spark):
    rows = spark.createDataFrame([("a", 1, None), ("a", 2, None), ("a", 3, None), ("a", 4, None), ("b", 1, None), ("b", 2, 7.0), ("b", 11, 9.0), ("c", 1, 2.0)], "q string, place int, s double")
    got = sorted((r.q, r["rank"], r.place) for r in retrieval.rerank(rows, "q", "s").collect())
    assert got == [("a", 1, 1), ("a", 2, 2), ("a", 3, 3), ("b", 1, 2)]


def test_first_containing_equals_a_loop(spark):
    rng = random.Random(5)
    names = ["".join(rng.choices("abé_1", k=rng.randint(0, 9))) for _ in range(80)]
    patterns = ["", "a", "é", "ab", "b_1", "ab_é", "zzz", "zzzz", None, *["".join(rng.choices("ab1", k=rng.randint(1, 6))) for _ in range(60)], *(n[1:6] for n in names[:20])]
    variables = spark.createDataFrame([(n, i, i / 100) for i, n in enumerate(names)] + [(None, -1, 0.5)], "variable string, ord int, p_true double")
    got = {r.pattern: r.found.ord for r in factuality.first_containing(spark.createDataFrame([(p,) for p in patterns], "pattern string"), variables).collect()}
    want = {p: min(i for i, n in enumerate(names) if p in n) for p in patterns if p is not None and any(p in n for n in names)}
    assert got == want


def test_match_takes_the_first_by_id_or_text(spark):
    atoms = spark.createDataFrame([("a1", "x" * 60, "f"), ("a2", "", "f"), ("a3", None, "f"), (None, "v_q", "f"), ("none", "nothing here", "f")], "atom_id string, text string, field string")
    variables = spark.createDataFrame([("z_a2", 0.1, 0), ("v_q", 0.2, 1), ("x" * 50 + "a10", 0.3, 2), ("a1", 0.4, 3)], "variable string, p_true double, ord int")
    got = {r.atom_id: r.p_true for r in factuality.match(atoms, variables, "compat").collect()}
    assert got == {"a1": 0.3, "a2": 0.1, "a3": 0.1, None: 0.2, "none": None}


def test_bm25_hands_on_the_best_of_each_task_only(spark):
    """Documents are summed up where all their terms are; a pair of query and document is no row of a shuffle."""
    docs = spark.createDataFrame([(i, f"a b w{i % 7}" if i % 5 == 0 else f"c w{i % 7}") for i in range(400)], "doc_id long, text string")
    asked = spark.createDataFrame([(i, f"a w{i % 7} b") for i in range(50)], "item_id long, text string")
    few = retrieval.bm25(docs, asked)
    plan = few._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(item_id, doc_id" not in re.sub(r"#\d+L?", "", plan)
    as_rows = lambda d: sorted((r.item_id, r.doc_id, r["rank"], round(r.score, 9)) for r in d.collect())
    assert len(as_rows(few)) == 50 * 15 and as_rows(few) == as_rows(retrieval.bm25(docs, asked, terms_bound=3))


def test_the_corpus_is_joined_with_few_hits(spark, tables):
    """Texts and vectors of the corpus meet tables of hits, whose size is known, so neither is shuffled for them."""
    chunks, statements = tables
    seen = []
    real = evidence.materialise

    def told(df, name):
        seen.append((name, df._jdf.queryExecution().executedPlan().toString()))
        return real(df, name)

    with pytest.MonkeyPatch.context() as m:
        m.setattr(evidence, "materialise", told)
        evidence.candidates(chunks, statements, 3)
    plans = dict(seen)
    assert "SortMergeJoin" not in plans["evidence-texts"] and "BroadcastHashJoin" in plans["evidence-texts"]
    assert all("text" not in line for name in ("evidence-candidates", "evidence-found") for line in plans[name].split("\n") if "Scan ExistingRDD" in line)
