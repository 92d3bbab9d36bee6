"""Queries see every row and the whole text: small tables whose rows lie past any id, language or prefix."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from assay import catalog
from assay.functions import fuzzy
from assay.operators import resolve, retrieval

LONG = "word " * 30 + "language:de task_ids: x"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("tables"))
    made = {
        "part": ([(600 + i, "Brand#1", f"alpha {i}", "T", 2) for i in range(6)], "p_partkey long, p_brand string, p_name string, p_type string, p_size int"),
        "lineitem": ([(k, n) for k in (1, 300, 9000) for n in (1, 2)], "l_orderkey long, l_linenumber int"),
        "customer": ([(k, f"Customer#{k:09d}") for k in (5, 399, 401, 7000, 7001)], "c_custkey long, c_name string"),
        "orders": ([(k,) for k in (5, 38, 399, 7000)], "o_custkey long"),
        "nation": ([(k, f"N{k}") for k in range(25)], "n_nationkey int, n_name string"),
        "events": ([(1000 + i, i % 3, ["click", "view", "buy"][i % 3], 1.0, '{"k": 1}') for i in range(42)], "event_id long, user_id long, event_type string, value double, props string"),
        "documents": ([(1, LONG, "en"), (2, "Ein Satz. " * 400, "de"), (3, "corto", "es")], "doc_id long, text string, lang string"),
        "benchmark": ([(7, LONG)], "item_id long, text string"),
        "conversations": ([(1, 0, "user", " " + "h" * 12_000), (1, 1, "assistant", "no")], "conv_id long, turn int, role string, text string"),
    }
    for name, (rows, schema) in made.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{at}/{name}.parquet")
    return at


def rows(spark, tables, name):
    return catalog.QUERIES[name](spark, tables).collect()


def test_every_row_is_seen(spark, tables):
    assert [(r["folder"], r["members"]) for r in rows(spark, tables, "a19_f3_collapse_votes")] == [("Brand#1", 6)]
    assert {(r["l_orderkey"], r["l_linenumber"]) for r in rows(spark, tables, "t10_tag_fields_whole")} == {(k, n) for k in (1, 300, 9000) for n in (1, 2)}
    assert {r["n_nationkey"]: r["found"] for r in rows(spark, tables, "j5_exact_then_suffix_whole")} == {k: "loose" if k % 2 else "exact" for k in range(25)}
    assert {(r["folder"], r["num_models"], r["members"]) for r in rows(spark, tables, "a5_suite_statistics_whole")} == {(f"f{i}", 3, 3) for i in range(7)}
    assert {r["bench"] for r in rows(spark, tables, "p2_suite_filter_whole")} == {"click", "view", "buy"}


def test_every_language_and_the_whole_text(spark, tables):
    got = {(r["doc_id"], r["parent_idx"], r["child_idx"]): r["text"] for r in rows(spark, tables, "t2_recursive_chunks")}
    texts = {1: LONG, 2: "Ein Satz. " * 400, 3: "corto"}
    assert got == {(d, i, j): c for d, t in texts.items() for i, p in enumerate(retrieval.split_text(t, 2048, 204)) for j, c in enumerate(retrieval.split_text(p, 512, 64))}
    assert [r["contexts"] for r in rows(spark, tables, "f9_f11_hybrid_evidence") if r["contexts"]]
    words = {r["doc_id"]: r["words"] for r in rows(spark, tables, "t6_expand_tags_whole")}
    assert words[1].endswith("language: German task: x")
    assert len(words[2]) > 4000
    assert [r["heading"] for r in sorted(rows(spark, tables, "w5_carried_heading_whole"), key=lambda r: r["turn"])] == ["h" * 12_000] * 2


def best_pairs(left, right, least):
    key = lambda x: x.strip().lower().replace("_", "-").replace(" ", "-")
    best = {}
    for a in set(left):
        found = [(-(101.0 if key(a) == key(b) else fuzzy.similarity(key(a), key(b))), b) for b in set(right)]
        if found and -min(found)[0] >= least:
            best[a] = min(found)
    out = {}
    for a, (s, b) in sorted(best.items(), key=lambda x: (x[1][0], x[0])):
        out.setdefault(b, (a, b, min(100.0, -s)))
    return {(a, b, round(s, 6)) for a, b, s in out.values()}


def test_fuzzy_match_of_all_customers(spark, tables):
    ids = (5, 399, 401, 7000, 7001)
    got = {tuple(r) for r in rows(spark, tables, "j8_fuzzy_match")}
    assert got == best_pairs([f"Customer# {k:08d}" for k in ids], [f"Customer#{k:09d}" for k in ids], 80.0)


@pytest.mark.parametrize("cell", [4000, 7])
def test_fuzzy_match_equals_brute_force(spark, cell):
    rng = random.Random(3)
    some = lambda n: ["".join(rng.choices("abé_ ", k=rng.randint(0, 9))) for _ in range(n)] + ["x" * 70 + "ab", "x" * 68 + "ba"]
    left, right = some(40), some(50)[:-1] + ["x" * 71 + "b"]
    a, b = (spark.createDataFrame([(x,) for x in [*side, None]], f"{n} string") for side, n in ((left, "l"), (right, "r")))
    got = {(r["l"], r["r"], round(r["similarity"], 6)) for r in resolve.fuzzy_match(a, b, "l", "r", cell=cell).where(F.col("l").isNotNull()).collect()}
    assert got == best_pairs(left, right, 80.0)


def test_closure_has_no_depth_bound(spark, tables):
    edges = spark.createDataFrame([(i, i + 1) for i in range(24)] + [(24, 3), (2, 9)], "src long, dst long")
    got = {(r["root"], r["node"]): r["depth"] for r in resolve.closure(edges, spark.createDataFrame([(0,), (0,), (20,)], "root long")).collect()}
    want = {}
    for root in (0, 20):
        want[root, root], queue = 0, [root]
        for node in queue:
            for to in ([3] if node == 24 else [node + 1]) + [9] * (node == 2):
                if (root, to) not in want:
                    want[root, to] = want[root, node] + 1
                    queue.append(to)
    assert got == want
    assert max(r["depth"] for r in resolve.closure(edges, spark.createDataFrame([(0,)], "root long"), 4).collect()) == 4
    assert {(r["root"], r["node"], r["depth"]) for r in rows(spark, tables, "r5_closure_whole")} >= {(5, 5, 0), (5, 38, 1), (5, 269, 2), (401, 401, 0)}
