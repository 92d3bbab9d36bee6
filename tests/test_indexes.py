"""The kept indexes against the searches without an index."""

from __future__ import annotations

import random
import re
import shutil
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from assay.operators import blocks, bm25_index, retrieval, vector_index

WORDS = [f"w{i}" for i in range(60)]


def corpus(spark, n=300, seed=3):
    rng = random.Random(seed)
    weights = [1 / (i + 1) for i in range(len(WORDS))]
    rows = [(i, " ".join(rng.choices(WORDS, weights, k=rng.choice([0, 3, 10, 40, 200])))) for i in range(n)] + [(n, None), (n + 1, "")]
    return spark.createDataFrame(rows, "doc_id long, text string")


def asked(spark):
    return spark.createDataFrame([(1, "w0 w5 w59"), (2, "w40 w40 w41 w3"), (3, "unknown"), (4, None), (5, " ".join(WORDS))], "item_id long, text string")


def hits(df, *keys):
    return sorted((tuple(r[k] for k in keys), round(r.score, 9)) for r in df.collect())


def indexed(spark, tmp_path, docs, batches):
    path = f"file://{tmp_path}/index"
    for some in batches:
        bm25_index.add(docs.where(some), path)
    return path


def test_batches_equal_one_build_and_the_search_without_an_index(spark, tmp_path):
    docs = corpus(spark)
    want = hits(retrieval.bm25(docs, asked(spark)), "item_id", "doc_id", "rank")
    assert len(want) > 30
    path = indexed(spark, tmp_path, docs, ["doc_id < 100", "doc_id >= 100 AND doc_id < 110", "doc_id >= 50"])
    assert hits(bm25_index.search(spark, path, asked(spark)), "item_id", "doc_id", "rank") == want
    assert sum(r.n_docs for r in bm25_index.versions(spark, path)[1]) == docs.count()
    bm25_index.compact(spark, path)
    assert [r.batch for r in bm25_index.versions(spark, path)[1]] == [4]
    assert sorted(p.name for p in (tmp_path / "index" / "postings").iterdir() if p.is_dir()) == ["batch=4"]
    assert hits(bm25_index.search(spark, path, asked(spark)), "item_id", "doc_id", "rank") == want


def test_only_buckets_of_the_queries_terms_are_read(spark, tmp_path):
    path = indexed(spark, tmp_path, corpus(spark), ["true"])
    one = spark.createDataFrame([(1, "w7 w9")], "item_id long, text string")
    want = hits(bm25_index.search(spark, path, one), "item_id", "doc_id")
    keep = {r[0] for r in spark.createDataFrame([("w7",), ("w9",)], "term string").select(bm25_index.bucket()).collect()}
    gone = [p for p in (tmp_path / "index").rglob("bucket=*") if int(p.name.split("=")[1]) not in keep]
    assert gone
    for p in gone:
        shutil.rmtree(p)
    assert want and hits(bm25_index.search(spark, path, one), "item_id", "doc_id") == want


def test_a_batch_that_failed_half_way_does_not_count(spark, tmp_path):
    docs = corpus(spark)
    path = indexed(spark, tmp_path, docs, ["doc_id < 200"])
    want = hits(bm25_index.search(spark, path, asked(spark)), "item_id", "doc_id")
    bm25_index._write(spark.createDataFrame([("w5", 999, 5, 9, 20_000)], "term string, key long, dl int, tf long, block long"), path, "postings", 2)
    assert hits(bm25_index.search(spark, path, asked(spark)), "item_id", "doc_id") == want
    bm25_index.add(docs, path)
    assert hits(bm25_index.search(spark, path, asked(spark)), "item_id", "doc_id") == hits(retrieval.bm25(docs, asked(spark)), "item_id", "doc_id")


def test_bounds_hold_for_every_document_of_a_block(spark, tmp_path):
    path = indexed(spark, tmp_path, corpus(spark), ["doc_id < 150", "doc_id >= 150"])
    both = spark.read.parquet(f"{path}/postings").where("term <> ''").join(spark.read.parquet(f"{path}/blocks").select("term", "block", "max_tf", "min_dl"), ["term", "block"])
    low = F.count_if(bm25_index.gain("max_tf", "min_dl", 30.0) < bm25_index.gain("tf", "dl", 30.0))
    assert both.agg(low).first()[0] == 0 and both.count() > 1000


def vectors(spark, n=1200, size=16, seed=5):
    rng = np.random.default_rng(seed)
    rows = rng.normal(size=(40, size))[rng.integers(0, 40, n)] + 0.6 * rng.normal(size=(n, size))
    rows /= np.linalg.norm(rows, axis=1, keepdims=True)
    made = [(i, [float(x) for x in r]) for i, r in enumerate(rows)]
    return spark.createDataFrame([*made, (n, made[0][1]), (n + 1, None)], "vec_id long, embedding array<float>")


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    v = vectors(spark)
    path = f"file://{tmp_path_factory.mktemp('vectors')}/index"
    vector_index.build(v.where("vec_id < 1000"), path, lists=32)
    vector_index.add(v.where("vec_id >= 1000"), path)
    q = v.where("vec_id % 10 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    return v, q, path


def found(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.query_id, {})[r.vec_id] = r["rank"]
    return out


def test_exact_search_equals_the_exhaustive_one(spark, index):
    v, q, path = index
    assert found(vector_index.search(spark, path, q, exact=True, probes=2)) == found(retrieval.dense_search(v.where("embedding IS NOT NULL"), q))
    few = v.limit(0).select(F.col("vec_id").alias("query_id"), "embedding")
    assert vector_index.search(spark, path, few, exact=True).count() == 0


def test_recall_of_probing_is_over_nine_tenths(spark, index):
    v, q, path = index
    want, got = found(retrieval.dense_search(v.where("embedding IS NOT NULL"), q)), found(vector_index.search(spark, path, q))
    recall = sum(len(want[k].keys() & got[k].keys()) for k in want) / sum(map(len, want.values()))
    assert recall >= 0.9
    assert len(list(Path(path.removeprefix("file://"), "lists").glob("list=*"))) <= 32


def all_pairs(v, q, top):
    """The best by the column expression on every pair."""
    pairs = v.crossJoin(q.withColumnRenamed("embedding", "_q")).select("query_id", "vec_id", retrieval.cosine("embedding", "_q").alias("score"))
    return pairs, retrieval.ranked(pairs, "query_id", [F.desc("score"), F.col("vec_id")], top)


@pytest.mark.parametrize(("kind", "n"), [("long", 400), ("string", 400), ("long", 6)])
def test_dense_search_by_blocks_equals_all_pairs(spark, kind, n):
    """Copies, null ids and vectors, vectors of another length, and elements that are no numbers; scores are the same to the last bit."""
    rng = np.random.default_rng(2)
    made = rng.normal(size=(n // 3, 7)).astype(np.float32)
    rows = [(i, made[i % len(made)].tolist()) for i in range(n)] + [(n, None), (n + 1, None), (None, made[0].tolist()), (n + 3, [float("nan")] * 7), (n + 4, [1.0] * 3), (n + 5, [1.0, None, *[0.0] * 5]), (n + 6, [float("inf")] * 7), (n + 7, [])]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("vec_id", F.col("vec_id").cast(kind)).repartition(3)
    q = spark.createDataFrame([(f"q{i}", x) for i, x in rows if i is None or i % 5 == 0 or i >= n], "query_id string, embedding array<float>")
    _, want = all_pairs(v, q, 15)
    as_rows = lambda d: {(r.query_id, r.vec_id, r["rank"], repr(r.score)) for r in d.collect()}
    assert as_rows(retrieval.dense_search(v, q)) == as_rows(want)
    assert as_rows(retrieval.dense_search(v, q, rows_bound=7)) == as_rows(want)
    assert retrieval.dense_search(v.limit(0), q).count() == retrieval.dense_search(v, q.limit(0)).count() == 0


def test_dense_search_hands_on_few_pairs(spark):
    """A task hands on the best of its blocks, also of a group of copies, not a row for each pair."""
    x = [[1.0, 0.0], [0.6, 0.8]]
    v = spark.createDataFrame([(i, x[i % 10 == 0]) for i in range(2000)], "vec_id long, embedding array<float>").coalesce(1)
    q = v.where("vec_id < 20").select(F.col("vec_id").alias("query_id"), "embedding")
    pairs = blocks.packed(v, "vec_id", copies=15).crossJoin(blocks.packed(q.coalesce(1), "query_id").withColumnRenamed("embedding", "_q"))
    assert blocks.nearest(pairs, "vec_id", "query_id", 15, (False, False)).count() == 20 * 15
    plan = retrieval.dense_search(v, q)._jdf.queryExecution().toString()
    assert "zip_with" not in plan and "MapInArrow" in plan


def test_marginal_relevance_starts_from_the_block_search(spark):
    """Its candidates are the best of all pairs, without a row for each pair."""
    from assay import catalog

    got = catalog.QUERIES["l2_mmr"](spark, "/root/testdata/sf0.001")
    assert "zip_with" not in got._jdf.queryExecution().toString()
    v = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "embedding")
    _, near = all_pairs(v, v.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "embedding"), 23)
    want = retrieval.mmr(near.join(v, "vec_id"), "query_id", "vec_id", 9)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_lists_meet_queries_in_blocks(spark, index):
    """Neither search has a row for each pair of a query and a vector, and lists that are open to no query are not read."""
    v, q, path = index
    at = vector_index.load(spark, path)
    cut = spark.createDataFrame([(k, row.tolist(), 0.0) for k, row in enumerate(at)], "list int, centre array<double>, radius double")
    one = spark.createDataFrame([(1, [float(x) for x in at[3]], 0.9999), (2, None, None)], "query_id long, embedding array<float>, floor double").where("query_id = 1")
    asked = blocks.packed(one, "query_id").withColumnRenamed("embedding", "_q")
    assert [r.list for r in blocks.reached(cut.crossJoin(asked), "list", False, vector_index.SLACK).collect()] == [3]
    seen = []
    real = vector_index.materialise
    with pytest.MonkeyPatch.context() as m:
        m.setattr(vector_index, "materialise", lambda df, name: (seen.append((name, df._jdf.queryExecution().toString())), real(df, name))[1])
        got = found(vector_index.search(spark, path, q, exact=True))
    assert got == found(retrieval.dense_search(v.where("embedding IS NOT NULL"), q))
    assert {"vector-near", "vector-hits"} <= {name for name, _ in seen} and not any("zip_with" in plan for _, plan in seen)


def test_words_are_counted_without_a_shuffle(spark):
    words = spark.createDataFrame([(1, ["b", "a", "b", ""]), (2, []), (3, [""]), (None, ["é", "b", "é"])] + [(k, ["w"] * k) for k in range(4, 700)], "key long, _w array<string>").coalesce(1)
    got = bm25_index.counted(words)
    assert "Exchange" not in got._jdf.queryExecution().executedPlan().toString().replace("ReusedExchange", "Exchange")
    want = words.select("key", F.explode("_w").alias("term")).groupBy("key", "term").agg(F.count("*").alias("tf"))
    assert sorted(map(str, got.select("key", "term", "tf").collect())) == sorted(map(str, want.collect()))
    assert bm25_index.counted(words.limit(0)).count() == 0


def test_a_key_that_comes_twice_in_a_batch_has_one_posting_a_term(spark, tmp_path):
    """Rows of one key and length are counted together, as a group would."""
    docs = spark.createDataFrame([(7, "w5 w5 w59"), (7, "w5 w3 w59"), (8, "w5"), (9, None)], "doc_id long, text string")
    path = indexed(spark, tmp_path, docs, ["true"])
    got = spark.read.parquet(f"{path}/postings").select("key", "dl", "term", "tf").collect()
    assert sorted(map(tuple, got), key=str) == sorted([(7, 3, "", 2), (7, 3, "w5", 3), (7, 3, "w59", 2), (7, 3, "w3", 1), (8, 1, "", 1), (8, 1, "w5", 1), (9, None, "", 1)], key=str)


def test_postings_are_dealt_by_document_before_queries_meet_them(spark, tmp_path):
    """A pair of a query and a posting is no row of a shuffle."""
    path = indexed(spark, tmp_path, corpus(spark), ["true"])
    seen = {}
    real = bm25_index.materialise
    with pytest.MonkeyPatch.context() as m:
        m.setattr(bm25_index, "materialise", lambda df, name: (seen.update({name: df._jdf.queryExecution().executedPlan().toString()}), real(df, name))[1])
        bm25_index.search(spark, path, asked(spark))
    assert "hashpartitioning(key" in seen["bm25-hits"] and not re.search(r"hashpartitioning\(item_id#\d+L?, (key|doc_id|block)", seen["bm25-hits"])
