"""The window index: hot anchors, fingerprints that say little, compaction, rows that share an id."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from assay.llm import kernels as K
from assay.llm import substring_dedup as S
from tests.llm.brute import repeats, words

SCHEMA = "doc_id long, text string"


def with_line(n, words_in_line=12, copies=0, seed=1):
    """n unlike documents with one line in common; the last `copies` of them repeat earlier ones."""
    rng = random.Random(seed)
    line = " ".join(f"line{i}" for i in range(words_in_line))
    made = [" ".join(f"d{d}w{rng.randrange(10**6)}" for _ in range(15)) + f"\n{line}\n" + " ".join(f"d{d}v{i}" for i in range(15)) for d in range(n - copies)]
    return list(enumerate(made + made[:copies]))


def spans_as_sets(rows):
    got = {}
    for r in rows:
        got.setdefault(r["doc_id"], set()).update(range(r["span"] >> 32, r["span"] & 0xFFFFFFFF))
    return got


def test_a_short_line_in_many_documents_fills_no_bucket():
    docs, buckets = with_line(5000), 64
    raw, offsets = K.string_parts(pa.array([t for _, t in docs]))
    made = S.text_entries(raw, offsets, np.arange(5000), np.zeros(5000, np.uint32))
    value, n = np.unique(made[0]["anchor"], return_counts=True)
    hot = np.sort(value[n >= 1000])
    assert len(hot)
    sizes = lambda hot: np.bincount([b for b, _, part in S.route(made, buckets, hot) for _ in range(len(part[1]))], minlength=buckets)
    assert sizes(np.zeros(0, K.U)).max() > 10 * len(made[1]) / buckets
    assert sizes(hot).max() < 1.5 * len(made[1]) / buckets


@pytest.mark.parametrize("hot_entries", [100, 10**9])
def test_hot_anchors_change_no_result(spark, hot_entries):
    docs = with_line(700, copies=40)
    df = spark.createDataFrame(docs, SCHEMA).repartition(4)
    surveyed = S.survey(df, hot_entries=hot_entries)
    assert surveyed[0] == sum(len(t) for _, t in docs)
    assert bool(len(surveyed[1])) == (hot_entries == 100)
    got = S.find_spans(df, [60, 300], bucket_windows=2000, surveyed=surveyed)
    assert spans_as_sets(got.collect()) == {d: g for d, g in repeats(docs).items() if g}


def test_words_decide_where_fingerprints_do_not(spark):
    # without fingerprints all windows on one anchor seem equal; copies among them are still found, by their words alone
    docs = with_line(60, copies=6, seed=2)
    df = spark.createDataFrame(docs, SCHEMA).repartition(3)
    want = repeats(docs)
    assert len(spans_as_sets(S.find_spans(df, [20], width=0).collect())) > sum(bool(g) for g in want.values())
    got = {r["doc_id"]: r for r in S.remove_repeats(df, ["doc_id"], width=0).collect()}
    for d, t in docs:
        assert got[d]["kept_text"] == " ".join(w for i, w in enumerate(words(t)) if i not in want[d])


def test_runs_are_appended_merged_and_dropped(spark):
    docs = with_line(120, copies=30, seed=3)
    index = S.FingerprintIndex(spark, 5, fan_in=3)
    counts, found = [], []
    for i in range(0, 120, 20):
        found += index.add(spark.createDataFrame(docs[i : i + 20], SCHEMA)).collect()
        counts.append(len(index.runs))
    assert counts == [1, 2, 1, 2, 1, 2]
    assert spans_as_sets(found) == {d: g for d, g in repeats(docs).items() if g}
    for row in index.history().collect():
        anchors = S._load(bytes(row["data"]))[0]["anchor"]
        assert (anchors[1:] >= anchors[:-1]).all()
    plan = index.history().select("bucket", "data").groupBy("bucket").cogroup(spark.createDataFrame([(1, b"")], "bucket int, data binary").groupBy("bucket")).applyInArrow(lambda a, b: a, "bucket int, data binary")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1  # the history is not shuffled
    table = index.table
    index.close()
    assert not spark.catalog.tableExists(table)


def test_entries_survive_a_blob():
    made = S.text_entries(*K.string_parts(pa.array([t for _, t in with_line(50)])), np.arange(50) - 7, np.arange(50, dtype=np.uint32) * 80_000_000)
    for width in (0, 3, 8):
        head, prints = S._load(S._dump(made, width))
        assert (head == made[0]).all()
        assert (prints == (made[1] & K.U((1 << 8 * width) - 1))).all()


def test_rows_that_share_an_id(spark):
    a, b = " ".join(f"a{i}" for i in range(30)), " ".join(f"b{i}" for i in range(30))
    rows = [(1, a, "x"), (1, b, "y"), (1, f"{b} {a}", "z"), (None, a, "u"), (None, b, "v"), (2, "", "e"), (2, None, "n")]
    df = spark.createDataFrame(rows, "doc_id long, text string, removed string")
    out = S.remove_repeats(df, ["doc_id", "removed"], share=0.5)
    assert out.columns == ["doc_id", "n_words", "n_removed", "kept_text", "removed"]
    kept = [r["kept_text"] for r in out.collect()]
    # of each passage one copy stays, whichever text of doc 1 comes first
    assert sorted(w for t in kept for w in words(t)) == sorted(words(a) + words(b))
    assert S.remove_repeats(df.where(F.lit(False)), ["doc_id"]).count() == 0
