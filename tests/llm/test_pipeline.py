from __future__ import annotations

import random

import corpus_pipeline
from assay.llm import decontaminate, entries, mixing, quality_rules
from tests.llm.brute import near_components, repeats, words


def test_pipeline_equals_brute_force(spark, tmp_path):
    rng = random.Random(9)
    vocabulary = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(3, 8))) for _ in range(300)]
    passage, item = " ".join(rng.choices(vocabulary, k=60)), " ".join(rng.choices(vocabulary, k=30))
    rows = []
    for d in range(150):
        t = rng.choices(vocabulary, k=rng.randint(30, 120))
        kind = d % 10
        if kind == 1 and rows:
            t = words(rows[-1][1])[:-1] or t
        elif kind == 2:
            t[10:10] = passage.split()
        elif kind == 3:
            t[5:5] = item.split()
        elif kind == 4:
            t = [w + "###" for w in t] + ["|"] * 40
        rows.append((d, ". ".join(" ".join(t[i : i + 9]) for i in range(0, len(t), 9)) + ".", "en", f"s{d % 4}", 0))
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    sf = str(tmp_path)
    docs = entries.table(spark, sf, "documents")
    kept = {r["doc_id"] for r in quality_rules.assess(docs, ["doc_id"]).where("kept").collect()}
    assert not any(d % 10 == 4 for d in kept)
    left = [(r[0], r[1]) for r in rows if r[0] in kept]
    label, _ = near_components(left, 5)
    left = [(d, t) for d, t in left if label[d] == d]
    gone = repeats(left)
    left = [(d, " ".join(w for i, w in enumerate(words(t)) if i not in gone[d]) if gone[d] else t) for d, t in left]
    frame = spark.createDataFrame(left, "doc_id long, text string")
    leaks = {r["doc_id"] for r in decontaminate.find(frame, entries.table(spark, sf, "benchmark"), ["doc_id"]).where("size(found) > 0").collect()}
    assert leaks
    left = [(d, t) for d, t in left if d not in leaks]
    sources = {r[0]: r[3] for r in rows}
    plan = mixing.mix(spark.createDataFrame([(d, t, sources[d]) for d, t in left], "doc_id long, text string, source string"))
    want = {r["doc_id"]: r["copies"] for r in plan.collect() if r["copies"]}
    texts = dict(left)
    got: dict[int, int] = {}
    for r in corpus_pipeline.run(spark, sf).collect():
        assert r["text"] == texts[r["doc_id"]]
        assert r["n_chars"] == len(r["text"])
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + 1
    assert got == want


def test_stages_on_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
