"""Operators against plain Python restatements and hand-made fixtures."""

from __future__ import annotations

import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from assay.functions import fuzzy, names, text
from assay.operators import cards, evaluations, factuality, resolve, retrieval
from assay.plans import evaluation, routing
from assay.sources import evaluations as source
from assay.streaming import incremental


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(("sub", "parent", "want"), [("rewardbench_2_safety", "rewardbench_2", "safety"), ("bfcl_multi_turn", "bfcl", "multi turn"), ("arc_agi_v2_public_eval", "arc_agi", "v2 public eval")])
def test_sub_label(spark, sub, parent, want):
    assert one(spark, names.sub_label(F.lit(sub), F.lit(parent))) == want


def test_names_of_unlike_spelling_meet(spark):
    assert one(spark, names.normalize_name(F.lit(" MMLU_PRO\t"))) == one(spark, names.normalize_name(F.lit("MMLU-Pro"))) == "mmlu-pro"


@given(st.text("ab c", max_size=12), st.text("ab c", max_size=12))
@settings(max_examples=200, deadline=None)
def test_similarity_is_longest_common_subsequence(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    want = 100.0 if not a and not b else 200 * table[-1][-1] / (len(a) + len(b))
    assert fuzzy.similarity(a, b) == pytest.approx(want)


@given(st.text("ab. \n", max_size=300))
@settings(max_examples=100, deadline=None)
def test_splitter_keeps_all_words_within_size(t):
    parts = retrieval.split_text(t, 40, 8)
    assert all(len(p) <= 40 for p in parts)
    assert set("".join(t.split())) == set("".join("".join(parts).split()))


def evaluation_file(model, results):
    return {"model_info": {"name": model}, "evaluation_results": [{"evaluation_name": n, "source_data": {"dataset_name": d, "source_type": t, "hf_repo": r, "url": u}, "metric_config": {}, "score_details": {"score": s}} for n, d, t, r, u, s in results]}


@pytest.fixture
def folder(tmp_path):
    files = {
        "a.json": evaluation_file("m1", [("GSM8K", "GSM8K", "url", None, ["u1"], 0.5), ("Mean score", "all", "url", None, ["u1"], 0.9), ("x", "unknown", "url", None, [], 1.0)]),
        "b.json": evaluation_file("m2", [("gsm8k", "gsm8k", "hf_dataset", "o/gsm8k", [], 75.0), ("ARC", "ARC", "url", None, ["u2"], 0.1)]),
        "subjects.json": evaluation_file("m1", [(f"lang {i}", "Lite", "url", None, ["u3"], float(i)) for i in range(4)]),
    }
    for name, body in files.items():
        (tmp_path / name).write_text(json.dumps(body))
    (tmp_path / "broken.json").write_text("{")
    return str(tmp_path)


def test_scan_rolls_up_and_averages(spark, folder):
    files = source.scan(spark, folder)
    assert source.errors(files).count() == 1
    rows = source.scores(source.results(files))
    assert rows.count() == 7
    up = {r["bench"]: r for r in evaluations.roll_up(rows).collect()}
    assert set(up) == {"gsm8k", "arc", "lite"}
    assert (up["gsm8k"]["name"], up["gsm8k"]["hf_repo"], up["gsm8k"]["source_type"], up["gsm8k"]["folders"]) == ("GSM8K", "o/gsm8k", "hf_dataset", ["a", "b"])
    got = {(r["bench"], r["model"]): r for r in evaluations.average_subjects(evaluations.keyed(rows)).collect()}
    assert got["lite", "m1"]["score"] == 1.5
    assert len(got["lite", "m1"]["subject_scores"]) == 4
    whole = evaluation.prepare(spark, folder)
    assert {r["folder"] for r in whole.suites.collect()} == {"b"}


def test_new_files_come_once(spark, folder, tmp_path_factory):
    seen = []
    check = str(tmp_path_factory.mktemp("check"))
    for _ in range(2):
        incremental.run_available(incremental.evaluation_stream(spark, folder), check, lambda b, _: seen.append(b.count()))
    assert sum(seen) == 4


def test_upsert_keeps_one_row_a_key(spark, tmp_path):
    step = incremental.upsert(str(tmp_path / "cards"), "k")
    step(spark.createDataFrame([("a", 1), ("b", 1)], "k string, v int"), 0)
    step(spark.createDataFrame([("b", 2), ("c", 2)], "k string, v int"), 1)
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "cards")).collect())) == [("a", 1), ("b", 2), ("c", 2)]


def test_compat_match_takes_first_variable(spark):
    atoms = spark.createDataFrame([("a1", "text one", "f")], "atom_id string, text string, field string")
    marginals = spark.createDataFrame([("a10", 0.1, 1), ("a1", 0.9, 2)], "variable string, p_true double, ord int")
    assert factuality.match(atoms, marginals).first()["p_true"] == 0.9
    assert factuality.match(atoms, marginals, "compat").first()["p_true"] == 0.1


def test_path_repair(spark):
    row = spark.createDataFrame([("methodology.result", "Model achieved 85% accuracy")], "f string, s string")
    assert row.select(cards.repaired("f", "s")).first()[0] == "methodology.interpretation"


def test_override_with_null_wins(spark):
    rows = spark.createDataFrame([("WMT 2014", "x"), ("other", "y")], "name string, repo string")
    got = {r["name"]: r["repo"] for r in resolve.with_override(rows, resolve.repository_overrides(spark), F.lower("name"), "repo").collect()}
    assert got == {"WMT 2014": None, "other": "y"}


def test_grade_is_greedy(spark):
    rows = [("q", 1, "a text that is long enough to stay"), ("q", 2, "text that is long enough"), ("q", 3, "short"), ("q", 4, "another text that is long enough")]
    got = retrieval.grade(spark.createDataFrame(rows, "q string, ord int, text string"), "q", "ord")
    assert sorted(r["ord"] for r in got.collect()) == [1, 4]


def test_references_go(spark):
    t = "Body text [1, 2].\nMore.\n\nReferences\n\n[1] A. Author."
    assert one(spark, text.strip_references(F.lit(t))) == "Body text .\nMore."


def test_failed_step_is_not_taken_again(spark):
    flags = {f.split()[0]: False for f in routing.STATE.split(", ") if f.endswith("boolean")}
    rows = [(log, *flags.values()) for log in ([], ["catalog failed: x"])]
    states = spark.createDataFrame(rows, "log array<string>, " + ", ".join(f"{k} boolean" for k in flags))
    assert [r["next"] for r in routing.routed(states).orderBy(F.size("log")).collect()] == ["catalog", "ids"]


def test_no_cartesian_plan_for_bm25(spark):
    docs = spark.createDataFrame([(1, "a b c"), (2, "b c d")], "doc_id long, text string")
    plan = retrieval.bm25(docs, docs.withColumnRenamed("doc_id", "item_id"))._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan
    assert "WindowGroupLimit" in plan


def test_generate_skips_what_is_done(spark, folder, tmp_path):
    from assay import cli

    out = str(tmp_path / "out" / "summaries")
    first = {r["bench"]: r["status"] for r in cli.generate(spark, folder, out).collect()}
    assert set(first) == {"gsm8k", "arc", "lite"}
    assert set(first.values()) == {"written"}
    assert {r["status"] for r in cli.generate(spark, folder, out, ["arc", "Lite"]).collect()} == {"skipped"}


def test_sessions(spark, tmp_path):
    from assay import cli

    for name in ("a_2024", "b_2025"):
        (tmp_path / "s" / name / "tool_output" / "hub").mkdir(parents=True)
        (tmp_path / "s" / name / "tool_output" / "hub" / "x.json").write_text("{}")
    (tmp_path / "s" / "a_2024" / "card").mkdir()
    (tmp_path / "s" / "a_2024" / "card" / "c.json").write_text("{}")
    got = {r["session"]: (r["files"], r["tools"], r["completed"]) for r in cli.sessions(spark, str(tmp_path / "s")).collect()}
    assert got == {"a_2024": (2, 1, True), "b_2025": (1, 1, False)}
    assert cli.show(spark, str(tmp_path / "s"), "a_2024").count() == 2
    assert cli.validate(spark).count() >= 7


def test_catalog_references(spark, tmp_path):
    from assay.sources import files

    for path, body in {"cards/x.json": '{"loader": {"path": "o/x"}, "task": "tasks.qa.open"}', "tasks/qa/open.json": '{"metrics": ["metrics.f1"], "self": "tasks.qa.open"}', "metrics/f1.json": "{}"}.items():
        (tmp_path / path).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / path).write_text(body)
    entries = files.catalog(spark, str(tmp_path))
    edges = files.references(entries)
    assert {tuple(r) for r in edges.collect()} == {("cards.x", "tasks.qa.open"), ("tasks.qa.open", "metrics.f1")}
    reach = resolve.closure(edges, spark.createDataFrame([("cards.x",)], "root string"))
    assert {(r["node"], r["depth"]) for r in reach.collect()} == {("cards.x", 0), ("tasks.qa.open", 1), ("metrics.f1", 2)}
    assert [tuple(r)[:2] for r in files.repository_index(entries).collect()] == [("o/x", "cards.x")]
    assert [r["name"] for r in files.card_names(entries).collect()] == ["x"]


def test_seconds_are_rounded_as_sql_does(spark):
    """Ties of the exact binary value go to the even digit, 0.35 lies below one, and no time is none."""
    some = [0.35, 0.95, 6.85, 37.25, 37.75, 41.05, -0.04, -37.25, 59.96, 59.94, 0.05, 1e-300, 60.0, 3599.999, 3600.0, None]
    got = [r.t for r in spark.createDataFrame([(i, x) for i, x in enumerate(some)], "i int, s double").select("i", names.duration("s").alias("t")).orderBy("i").collect()]
    assert got == [f"{x:.1f}s" for x in some[:12]] + ["1m 0s", "59m 59s", "1h 0m", None]
