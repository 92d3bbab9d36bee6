"""The evaluation plan on a set of sample files with known results."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from assay.operators import evaluations, suites
from assay.plans import evaluation
from assay.sources import evaluations as source

CORE, OPEN = "https://scores.example/%s.json", "hf_dataset"
LANGUAGES = [("Global MMLU Lite", 0.8798), ("Culturally Sensitive", 0.8522), ("Culturally Agnostic", 0.9075), ("Arabic", 0.88), ("English", 0.89), ("Bengali", 0.8875), ("German", 0.885), ("French", 0.88), ("Hindi", 0.8775), ("Indonesian", 0.88), ("Italian", 0.88), ("Japanese", 0.88), ("Korean", 0.875), ("Portuguese", 0.8875), ("Spanish", 0.875), ("Swahili", 0.87), ("Yoruba", 0.8725), ("Chinese", 0.8775), ("Burmese", 0.88)]
SUITES = {
    "helm_capabilities": ("OLMo 2 32B Instruct March 2025", [("Mean score", 0.475), ("MMLU-Pro", 0.414), ("GPQA", 0.287), ("IFEval", 0.78), ("WildBench", 0.734), ("Omni-MATH", 0.161)]),
    "helm_instruct": ("Claude v1.3", [("Mean win rate", 0.611), ("Anthropic RLHF dataset", 4.965), ("Best ChatGPT Prompts", 4.995), ("Koala test dataset", 4.981), ("Open Assistant", 4.975), ("Self Instruct", 4.992), ("Vicuna", 4.989)]),
    "helm_lite": ("Yi 34B", [("Mean win rate", 0.57), ("NarrativeQA", 0.782), ("NaturalQuestions (closed-book)", 0.443), ("OpenbookQA", 0.92), ("MMLU", 0.65), ("MATH", 0.375), ("GSM8K", 0.648), ("LegalBench", 0.618), ("MedQA", 0.656), ("WMT 2014", 0.172)]),
}
HUB = [("IFEval", "google/IFEval", 0.5033), ("BBH", "SaylorTwift/bbh", 0.6208), ("MATH Level 5", "DigitalLearningGmbH/MATH-lighteval", 0.2153), ("GPQA", "Idavidrein/gpqa", 0.3557), ("MUSR", "TAUR-Lab/MuSR", 0.4413), ("MMLU-PRO", "TIGER-Lab/MMLU-Pro", 0.4741)]
LEVELS = [("Hard Problems", 0.0), ("Medium Problems", 0.1267605633802817), ("Easy Problems", 0.7605633802816901)]


def result(name, dataset, score, kind="url", repo=None, url=None):
    return {"evaluation_name": name, "source_data": {"dataset_name": dataset, "source_type": kind, "hf_repo": repo, "url": [url] if url else None}, "metric_config": {"lower_is_better": False}, "score_details": {"score": score}}


def write(root, files):
    for name, (model, results) in files.items():
        (root / f"{name}.json").write_text(json.dumps({"model_info": {"name": model}, "evaluation_results": results}))
    return str(root)


@pytest.fixture(scope="module")
def samples(tmp_path_factory):
    files = {"global-mmlu-lite": ("qwen3-235b", [result(n, "global-mmlu-lite", s, url=CORE % "mmlu") for n, s in LANGUAGES])}
    files |= {f: (m, [result(n, f if n.startswith("Mean") else n, s, url=CORE % f) for n, s in rows]) for f, (m, rows) in SUITES.items()}
    files["hfopenllm_v2"] = ("YiSM", [result(n, n, s, OPEN, r) for n, r, s in HUB])
    files["livecodebenchpro"] = ("qwen3-thinking", [result(n, n, s, url=CORE % n[:4]) for n, s in LEVELS])
    files["test_eval"] = ("Llama 3.1 8B Instruct", [result("GSM8K", "gsm8k", 75.2, OPEN, "openai/gsm8k")])
    return write(tmp_path_factory.mktemp("samples"), files)


@pytest.fixture(scope="module")
def found(spark, samples):
    return evaluation.prepare(spark, samples)


def test_counts_before_merging(spark, samples):
    rows = source.scores(source.results(source.scan(spark, samples)))
    assert rows.count() == 49
    up = {r["name"]: r for r in evaluations.roll_up(rows).collect()}
    assert len(up) == 27
    assert {n: up[n]["hf_repo"] for n in ("MMLU-Pro", "GPQA", "IFEval", "GSM8K")} == {"MMLU-Pro": "TIGER-Lab/MMLU-Pro", "GPQA": "Idavidrein/gpqa", "IFEval": "google/IFEval", "GSM8K": "openai/gsm8k"}
    assert {up[n]["source_type"] for n in ("MMLU-Pro", "GPQA", "IFEval", "GSM8K")} == {OPEN}
    metadata = {r["folder"]: r["urls"] for r in source.folder_metadata(source.results(source.scan(spark, samples))).collect()}
    assert metadata == {f: [CORE % f] for f in SUITES}
    want = {"GPQA": (2, 0.3214, 0.0486, 0.287, 0.3557), "IFEval": (2, 0.6417, 0.1957, 0.5033, 0.78), "GSM8K": (2, 37.924, 52.7162, 0.648, 75.2), "MMLU-Pro": (1, 0.414, 0.0, 0.414, 0.414)}
    scored = evaluations.average_subjects(evaluations.keyed(rows))
    # names of benchmarks stand for metrics here; spellings of one metric are metrics of their own
    got = {r["metric"]: (r["n"], r["mean"], r["sd"], r["least"], r["greatest"]) for r in evaluations.summary(scored).collect()}
    assert {k: got[k] for k in want} == want
    assert got["average_across_subjects"][1] == 0.8798


def test_votes(found):
    got = {r["folder"]: r for r in found.votes.collect()}
    want = {"helm_capabilities": (5, 17.72, 1), "helm_instruct": (6, 30.27, 1), "hfopenllm_v2": (6, 13.51, 1), "livecodebenchpro": (3, 73.26, 1), "helm_lite": (9, 20.15, 2)}
    assert {f: (r["members"], round(r["similarity"], 2), r["signals"]) for f, r in got.items()} == want


def test_suites_and_merged_benchmark(spark, found):
    assert found.benchmarks.count() == 19
    assert {r["folder"]: len(r["members"]) for r in found.composites.collect()} == {"helm_capabilities": 5, "helm_instruct": 6, "hfopenllm_v2": 6, "livecodebenchpro": 3}
    lite = found.benchmarks.where("name = 'Lite'").first()
    assert (lite["folders"], lite["hf_repo"], lite["source_type"], lite["num_models"]) == (["helm_lite"], "openai/gsm8k", OPEN, 2)
    assert lite["metrics"][:2] == ["NarrativeQA", "NaturalQuestions (closed-book)"]
    rows = {r["model"]: r for r in found.scores.where("bench = 'lite'").collect()}
    assert {m: r["score"] for m, r in rows.items()} == pytest.approx({"Yi 34B": 0.5848888888888889, "Llama 3.1 8B Instruct": 75.2})
    assert [s["subject"] for s in rows["Yi 34B"]["subject_scores"]] == [n for n, _ in SUITES["helm_lite"][1][1:]]
    made = {r["name"]: r for r in evaluation.inputs(spark, found).collect()}
    assert len(made) == 19 + 4
    assert made["helm_instruct"]["metadata"]["contains"] == sorted(n for n, _ in SUITES["helm_instruct"][1][1:])
    assert made["GPQA"]["metadata"]["appears_in"] == ["helm_capabilities", "hfopenllm_v2"]
    assert made["Koala test dataset"]["hf_repo"] == "HuggingFaceH4/Koala-test-set"
    assert made["GPQA"]["metadata"]["evaluation_summary"]["score_statistics"]["std_dev"] == 0.0486


def test_no_collapse_keeps_all(spark, samples):
    assert evaluation.prepare(spark, samples, collapse=False).benchmarks.count() == 27


def test_names_of_parents_and_children(spark, tmp_path):
    files = {
        "a": ("m1", [result(n, n, s, url="u1", repo="o/r", kind=OPEN) for n, s in [("MGSM - Bengali", 0.1), ("MGSM - Overall", 0.9), ("MGSM - Chinese", 0.3)]]),
        "b": ("m2", [result("MGSM - Bengali", "MGSM - Bengali", 0.5, url="u1", repo="o/r", kind=OPEN)]),
        "c": ("m1", [result(n, n, s, url="u2", repo="o/x", kind=OPEN) for n, s in [("Known - One", 0.2), ("Known - Two", 0.4)]]),
        "d": ("m1", [result("Known", "Known", 0.7, url="u3")]),
    }
    found = evaluation.prepare(spark, write(tmp_path, files))
    assert {r["name"]: r["urls"] for r in found.benchmarks.collect()} == {"MGSM": ["u1"], "Known": ["u3", "u2"]}
    rows = {(r["bench"], r["model"]): (r["score"], [(s["subject"], s["score"]) for s in r["subject_scores"] or []]) for r in found.scores.collect()}
    assert rows == {("mgsm", "m1"): (0.9, [("Bengali", 0.1), ("Overall", 0.9), ("Chinese", 0.3)]), ("known", "m1"): (0.7, [("One", 0.2), ("Two", 0.4)])}


def test_folders_that_share_a_benchmark_are_judged_in_order(spark, tmp_path):
    # both folders look like one benchmark; the first takes what they share, the second is judged without it
    made = lambda names: ("m", [result(n, n, 0.5, url="u", repo="o/r", kind=OPEN) for n in names])
    found = evaluation.prepare(spark, write(tmp_path, {"one": made(["abcd x", "abcd y"]), "two": made(["abcd y", "abcd z", "abcd w"])}))
    got = {r["name"]: r for r in found.benchmarks.collect()}
    assert set(got) == {"Abcd"} or len(got) == 2
    assert {r["folder"] for r in found.votes.where("collapse").collect()} == {"one", "two"}


@pytest.mark.parametrize("n", [1, 2, 6, 7, 9, 40])
def test_pair_sample_equals_all_pairs(spark, n):
    names = [f"b{i * 7919 % 1000:03d}" for i in range(n)]
    pairs = sorted((a, b) for i, a in enumerate(names) for b in names[i + 1 :])
    want = pairs if len(pairs) <= 20 else pairs[:: max(1, len(pairs) // 20)][:20]
    members = spark.createDataFrame([("k", b, i) for i, b in enumerate(names)], "folder string, bench string, pos int")
    assert sorted((r["a"], r["b"]) for r in evaluations.pair_sample(members, "folder").collect()) == want


def test_inputs_given_by_hand(spark):
    rows = spark.createDataFrame([("x", "https://p", None, ["y"])], "name string, paper_url string, hf_repo string, appears_in array<string>")
    r = suites.manual_inputs(rows).first()
    assert (r["extracted_ids"]["paper_url"], r["metadata"]["source_type"], r["metadata"]["appears_in"], r["metadata"]["metrics"]) == ("https://p", "manual", ["y"], [])
    assert r["metadata"]["evaluation_summary"] is None
