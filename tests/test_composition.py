"""Facts to cards, the order of the last steps, sub-benchmarks, stages, and the small helpers around them."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from assay import operations
from assay.functions import artifacts, checks
from assay.plans import composition as P
from assay.plans import evidence
from assay.sources import files, pages, papers
from assay.streaming import incremental

CARD = "card_id string, section string, field string, value array<string>, is_list boolean"


def rows_of(card):
    return {(r["card_id"], r["section"], r["field"]): r["value"] for r in card.collect()}


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


def test_sources_become_a_card(spark):
    paper = "## benchmark_details\n- overview: From the paper\n- domains: No information found\n## methodology\n- metrics: accuracy; f1\n- calculation: No information found\n\nOverall score calculation: an aggregate average.\n- calculation: mean of all\n"
    readme = "## benchmark_details\n- overview: From the page\n- languages: English, German\n- resources: o/x\n" + "." * 80
    sources = spark.createDataFrame([("c", "Bench", "", paper, "short", readme)], "card_id string, name string, anchor string, paper string, html string, readme string")
    texts = {r["source"] for r in P.source_texts(sources).collect()}
    assert texts == {"PAPER", "HF_README"}
    facts = spark.createDataFrame([("c", "data", "format", "DETERMINISTIC", "csv")], "card_id string, section string, field string, source string, value string")
    addresses = spark.createDataFrame([("c", ["https://p", "https://huggingface.co/datasets/o/x"])], "card_id string, value array<string>")
    card, provenance = P.compose(sources, facts, addresses=addresses)
    got = {k[1:]: v for k, v in rows_of(card).items()}
    assert got["benchmark_details", "overview"] == ["From the paper"]
    assert got["benchmark_details", "languages"] == ["English", "German"]
    assert got["benchmark_details", "domains"] == ["Not specified"]
    assert got["methodology", "metrics"] == ["accuracy", "f1"]
    assert got["methodology", "calculation"] == ["mean of all"]
    assert got["data", "format"] == ["csv"]
    assert got["benchmark_details", "name"] == ["Bench"]
    assert "https://p" in got["benchmark_details", "resources"]
    assert provenance.where("source = 'PAPER'").count() == 3
    whole = json.loads(P.card_rows(card).first()["card"])
    assert list(whole) == ["benchmark_details", "data", "methodology"]
    assert whole["methodology"]["metrics"] == ["accuracy", "f1"]
    said = P.use_case(card).first()["text"]
    assert said.startswith("Bench is a benchmark. From the paper. Evaluation methods") or said.startswith("Bench is a benchmark. From the paper. Metrics: accuracy, f1")
    assert P.output_text(card, "all").first()["text"].startswith("From the paper")
    assert {r["field"] for r in P.atomised(card).collect()} >= {"benchmark_details.overview"}


def test_last_steps_keep_their_order(spark):
    card = spark.createDataFrame([("c", "benchmark_details", "languages", ["xx"], True), ("c", "data", "size", ["Not specified"], False), ("c", "data", "source", ["said"], False), ("c", "methodology", "interpretation", ["x"], False), ("c", "data", "format", [], False)], CARD)
    fields = spark.createDataFrame([("c", f, 0.1, False) for f in ("benchmark_details.languages", "data.source", "methodology.interpretation", "data.size")], "card_id string, field string, avg_probability double, all_neutral boolean")
    provenance = spark.createDataFrame([("c", "data", "size", "PAPER", "twelve thousand rows")], "card_id string, section string, field string, source string, evidence string")
    overrides = spark.createDataFrame([("c", "benchmark_details", "languages", ["English"])], "card_id string, section string, field string, value array<string>")
    done, flags, missing, info = P.finalise(card, fields, provenance, overrides, "m", F.lit("now"))
    got = {k[2]: v for k, v in rows_of(done).items()}
    assert got["languages"] == ["English"]
    assert got["size"] == ["twelve thousand rows"]
    assert got["format"] == ["Not specified"]
    # proven, analytical and overridden fields are not flagged
    assert [r["field"] for r in flags.collect()] == ["data.source"]
    assert [r["path"] for r in missing.collect()] == ["data.format"]
    assert info.first()["llm"] == "m"


def test_sub_benchmarks_inherit(spark):
    parents = spark.createDataFrame([("p", "benchmark_details", "name", ["arc_agi"], False), ("p", "benchmark_details", "overview", ["Parent's."], False), ("p", "ethical_and_legal_considerations", "data_licensing", ["MIT"], False)], CARD)
    subs = spark.createDataFrame([("s1", "arc_agi_v2_public_eval", "p", ["arc_agi"], None), ("s2", "arc_agi_v1", "p", [], "One. Two. Three.")], "card_id string, name string, parent_id string, appears_in array<string>, description string")
    specific = spark.createDataFrame([("s1", "data", "size", ["9"]), ("s1", "ethical_and_legal_considerations", "data_licensing", ["own"])], "card_id string, section string, field string, value array<string>")
    got = rows_of(P.sub_cards(parents, subs, specific))
    assert got["s1", "data", "size"] == ["9"]
    assert got["s1", "ethical_and_legal_considerations", "data_licensing"] == ["MIT"]
    assert got["s1", "benchmark_details", "overview"] == ["Parent's."]
    assert got["s2", "benchmark_details", "overview"] == ['One. Two.\n\nThis is the "v1" sub-component of arc_agi. Parent\'s.']
    assert got["s2", "benchmark_details", "name"] == ["arc_agi_v1"]
    assert got["s1", "benchmark_details", "appears_in"] == ["arc_agi"]
    asked = spark.createDataFrame([("s", "arc_agi_v2", "arc_agi", "intro\n\nnone\n\nabout v2 here", "readme")], "card_id string, name string, parent string, paper string, readme string")
    read = lambda d: d.withColumn("facts", F.when(F.col("tier") == 0, F.lit("no specific information found.")).otherwise(F.col("text")))
    assert P.sub_facts(asked, read).first()["facts"] == "readme"


def test_stages_log_what_they_do(spark):
    states = spark.createDataFrame([("a", True), ("b", True), ("c", False)], "item string, go boolean").withColumn("log", F.array().cast("array<string>"))
    made = lambda d: d.select("item", F.when(F.col("item") == "a", "card").alias("card"), F.lit("boom").alias("error"))
    got = {r["item"]: (r["card"], r["log"]) for r in P.stage(states, "compose", made, "card", F.col("go")).collect()}
    assert got == {"a": ("card", ["compose done"]), "b": (None, ["compose failed: boom"]), "c": (None, [])}


def test_baseline_fills_what_is_missing(spark):
    card = spark.createDataFrame([("c", "methodology", "baseline_results", ["Not specified"], False), ("d", "methodology", "baseline_results", ["known"], False)], CARD)
    said = spark.createDataFrame([("c", "s"), ("d", "s")], "card_id string, sentence string")
    assert {k[0]: v for k, v in rows_of(P.baseline(card, said)).items()} == {"c": ["s"], "d": ["known"]}


def test_risks_none_and_failed_leave_the_card(spark):
    card = spark.createDataFrame([(c, "data", "size", ["1"], False) for c in "abc"], CARD)
    kind = "array<struct<id:string,category:string,description:string,url:string>>"
    found = spark.createDataFrame([("a", [("r", "Cat", "d", "")]), ("b", []), ("c", None)], f"card_id string, risks {kind}")
    got = rows_of(P.with_risks(card, found))
    assert set(got) == {("a", "data", "size"), ("b", "data", "size"), ("c", "data", "size"), ("a", "possible_risks", "risks")}
    assert json.loads(got["a", "possible_risks", "risks"][0]) == {"category": "Cat", "description": "d"}


def test_suspect_terms(spark):
    note = lambda line: one(spark, checks.suspect_note(F.lit(line), F.lit("source"), F.lit("Name"), F.array().cast("array<string>")))
    assert note("- by Upwork") == "[SUSPECT: 'Upwork' not found in source]"
    assert note("- by Gpt4-like") == "[SUSPECT: 'Gpt4-like' not found in source]"
    assert note("- by GPTx") is None
    assert note("- by Upwork and Crowdflower") == "[SUSPECT: terms 'Upwork, Crowdflower' not found in source]"
    assert one(spark, checks.topics(F.lit('X: "n" is about: Math, two words. Only extract'))) == ["math", "two words"]


def test_long_values_are_kept_whole(spark):
    from assay.functions import names, tags, text
    from assay.operators import cards
    from assay.providers import risks

    long = "x" * 12_000
    assert len(one(spark, names.title_case(F.lit(long)))) == 12_000
    assert len(one(spark, text.arxiv_url(F.array(F.lit("arxiv:" + long)), F.lit("")))) == 12_000 + len("https://arxiv.org/abs/")
    row = spark.createDataFrame([(1, ["task_ids:" + long])], "k int, tags array<string>")
    assert len(tags.tag_fields(row, "k").first()["tasks"][0]) == 12_000
    valid = spark.range(10_050).select(F.concat(F.lit("part.f"), "id").alias("field"))
    said = spark.createDataFrame([(1, "- it says so [part.f10049]")], "k int, text string")
    assert cards.statements(said, "k", valid).first()["field"] == "part.f10049"
    table = spark.range(10_050).select(F.format_string("r%05d", "id").alias("id"), F.lit("n").alias("name"), F.lit("d").alias("description"), F.lit("u").alias("url"), F.array(F.concat(F.lit("w"), "id", F.lit("."))).alias("words"))
    assert [r["id"] for r in risks(spark.createDataFrame([("c", "a w10049. b")], "card_id string, text string"), table).first()["risks"]] == ["r10049"]


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from assay import storage

    bare = SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=SimpleNamespace(getCheckpointDir=lambda: None, master="yarn"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        storage.shared_dir(bare)


def test_a_table_survives_a_crash_between_versions(spark, tmp_path):
    path = str(tmp_path / "t")
    step = incremental.upsert(path, "k", "v")
    step(spark.createDataFrame([("a", 1), ("a", 3), ("a", 2)], "k string, v int"), 0)
    assert [tuple(r) for r in spark.read.parquet(path).collect()] == [("a", 3)]
    (tmp_path / "t").rename(tmp_path / "t.old")
    incremental.recover(spark, path)
    assert spark.read.parquet(path).count() == 1
    spark.createDataFrame([("b", 1)], "k string, v int").write.parquet(path + ".new")
    (tmp_path / "t").rename(tmp_path / "t.old")
    incremental.recover(spark, path)
    assert [r["k"] for r in spark.read.parquet(path).collect()] == ["b"]


def test_retries_and_paths(spark, tmp_path):
    waits, calls = [], iter([1, 2])

    def call():
        if next(calls, None):
            raise OSError("busy")
        return "done"

    assert operations.retried(call, wait=waits.append) == "done"
    assert waits == [5.0, 10.0]
    with pytest.raises(ZeroDivisionError):
        operations.retried(lambda: 1 / 0, attempts=2, wait=waits.append)
    assert operations.qualified(spark, str(tmp_path)).startswith("file:")
    with pytest.raises(FileNotFoundError):
        operations.qualified(spark, str(tmp_path / "none"))


def test_result_files(spark, tmp_path):
    body = {"benchmark": "b", "results": [{"statement": {"text": "t", "field": "data.size"}, "retrieved_chunks": [{"content": "language:en x"}, {"content": "y"}]}]}
    (tmp_path / "a.json").write_text(json.dumps(body, indent=1))
    (tmp_path / "b.jsonl").write_text(json.dumps(body | {"benchmark": "first"}) + "\n" + json.dumps(body | {"benchmark": "second"}))
    atoms, contexts = evidence.from_results(files.retrieval_results(spark, str(tmp_path)))
    assert {r["topic"] for r in atoms.collect()} == {"b", "first"}
    assert {(r["context_id"], r["text"]) for r in contexts.collect()} == {("c_a0_0", "language: English x"), ("c_a0_1", "y")}
    scored = spark.createDataFrame([("c", "a0", "data.size", 0.9), ("c", "a1", "data.size", None)], "card_id string, atom_id string, field string, p_true double")
    out = json.loads(evidence.factuality_results(scored).first()["results"])
    assert [a["label"] for a in out["atoms"]] == ["NO_SCORE", "HIGH_CONFIDENCE_CORRECT"]
    assert out["field_analysis"][0]["total_atoms"] == 1


def test_pages_and_papers(spark):
    html = "<html><head><title>T</title></head><body><nav>menu</nav><p>Hello &amp; <b>bye</b></p><table><tr><td>a</td><td>b</td></tr></table><script>x</script></body></html>"
    assert one(spark, pages.main_text(F.lit(html))) == "Hello & bye\na | b"
    assert one(spark, papers.pdf_url(F.lit("https://arxiv.org/abs/1.2"))) == "https://arxiv.org/pdf/1.2.pdf"
    rows = spark.createDataFrame([("1", "https://arxiv.org/abs/1.2"), ("2", "https://arxiv.org/abs/1.2"), ("3", None)], "id string, url string")
    made = papers.converted(rows, lambda d: d.withColumn("markdown", F.lit("## Title\nText [1].")))
    assert {r["id"]: (r["title"], r["text"]) for r in made.collect()} == {"1": ("Title", "## Title\nText ."), "2": ("Title", "## Title\nText ."), "3": (None, None)}
    found = spark.createDataFrame([("k", "ARC easy", "physics of light", 0), ("k", "Something else", "about", 1), ("k", "The arc of light", "maths", 2)], "key string, title string, abstract string, place int")
    names = spark.createDataFrame([("k", "arc", None, "reasoning maths")], "key string, name string, references array<string>, domain string")
    got = {r["title"]: r["similarity"] for r in papers.prefiltered(found, names).collect()}
    assert got == {"ARC easy": 100.0, "The arc of light": 100.0}
    entries = spark.createDataFrame([("cards.x", "{}"), ("benchmarks.x", "{}"), ("cards.y", "{}")], "ref_id string, json string")
    wanted = spark.createDataFrame([("x",), ("y",), ("z",)], "name string")
    assert {r["name"]: r["ref_id"] for r in files.in_catalog(entries, wanted).collect()} == {"x": "benchmarks.x", "y": "cards.y"}
    assert artifacts.as_text({"a_b": True, "c": None, "d": {"e": 1.5, "f": ["x", 2]}}) == "A B: True\nE: 1.5\nx\n2"


def test_fact_lines_are_found_within_their_row(spark):
    """No shuffle for lines with copies of their text; headings hold up to the next one, also in rows that are alike."""
    texts = ["- loose: x\n## Data\n- size: 3\nno line\n-  format : csv\n**Other**\n- size: 9\n  ## ethical and_legal considerations \n- privacy: No Information Found\n## data\n- size: 4\n##\n- source: s", "**methodology**\n- metrics: a, b\n- metrics: c", "## data\n## methodology\n- methods: m", "none", "", None]
    rows = spark.createDataFrame([(1, t) for t in texts], "card_id int, facts string")
    found = P.fact_lines(rows)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    got = sorted((r.section, r.field, r.value, r.missing) for r in found.collect())
    assert got == sorted([("data", "size", "3", False), ("data", "format", "csv", False), ("ethical_and_legal_considerations", "privacy", "No Information Found", True), ("data", "size", "4", False), ("data", "source", "s", False), ("methodology", "metrics", "a, b", False), ("methodology", "metrics", "c", False), ("methodology", "methods", "m", False)])


def test_papers_meet_their_searches_whole(spark):
    """Chunks and their vectors are made after the only shuffle that texts are in."""
    facts = spark.createDataFrame([(i, "PAPER", "data", "source", None, True) for i in range(3)], "card_id int, source string, section string, field string, value string, missing boolean")
    papers = spark.createDataFrame([(i, "filler\n\n" * 300 + f"- source: collected in {i}") for i in range(3)], "card_id int, text string")
    filled = P.fill_gaps(facts, papers, top=40, most=90_000)
    plan = filled._jdf.queryExecution().optimizedPlan().toString()
    lines = [line for line in plan.split("\n") if "Join" in line or "posexplode(" in line]
    # deeper lines stand below: the texts' join is the last one
    assert lines.index(next(x for x in lines if "posexplode(" in x)) < len(lines) - 1 and "Join" in lines[-1]
    assert sorted((r.card_id, r.value, r.missing) for r in filled.collect()) == [(i, f"collected in {i}", False) for i in range(3)]
