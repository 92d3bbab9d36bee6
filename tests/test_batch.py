"""A folder of sources becomes card files in one call; failures, tries, restarts and later batches."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from assay.plans import batch, routing

PAPER = "## benchmark_details\n- overview: A test of sums\n- domains: arithmetic\n## data\n- size: 100 rows\n- source: No information found\n## methodology\n- metrics: accuracy, f1\n\nThe data collection source origin corpus created gathered compiled.\n- source: school books\n\nReferences\n[1] A. Author.\n"
PAGE = "<html><body><article><p>## data</p><p>- format: csv files with one sum in each line</p><p>" + "words " * 30 + "</p></article></body></html>"


def lines(path, rows):
    path.write_text("".join(json.dumps(r) + "\n" for r in rows))


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    top = tmp_path_factory.mktemp("sources")
    for d in ("catalog/cards", "hub/org"):
        (top / d).mkdir(parents=True)
    lines(top / "items.jsonl", [{"item": "sums", "is_scored": False}, {"item": "scored", "is_scored": True, "repo": "org/data", "web_url": "http://page"}, {"item": "gone"}, {"item": "suite", "is_composite": True, "paper_url": "https://arxiv.org/abs/1", "contains": ["sums"], "canonical_id": "The/Suite"}, {"item": "sums"}])
    (top / "catalog/cards/sums.json").write_text(json.dumps({"loader": {"path": "org/data"}, "__tags__": {"arxiv": "1"}}))
    (top / "hub/org/data.json").write_text(json.dumps({"id": "org/data", "tags": ["language:en", "arxiv:2", "license:mit", "size_categories:n<1K"], "readme_markdown": "## benchmark_details\n- overview: The page\n- tasks: adding\n" + "." * 100}))
    lines(top / "papers.jsonl", [{"url": "https://arxiv.org/abs/1", "text": PAPER}, {"url": "https://arxiv.org/abs/2", "text": PAPER.replace("sums", "other things")}])
    lines(top / "pages.jsonl", [{"url": "http://page", "html": PAGE}])
    return top


@pytest.fixture(scope="module")
def ran(spark, root, tmp_path_factory):
    out = tmp_path_factory.mktemp("out")
    sources = batch.from_folder(spark, f"file://{root}")
    sources.risks = spark.createDataFrame([("r1", "Adding wrong", "d", "u", ["sums"])], "id string, name string, description string, url string, words array<string>")
    rows = batch.run(spark, sources, f"file://{out}", created=F.lit("2024-01-01")).collect()
    return out, sources, {r.item: (r.key, r.card and json.loads(r.card), r.log) for r in rows}


def test_every_item_reaches_its_end(spark, ran):
    out, _, rows = ran
    assert set(rows) == {"sums", "scored", "gone", "suite"}
    assert rows["gone"][1] is None and rows["gone"][2][-1].endswith("failed: no evidence")
    assert [m for m in rows["gone"][2] if m.startswith("compose")] == ["compose again: no source says anything"] * 2 + ["compose failed: no source says anything"]
    last = max(int(p.name.split("=")[1]) for p in (out / "state").iterdir() if p.is_dir())
    assert {r.next for r in routing.routed(spark.read.parquet(f"file://{out}/state/round={last}")).collect()} == {"END"}
    assert rows["sums"][2][:4] == ["catalog done", "ids done", "hub done", "text done"]
    assert "hub_ids done" in rows["scored"][2] and "resolver done" not in rows["scored"][2]


def test_cards_hold_what_the_sources_say(ran):
    card = ran[2]["sums"][1]
    assert card["benchmark_details"]["overview"] == "A test of sums" and card["benchmark_details"]["languages"] == ["English"]
    assert card["data"]["source"] == "school books" and card["data"]["size"] == "n<1K"
    assert card["methodology"]["metrics"] == ["accuracy", "f1"] and card["card_info"] == {"created_at": "2024-01-01", "llm": "none"}
    assert json.loads(card["possible_risks"]["risks"][0])["category"] == "Adding wrong"
    scored = ran[2]["scored"][1]
    assert scored["benchmark_details"]["overview"] == "A test of other things" and scored["data"]["format"].startswith("csv files")
    suite = ran[2]["suite"][1]
    assert suite["benchmark_details"]["benchmark_type"] == "composite" and suite["benchmark_details"]["contains"] == ["sums"]
    assert "flagged_fields" not in suite


def test_files_one_a_key_with_failures_and_statistics(spark, ran):
    out, _, rows = ran
    assert sorted(p.name for p in (out / "card").glob("key=*")) == ["key=The%2FSuite", "key=scored", "key=sums"]
    assert all(len([f for f in p.iterdir() if f.name.startswith("part-")]) == 1 for p in (out / "card").glob("key=*"))
    assert {r.key: json.loads(r.card) for r in batch.cards_at(spark, f"file://{out}/card").collect()} == {k: c for k, c, _ in rows.values() if c}
    assert [(r.item, r.reason) for r in spark.read.json(f"file://{out}/failures").collect()] == [("gone", "factuality failed: no evidence")]
    assert spark.read.json(f"file://{out}/statistics").first().asDict() == {"items": 4, "cards": 3, "failures": 1, "success_rate": 75.0}
    one = spark.createDataFrame([("sums", '{"new": 1}'), (None, "x"), ("other", None)], "key string, card string")
    batch.put_cards(one, f"file://{out}/copy")
    batch.put_cards(spark.createDataFrame([("b", "2")], "key string, card string"), f"file://{out}/copy")
    batch.put_cards(spark.createDataFrame([("b", "3")], "key string, card string"), f"file://{out}/copy")
    assert {(r.key, r.card) for r in batch.cards_at(spark, f"file://{out}/copy").collect()} == {("sums", '{"new": 1}'), ("b", "3")}


def test_a_restart_goes_on_after_the_last_round_and_a_failing_step_is_tried_again(spark, root, tmp_path):
    calls = []

    def unsure(b, items):
        calls.append(sorted(r.item for r in items.collect()))
        if len(calls) == 2:
            raise RuntimeError("the driver goes away")
        rows = batch.text_step(b, items)
        return rows if len(calls) > 2 else rows.withColumn("error", F.lit("not now"))

    sources, path = batch.from_folder(spark, f"file://{root}"), f"file://{tmp_path}/s"
    sources.items = sources.items.where("item = 'suite'")
    with pytest.raises(RuntimeError):
        batch.run(spark, sources, path, {"text": unsure})
    log = batch.run(spark, sources, path, {"text": unsure}).first().log
    assert len(calls) == 3 and log.count("text again: not now") == 1 and "text done" in log


def test_no_items(spark, root, tmp_path):
    sources = batch.from_folder(spark, f"file://{root}")
    sources.items = sources.items.limit(0)
    assert batch.run(spark, sources, f"file://{tmp_path}/s").count() == 0
