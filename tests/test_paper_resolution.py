"""Staged resolution of papers: order of tiers, kept answers, failed searches; requests to services with recorded answers."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from assay.functions.fuzzy import partial_similarity, similarity
from assay.plans.paper_resolution import kept_answers, resolve
from assay.sources.service import Service, fetched, reachable, search

NAMES = "id long, name string, full_name string, domain string, paper_url string, tags array<string>, readme string, url string"
ROWS = [
    (1, "MMLU", None, None, "https://given.example", ["arxiv:1111.11111"], None, "old"),
    (2, "mmlu", None, None, "", ["arxiv:2222.22222"], None, None),
    (3, "mmlu", None, None, None, None, "see https://arxiv.org/abs/3333.33333", None),
    (4, " MMLU ", None, None, None, None, None, None),
    (5, "made_up_suite", "Made Up Suite", None, None, None, None, None),
    (6, "Made Up-Suite", "Made Up Suite", None, None, None, None, None),
    (7, "nothing here", None, None, None, None, None, None),
    (8, "down now", None, None, None, None, None, None),
    (9, None, None, None, None, None, None, None),
    (10, "  ", None, None, None, [], "", None),
]


class Services:
    """Two recorded services; what they were asked for is counted through an accumulator."""

    def __init__(self, spark):
        self.asked = spark.sparkContext.accumulator(0)

    def search(self):
        asked = self.asked

        def get(address: str, method: str) -> tuple[int, str, str]:
            asked.add(1)
            if "down" in address:
                return 503, "", ""
            if "openalex" in address:
                works = [{"title": "Made Up Suite: a benchmark", "publication_year": 2021, "ids": {"doi": "https://doi.org/10.1/x"}, "abstract_inverted_index": {"up": [1], "Made": [0]}}, {"title": "zzzz qqqq", "ids": {}}]
                return 200, "application/json", json.dumps({"results": works if "Made" in address else []})
            return 200, "application/json", json.dumps({"data": [{"title": " made up suite: A BENCHMARK", "externalIds": {"ArXiv": "9"}}] if "Made" in address else []})

        service = Service(get=get, per_second=None, lanes=2, tries=2, pause=0.0)
        return search({"openalex": service, "semantic_scholar": service})


def judge(batch):
    return batch.groupBy("key").agg(F.min("idx").alias("match_index")).select("key", "match_index", F.lit(0.7).alias("confidence"), F.lit("first").alias("reasoning"))


def test_tiers_and_kept_answers(spark, tmp_path):
    kept, services = f"file://{tmp_path}/kept", Services(spark)
    rows = spark.createDataFrame(ROWS, NAMES)
    done = resolve(rows, services.search(), judge, kept)
    got = {r.id: (r.url, r.resolved_from) for r in done.rows.collect()}
    made = ("https://doi.org/10.1/x", "openalex+batch_verification")
    assert got == {
        1: ("https://given.example", "given"), 2: ("https://arxiv.org/abs/2222.22222", "readme"), 3: ("https://arxiv.org/abs/3333.33333", "readme"),
        4: ("https://arxiv.org/abs/2009.03300", "known"), 5: made, 6: made, 7: (None, None), 8: (None, None), 9: (None, None), 10: (None, None),
    }
    row = done.rows.where("id = 5").first()
    assert (row.title, row.abstract, row.year, row.full_name) == ("Made Up Suite: a benchmark", "Made up", 2021, "Made Up Suite")
    (log,) = [json.loads(r.log) for r in done.log.collect()]
    assert log["suite"] == "made_up_suite" and log["resolved_from"] == made[1]
    assert [c["title"] for c in log["candidates"]] == ["Made Up Suite: a benchmark"]
    # a key without a paper is kept, one whose searches failed is not
    assert {r.key: r.url for r in kept_answers(spark, kept).collect()} == {"made_up_suite": made[0], "nothing_here": None}
    assert services.asked.value > 0
    done.release()

    again = Services(spark)
    second = resolve(rows.where("id <> 8"), again.search(), judge, kept)
    assert {r.id: (r.url, r.resolved_from) for r in second.rows.collect()} == {i: v for i, v in got.items() if i != 8}
    assert again.asked.value == 0
    stale = Services(spark)
    resolve(rows.where("id = 7"), stale.search(), judge, kept, stale=F.col("url").isNull())
    assert stale.asked.value > 0


def test_unsure_verdicts_and_no_rows(spark):
    rows = spark.createDataFrame(ROWS, NAMES)
    unsure = lambda batch: judge(batch).withColumn("confidence", F.lit(0.69))
    assert resolve(rows.where("id = 5"), Services(spark).search(), unsure).rows.first().url is None
    assert resolve(rows.where("id > 99"), Services(spark).search(), judge).rows.count() == 0
    assert resolve(rows.select("name").where("id IN (4, 9)"), Services(spark).search(), judge).rows.where("resolved_from = 'known'").count() == 1


def test_requests(spark):
    def get(address: str, method: str) -> tuple[int, str, str]:
        if "boom" in address:
            raise OSError("no route")
        return {"ok": (200, "text/plain", "fine"), "gone": (404, "", ""), "busy": (503, "", ""), "barred": (403, "", ""), "page": (200, "text/html; x", "")}[address]

    service = Service(get=get, per_second=None, lanes=3, tries=2, pause=0.0)
    rows = spark.createDataFrame([(a,) for a in ("ok", "gone", "busy", "boom", "", None)], "address string").withColumn("error", F.lit("old"))
    got = {r.address: (r.status, r.body, r.error, r.tries) for r in fetched(rows, service).collect()}
    assert got == {"ok": (200, "fine", None, 1), "gone": (404, "", "status 404", 1), "busy": (None, None, "status 503", 2), "boom": (None, None, "OSError: no route", 2), "": (None, None, "no address", 0), None: (None, None, "no address", 0)}
    urls = spark.createDataFrame([("ok",), ("barred",), ("page",), ("boom",), (None,)], "url string")
    assert {r.url: r.accessible for r in reachable(urls, service).collect()} == {"ok": True, "barred": False, "page": False, "boom": True, None: None}


def test_rate(spark):
    import time

    service = Service(get=lambda a, m: (200, "", str(time.monotonic())), per_second=20, lanes=2)
    rows = spark.range(12).select(F.col("id").cast("string").alias("address"))
    at = sorted(float(r.body) for r in fetched(rows, service).collect())
    assert at[-1] - at[0] >= 0.5 * 10 / 20


@pytest.mark.parametrize("a, b", [("kitten", "sitting on it"), ("abc", "xxabcxx"), ("ab", "ba"), ("mmlu", "MMLU pro"), ("aaaa", "aabaaab"), ("ééa", "aéé"), ("long benchmark name", "name of a long long benchmark"), ("q", "zz"), ("", "a")])
def test_partial_similarity_bounds_lose_nothing(a, b):
    def plain(a, b):
        if not a or not b:
            return 0.0
        a, b = sorted((a, b), key=len)
        return max(similarity(a, b[max(0, i) : i + len(a)]) for i in range(1 - len(a), len(b)))

    assert partial_similarity(a, b) == plain(a, b)
