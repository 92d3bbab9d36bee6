"""Plans of the tables that a stage writes: each scan, shuffle and broadcast of a plan takes memory of the driver, many at once."""

from __future__ import annotations

import random

import pytest

from assay.llm import components, hyperminhash, mixing, storage

MOST = 16


@pytest.mark.parametrize("stage", [hyperminhash.near_duplicates, mixing.mix])
def test_no_plan_starts_many_exchanges_at_once(spark, monkeypatch, stage):
    plans: dict[str, int] = {}

    def watched(df, name):
        plan = df._jdf.queryExecution().executedPlan().toString()
        plans[name] = max(plans.get(name, 0), plan.count("Exchange "))
        return storage.materialise(df, name)

    for module in (components, hyperminhash, mixing):
        monkeypatch.setattr(module, "materialise", watched)
    rng = random.Random(4)
    base = [f"w{rng.randint(0, 500)}" for _ in range(60)]
    rows = [(d, " ".join(f"x{rng.randint(0, 500)}" if rng.random() < d / 200 else w for w in base[: rng.randint(40, 60)]), f"s{d % 4}") for d in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    assert stage(docs).count() == len(rows)
    assert plans
    assert {k: n for k, n in plans.items() if n > MOST} == {}
