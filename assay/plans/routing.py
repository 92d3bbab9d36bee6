"""The next step of each item of a batch, as one expression over its state.

A state row has booleans for what is there and a log of messages; a step that failed is not taken again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

STATE = "item string, is_scored boolean, is_composite boolean, has_catalog boolean, has_ids boolean, has_repo boolean, has_hub boolean, has_paper boolean, hub_ids_tried boolean, resolver_tried boolean, has_text boolean, has_html boolean, has_web boolean, has_card boolean, has_risk boolean, has_evidence boolean, has_factuality boolean, log array<string>"


def failed(step: str) -> Column:
    return F.exists("log", lambda m: m.startswith(f"{step} failed"))


def next_step() -> Column:
    """The first step whose condition holds; "END" if none does."""
    c = lambda name: F.coalesce(F.col(name), F.lit(False))
    steps = [
        ("catalog", ~c("is_scored") & ~c("has_catalog") & ~failed("catalog")),
        ("ids", ~c("is_scored") & ~c("has_ids") & ~failed("ids")),
        ("hub", c("has_repo") & ~c("has_hub") & ~failed("hub")),
        ("hub_ids", ~c("has_paper") & c("has_hub") & ~c("hub_ids_tried")),
        ("resolver", ~c("has_paper") & ~c("resolver_tried") & ~failed("resolver")),
        ("text", c("has_paper") & ~c("has_text") & ~failed("text")),
        ("html", c("has_web") & ~c("has_html") & ~failed("html")),
        ("compose", ~c("has_card") & ~failed("compose")),
        ("risk", ~c("has_risk") & ~failed("risk")),
        ("END", c("is_composite")),
        ("evidence", ~c("has_evidence") & ~failed("evidence")),
        ("factuality", ~c("has_factuality") & ~failed("factuality")),
    ]
    out = F.when(F.lit(False), "")
    for name, condition in steps:
        out = out.when(condition, name)
    return out.otherwise("END")


def routed(states: DataFrame) -> DataFrame:
    return states.withColumn("next", next_step())


def appended(log: str, message: Column) -> Column:
    """The append reducer of the log."""
    return F.concat(F.coalesce(log, F.array().cast("array<string>")), F.array(message))
