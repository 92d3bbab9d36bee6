"""A batch of benchmarks from sources to card files, in one call.

Every item has a row of state: addresses, what it has, a log. A round routes all items, runs each step on the items whose turn
it is, all of them in one job, and writes what it made and the new states; it ends when every item is at END. A step that gives
an item nothing, or an error, has failed for it; it is tried TRIES times, and then the item goes on without. So rounds are at
most the sum of all tries, whatever the number of items.

Below the batch's folder, laid out as a session:

* state/round=<n>: the states. A driver that is started again goes on after the last complete round.
* tool_output/<step>/round=<n>: what a step made, with `item` and `error`.
* card/key=<key>: the finished cards, one folder and file a key; a later batch into the same folder replaces its own keys only.
* failures, statistics: JSON lines, written last.

The driver sees the names of steps and counts of items, never rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from ..functions import artifacts, tags
from ..functions.names import output_key
from ..functions.text import arxiv_url, strip_references
from ..operators import cards as C
from ..operators import factuality, reports, retrieval
from ..providers import REGISTRY, risks
from ..sources import files, hub, pages, papers
from ..storage import materialise, release
from . import composition as P
from .routing import STATE, routed

#: How often a step is tried for an item.
TRIES = {"compose": 3, "hub": 2, "text": 2, "html": 2}
FLAGS = {"catalog": "has_catalog", "ids": "has_ids", "hub": "has_hub", "text": "has_text", "html": "has_html", "compose": "has_card", "risk": "has_risk", "evidence": "has_evidence", "factuality": "has_factuality"}
TRIED = {"hub_ids": "hub_ids_tried", "resolver": "resolver_tried"}
ADDRESSES = ("repo", "paper_url", "web_url")
CONTEXTS = 3
Step = Callable[["Batch", DataFrame], DataFrame]


@dataclass
class Sources:
    """items (item, is_scored, is_composite[, repo, paper_url, web_url, contains, appears_in, canonical_id]); catalog (ref_id, json);
    hub (repo, json); papers (url, text); pages (url, html); sentences (card_id, sentence) on scores; risks (id, name, …, words)."""

    items: DataFrame
    catalog: DataFrame | None = None
    hub: DataFrame | None = None
    papers: DataFrame | None = None
    pages: DataFrame | None = None
    sentences: DataFrame | None = None
    risks: DataFrame | None = None


@dataclass
class Batch:
    spark: SparkSession
    path: str
    sources: Sources
    steps: dict[str, Step] = field(default_factory=dict)
    extract: Callable[[DataFrame], DataFrame] = P.listed

    def made(self, step: str) -> DataFrame | None:
        """What a step made for the items for which it did not fail; None if it never ran."""
        try:
            return self.spark.read.parquet(f"{self.path}/tool_output/{step}").where("error IS NULL").drop("error", "round")
        except AnalysisException:
            return None

    def with_made(self, items: DataFrame, step: str, **columns: str) -> DataFrame:
        """items with columns of what a step made, null where it made nothing."""
        found = self.made(step)
        if found is None:
            return items.withColumns({new: F.lit(None).cast(kind) for new, (_, kind) in ((n, c.split(":")) for n, c in columns.items())})
        return items.join(found.select("item", *[F.col(c.split(":")[0]).alias(new) for new, c in columns.items()]), "item", "left")


# ---------------------------------------------------------------- steps: (batch, items whose turn it is) to (item, …, error)


def said(missing: Column, what: str) -> Column:
    return F.when(missing, F.lit(what)).alias("error")


def _looked_up(items: DataFrame, table: DataFrame | None, key: str, name: str, value: str, error: str) -> DataFrame:
    """(item, value, error) of a table by its column `name`."""
    if table is None:
        return items.select("item", F.lit(None).cast("string").alias(value), F.lit(error).alias("error"))
    found = table.groupBy(F.col(name).alias("_k")).agg(F.first(value, True).alias(value))
    return items.join(found, F.col(key) == F.col("_k"), "left").select("item", value, said(F.col(value).isNull(), error))


def catalog_step(b: Batch, items: DataFrame) -> DataFrame:
    found = None if b.sources.catalog is None else files.in_catalog(b.sources.catalog, items.select("item"), "item").select("name", F.concat(F.lit('{"root": '), "json", F.lit("}")).alias("json"))
    return _looked_up(items, found, "item", "name", "json", "not in the catalog")


def ids_step(b: Batch, items: DataFrame) -> DataFrame:
    rows = b.with_made(items, "catalog", _j="json:string")
    repo, paper = F.get(artifacts.hub_repositories("_j"), F.lit(0)), artifacts.paper_of("_j")
    return rows.select("item", F.coalesce("repo", repo).alias("repo"), F.coalesce("paper_url", paper).alias("paper_url"), said(F.col("_j").isNull(), "no catalog entry"))


def hub_step(b: Batch, items: DataFrame) -> DataFrame:
    none = items.select("item", F.lit(None).cast("string").alias("readme"), F.lit(None).cast("array<string>").alias("tags"), F.lit("no metadata").alias("error"))
    if b.sources.hub is None:
        return none
    known = hub.metadata(b.sources.hub.select(F.col("repo").alias("_k"), "json"))
    found = known.groupBy("_k").agg(F.first("readme_markdown", True).alias("readme"), F.first("tags", True).alias("tags"), F.first("error", True).alias("_e"))
    missing = F.col("_k").isNull() | F.col("_e").isNotNull()
    return items.join(found, F.col("repo") == F.col("_k"), "left").select("item", "readme", "tags", F.when(missing, F.coalesce("_e", F.lit("no metadata"))).alias("error"))


def hub_ids_step(b: Batch, items: DataFrame) -> DataFrame:
    rows = b.with_made(items, "hub", _t="tags:array<string>", _r="readme:string")
    url = F.nullif(arxiv_url(F.coalesce("_t", F.array().cast("array<string>")), F.coalesce("_r", F.lit(""))), F.lit(""))
    return rows.select("item", url.alias("paper_url"), F.lit(None).cast("string").alias("error"))


def resolver_step(b: Batch, items: DataFrame) -> DataFrame:
    rows = papers.with_known(items, "item")
    return rows.select("item", F.col("known_paper").alias("paper_url"), said(F.col("known_paper").isNull(), "no paper found"))


def text_step(b: Batch, items: DataFrame) -> DataFrame:
    rows = _looked_up(items, b.sources.papers, "paper_url", "url", "text", "no text of the paper")
    return rows.withColumn("text", strip_references("text"))


def html_step(b: Batch, items: DataFrame) -> DataFrame:
    found = None if b.sources.pages is None else pages.content(b.sources.pages.select("url", "html"), ["url"]).where("success")
    return _looked_up(items, found, "web_url", "url", "text", "no text of the page")


def card_sources(b: Batch, items: DataFrame) -> DataFrame:
    rows = b.with_made(b.with_made(b.with_made(items, "text", paper="text:string"), "html", html="text:string"), "hub", readme="readme:string", tags="tags:array<string>")
    return rows.select(F.col("item").alias("card_id"), F.col("item").alias("name"), F.lit("").alias("anchor"), "paper", "html", "readme", "tags")


def compose_step(b: Batch, items: DataFrame) -> DataFrame:
    """Long cards; each field comes with its provenance. Items without any text fail."""
    sources, path = materialise(card_sources(b, items), "batch-sources")
    facts = P.tag_facts(tags.first_tag_facts(sources.where("tags IS NOT NULL"), "card_id"))
    values = tags.tag_fields(sources.where("tags IS NOT NULL"), "card_id").where("languages IS NOT NULL")
    values = values.select("card_id", F.lit("benchmark_details").alias("section"), F.lit("languages").alias("field"), F.col("languages").alias("value"))
    card, proof = P.compose(sources.drop("tags"), facts, values, extract=b.extract)
    known = F.coalesce("paper", "html", "readme").isNotNull()
    rows = card.join(proof, ["card_id", "section", "field"], "left").join(sources.where(known).select("card_id"), "card_id", "left_semi")
    good = rows.select(F.col("card_id").alias("item"), "section", "field", "value", "is_list", "source", "evidence", F.lit(None).cast("string").alias("error"))
    bad = sources.where(~known).select(F.col("card_id").alias("item"), *[F.lit(None).cast(k).alias(c) for c, k in dict(good.dtypes).items() if c not in ("item", "error")], F.lit("no source says anything").alias("error"))
    return good.unionByName(bad)


def card_of(b: Batch, items: DataFrame | None = None) -> DataFrame:
    """(card_id, section, field, value, is_list) of the composed cards."""
    made = b.made("compose")
    made = made if items is None else made.join(items.select("item"), "item", "left_semi")
    return made.select(F.col("item").alias("card_id"), "section", "field", "value", "is_list")


def risk_step(b: Batch, items: DataFrame) -> DataFrame:
    empty = "array<struct<id:string,category:string,description:string,url:string>>"
    if b.sources.risks is None or b.made("compose") is None:
        return items.select("item", F.lit(None).cast(empty).alias("risks"), F.lit("no risk table").alias("error"))
    found = risks(P.use_case(card_of(b, items)), b.sources.risks).withColumnRenamed("card_id", "item")
    return items.select("item").join(found, "item", "left").select("item", F.col("risks").cast(empty).alias("risks"), F.lit(None).cast("string").alias("error"))


def evidence_step(b: Batch, items: DataFrame) -> DataFrame:
    """Statements of each card with the parts of its own sources that are nearest to them."""
    own = F.explode(F.array_compact(F.array("paper", "html", "readme")))
    texts, p_texts = materialise(P.paper_chunks(card_sources(b, items).select("card_id", own.alias("text"))).withColumn("chunk", F.xxhash64("text", "chunk")), "batch-chunks")
    atoms = P.atomised(card_of(b, items)) if b.made("compose") is not None else None
    if atoms is None:
        return items.select("item", F.lit(None).cast("int").alias("nth"), F.lit(None).cast("string").alias("field"), F.lit(None).cast("string").alias("text"), F.lit(None).cast("string").alias("context"), F.lit("no card").alias("error"))
    embed = REGISTRY["embed"]
    near = embed()(texts).select("card_id", "chunk", F.col("text").alias("_c"), "embedding").join(embed(out="_q")(atoms), "card_id").withColumn("_s", retrieval.cosine("embedding", "_q"))
    best = retrieval.ranked(near, ["card_id", "nth"], [F.desc("_s"), F.col("chunk")], CONTEXTS)
    joined = best.groupBy("card_id", "nth").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "_c"))), lambda s: s["_c"]), "\n").alias("context"))
    rows = atoms.join(joined, ["card_id", "nth"], "left")
    found = rows.select(F.col("card_id").alias("item"), "nth", "field", "text", "context")
    return items.select("item").join(found, "item", "left").select("*", said(F.col("text").isNull(), "no statements"))


def factuality_step(b: Batch, items: DataFrame) -> DataFrame:
    found = b.made("evidence")
    if found is None:
        return items.select("item", F.lit(None).cast("string").alias("field"), F.lit(None).cast("double").alias("p_true"), F.lit("no evidence").alias("error"))
    scored = REGISTRY["support"]()(found).select("item", "field", "p_true")
    return items.select("item").join(scored, "item", "left").select("*", said(F.col("field").isNull(), "no evidence"))


STEPS: dict[str, Step] = {"catalog": catalog_step, "ids": ids_step, "hub": hub_step, "hub_ids": hub_ids_step, "resolver": resolver_step, "text": text_step, "html": html_step, "compose": compose_step, "risk": risk_step, "evidence": evidence_step, "factuality": factuality_step}


# ---------------------------------------------------------------- rounds


def begin(items: DataFrame) -> DataFrame:
    """The first states."""
    given = set(items.columns)
    text = lambda c: (F.nullif(F.col(c), F.lit("")) if c in given else F.lit(None)).cast("string").alias(c)
    flag = lambda c: (F.coalesce(F.col(c), F.lit(False)) if c in given else F.lit(False)).alias(c)
    flags = [f.split()[0] for f in STATE.split(", ") if f.endswith(" boolean")]
    return items.dropDuplicates(["item"]).where("item IS NOT NULL").select("item", *[text(c) for c in ADDRESSES], *[flag(c) for c in flags], F.array().cast("array<string>").alias("log"))


def advance(states: DataFrame, outcomes: DataFrame) -> DataFrame:
    """States after a round, from outcomes (item, step, tries, error, ADDRESSES), one for each item that had its turn."""
    rows = states.join(outcomes.withColumnsRenamed({c: f"_{c}" for c in ADDRESSES}), "item", "left")
    ran, good = F.col("step").isNotNull(), F.col("step").isNotNull() & F.col("error").isNull()
    for name in ADDRESSES:
        rows = rows.withColumn(name, F.coalesce(name, F.when(good, F.col(f"_{name}"))))
    for step, flag in FLAGS.items():
        rows = rows.withColumn(flag, F.col(flag) | (good & F.coalesce(F.col("step") == step, F.lit(False))))
    for step, flag in TRIED.items():
        rows = rows.withColumn(flag, F.col(flag) | F.coalesce(F.col("step") == step, F.lit(False)))
    tried = F.size(F.filter("log", lambda m: m.startswith(F.concat("step", F.lit(" again"))))) + 1
    word = F.when(good, F.lit(" done")).when(tried < F.col("tries"), F.concat(F.lit(" again: "), "error")).otherwise(F.concat(F.lit(" failed: "), "error"))
    rows = rows.withColumn("log", F.when(ran, F.concat("log", F.array(F.concat("step", word)))).otherwise(F.col("log")))
    has = lambda c: F.col(c).isNotNull()
    return rows.withColumns({"has_repo": has("repo"), "has_paper": has("paper_url"), "has_web": has("web_url")}).select(*states.columns)


def _last_round(spark: SparkSession, path: str) -> int:
    try:
        return spark.read.parquet(f"{path}/state").agg(F.max("round")).first()[0]
    except AnalysisException:
        return -1


def run(spark: SparkSession, sources: Sources, path: str, steps: dict[str, Step] | None = None, extract: Callable[[DataFrame], DataFrame] = P.listed, model: str = "none", created: Column | None = None) -> DataFrame:
    """(item, key, card, log): the finished cards, and null for items without one. Files are below `path`, see above."""
    b = Batch(spark, path.rstrip("/"), sources, STEPS | (steps or {}), extract)
    n = _last_round(spark, b.path)
    if n < 0:
        n = 0
        begin(sources.items).write.mode("overwrite").parquet(f"{b.path}/state/round=0")
    while True:
        states = spark.read.parquet(f"{b.path}/state/round={n}")
        now, p_now = materialise(routed(states), "batch-turns")
        turns = {r.next: r["count"] for r in now.groupBy("next").count().collect()}
        live = [s for s in b.steps if turns.get(s)]
        if not live:
            release(spark, p_now)
            break
        outcomes = None
        for step in live:
            ready = now.where(F.col("next") == step).drop("next")
            at = f"{b.path}/tool_output/{step}/round={n}"
            b.steps[step](b, ready).write.mode("overwrite").parquet(at)
            made = spark.read.parquet(at)
            address = [F.first(c, True).alias(c) if c in made.columns else F.first(F.lit(None).cast("string")).alias(c) for c in ADDRESSES]
            result = made.groupBy("item").agg(F.max("error").alias("error"), *address)
            one = ready.select("item").join(result.withColumn("_r", F.lit(True)), "item", "left")
            one = one.select("item", F.lit(step).alias("step"), F.lit(TRIES.get(step, 1)).alias("tries"), F.when(F.col("_r").isNull(), "no result").otherwise(F.col("error")).alias("error"), *ADDRESSES)
            outcomes = one if outcomes is None else outcomes.unionByName(one)
        advance(states, outcomes).write.mode("overwrite").parquet(f"{b.path}/state/round={n + 1}")
        release(spark, p_now)
        n += 1
    return finish(b, spark.read.parquet(f"{b.path}/state/round={n}"), model, created)


def put_cards(rows: DataFrame, path: str, key: str = "key", card: str = "card") -> None:
    """Writes one file a key; the files of other keys stay as they are. Of rows with one key the last text stays."""
    one = rows.where(F.col(key).isNotNull() & F.col(card).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.max(card).alias("value"))
    one.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "none").partitionBy("key").text(path)


def cards_at(spark: SparkSession, path: str) -> DataFrame:
    """(key, card) of card files."""
    return spark.read.schema("value string, key string").text(path, wholetext=True).select("key", F.regexp_replace("value", r"\n\z", "").alias("card"))


def finish(b: Batch, states: DataFrame, model: str, created: Column | None) -> DataFrame:
    """Last steps of all cards, their files, failures and statistics."""
    items = b.sources.items
    given = set(items.columns)
    key = output_key(F.col("canonical_id") if "canonical_id" in given else F.lit(None).cast("string"), "item")
    keys = items.dropDuplicates(["item"]).where("item IS NOT NULL").select("item", key.alias("key"))
    if b.made("compose") is None:
        out = keys.join(states.select("item", "log"), "item").select("item", "key", F.lit(None).cast("string").alias("card"), "log")
    else:
        card = card_of(b)
        proof = b.made("compose").where("source IS NOT NULL").select(F.col("item").alias("card_id"), "section", "field", "source", "evidence")
        if b.sources.sentences is not None:
            card = P.baseline(card, b.sources.sentences)
        if "is_composite" in given:
            listing = lambda c: F.col(c) if c in given else F.lit(None).cast("array<string>").alias(c)
            card = P.with_membership(card, items.dropDuplicates(["item"]).join(states.where("has_card").select("item"), "item", "left_semi").select(F.col("item").alias("card_id"), F.when(F.col("is_composite"), "composite").otherwise("single").alias("benchmark_type"), listing("contains"), listing("appears_in")))
        found = b.made("risk")
        if found is not None:
            card = P.with_risks(card, found.select(F.col("item").alias("card_id"), "risks"))
        scored = b.made("factuality")
        fields = factuality.by_field(scored.select(F.col("item").alias("card_id"), "field", "p_true"), ["card_id", "field"]) if scored is not None else b.spark.createDataFrame([], "card_id string, field string, avg_probability double, all_neutral boolean")
        done, flags, missing, info = P.finalise(card, fields, proof, model=model, created=created)
        extra = [
            flags.select("card_id", F.lit("flagged_fields").alias("section"), "field", F.array("reason").alias("value"), F.lit(False).alias("is_list")),
            missing.groupBy("card_id").agg(F.sort_array(F.collect_set("path")).alias("value")).select("card_id", F.lit("missing_fields").alias("section"), F.lit("paths").alias("field"), "value", F.lit(True).alias("is_list")),
            info.select("card_id", F.lit("card_info").alias("section"), F.explode(F.create_map(F.lit("created_at"), F.col("created_at").cast("string"), F.lit("llm"), F.col("llm"))).alias("field", "_v")).select("card_id", "section", "field", F.array("_v").alias("value"), F.lit(False).alias("is_list")),
        ]
        for more in extra:
            done = done.unionByName(more.select(*done.columns))
        rows = P.card_rows(done)
        out = keys.join(states.select("item", "log"), "item").join(rows.withColumnRenamed("card_id", "item"), "item", "left").select("item", "key", "card", "log")
    out, _ = materialise(out, "batch-cards")
    put_cards(out, f"{b.path}/card")
    bad = out.where("card IS NULL").select("item", F.element_at(F.filter("log", lambda m: m.contains(" failed: ")), -1).alias("reason"))
    bad.write.mode("overwrite").json(f"{b.path}/failures")
    good = F.col("card").isNotNull()
    out.agg(F.count("*").alias("items"), F.count_if(good).alias("cards"), F.count_if(~good).alias("failures"), reports.success_rate(good, ~good).alias("success_rate")).write.mode("overwrite").json(f"{b.path}/statistics")
    return out


def from_folder(spark: SparkSession, root: str) -> Sources:
    """Sources of a folder: items.jsonl; catalog/…json; hub/<org>/<name>.json; papers.jsonl (url, text); pages.jsonl (url, html)."""
    rows = hub.landed(spark, f"{root}/hub")
    repo = F.regexp_replace(F.regexp_extract("path", r"([^/]+/[^/]+)\.json$", 1), "%20", " ")
    return Sources(
        spark.read.schema("item string, is_scored boolean, is_composite boolean, repo string, paper_url string, web_url string, contains array<string>, appears_in array<string>, canonical_id string").json(f"{root}/items.jsonl"),
        files.catalog(spark, f"{root}/catalog"),
        rows.select(repo.alias("repo"), "json"),
        spark.read.schema("url string, text string").json(f"{root}/papers.jsonl"),
        spark.read.schema("url string, html string").json(f"{root}/pages.jsonl"),
    )
