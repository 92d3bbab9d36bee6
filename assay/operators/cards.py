"""Rules over cards in long form: (card_id, section, field, value ARRAY<STRING>, is_list)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.missing import NOT_SPECIFIED, SENTINELS, is_missing
from ..functions.names import strip

# The priority of sources, and fields that tags always override.
SOURCES = ("DETERMINISTIC", "PAPER", "HTML", "HF_README", "EEE")
ALWAYS = ("benchmark_details.languages", "ethical_and_legal_considerations.data_licensing")
# Fields that tags override after validation, too.
VALIDATED = ("benchmark_details.languages", "benchmark_details.data_type", "ethical_and_legal_considerations.data_licensing")
PROTECTED = "ethical_and_legal_considerations"


def path() -> Column:
    return F.concat_ws(".", "section", "field")


def empty(value: str | Column = "value", kind: str = "override") -> Column:
    """Whether a value is null, empty, or one stand-in."""
    v = F.col(value) if isinstance(value, str) else value
    return v.isNull() | (F.size(v) == 0) | ((F.size(v) == 1) & is_missing(F.get(v, F.lit(0)), kind))


def flatten(cards: DataFrame, key: str, sections: list[str]) -> DataFrame:
    """Cards with struct columns in long form."""
    parts = []
    for s in sections:
        for f in cards.schema[s].dataType.fields:
            is_list = f.dataType.typeName() == "array"
            value = F.col(f"{s}.{f.name}")
            parts.append(F.struct(F.lit(s).alias("section"), F.lit(f.name).alias("field"), (value if is_list else F.when(value.isNotNull(), F.array(value.cast("string")))).alias("value"), F.lit(is_list).alias("is_list")))
    return cards.select(key, F.explode(F.array(*parts)).alias("c")).select(key, "c.*")


def merge_facts(facts: DataFrame, keys: list[str]) -> DataFrame:
    """Per field the value of the source first in priority, of facts (keys, source, value) that are not missing."""
    rank = F.array_position(F.array(*map(F.lit, SOURCES)), F.col("source"))
    return facts.where(F.col("value").isNotNull() & ~is_missing("value")).groupBy(*keys).agg(F.min_by(F.struct("source", "value"), F.struct(F.when(rank == 0, 99).otherwise(rank), "value")).alias("c")).select(*keys, "c.*")


def override(card: DataFrame, values: DataFrame, always: tuple[str, ...] = ALWAYS) -> DataFrame:
    """Card fields with `values` (card_id, section, field, value): always for some paths, else only where the card has none."""
    new = values.select("card_id", "section", "field", F.col("value").alias("_new"))
    joined = card.join(new, ["card_id", "section", "field"], "left")
    take = F.col("_new").isNotNull() & (path().isin(*always) | empty())
    return joined.withColumn("overridden", take).withColumn("value", F.when(take, F.col("_new")).otherwise(F.col("value"))).drop("_new")


def backfill(card: DataFrame, provenance: DataFrame, least: int = 10) -> DataFrame:
    """Missing fields take their evidence from provenance if it is longer than `least` and does not deny."""
    said = provenance.where((F.length("evidence") > least) & ~F.lower("evidence").rlike("no information|not specified|not available|none found")).select("card_id", "section", "field", F.array("evidence").alias("_evidence"))
    joined = card.join(said, ["card_id", "section", "field"], "left")
    return joined.withColumn("value", F.when(empty(kind="card"), F.coalesce("_evidence", "value")).otherwise(F.col("value"))).drop("_evidence")


def inherit(child: DataFrame, parent: DataFrame) -> DataFrame:
    """A child's fields, and its parent's where it has none; identity and the protected section stay the child's own."""
    up = parent.select("section", "field", F.col("value").alias("_up"), F.col("is_list").alias("_list"))
    joined = child.join(up, ["section", "field"], "full_outer")
    own = (F.col("section") == PROTECTED) | (path() == "benchmark_details.name")
    return joined.select("section", "field", F.when(own | ~empty(), F.col("value")).otherwise(F.col("_up")).alias("value"), F.coalesce("is_list", "_list").alias("is_list"))


def missing_paths(card: DataFrame) -> DataFrame:
    """(card_id, path) of fields without a value; entries of lists that are stand-ins have an index."""
    whole = card.where(F.col("value").isNull() | (F.size("value") == 0) | (~F.col("is_list") & is_missing(F.get("value", F.lit(0))))).select("card_id", path().alias("path"))
    entries = card.where("is_list").select("card_id", path().alias("_p"), F.posexplode("value").alias("i", "v")).where(is_missing("v")).select("card_id", F.format_string("%s[%d]", "_p", "i").alias("path"))
    return whole.unionByName(entries)


def normalize(card: DataFrame) -> DataFrame:
    """One spelling for missing values: the stand-in for texts, an entry of it for lists."""
    return card.withColumn("value", F.when(empty(kind="card"), F.array(F.lit(NOT_SPECIFIED))).otherwise(F.col("value")))


def post_process(card: DataFrame, hub: str = "https://huggingface.co/datasets/") -> DataFrame:
    """Lists that only deny become empty, relative addresses absolute, entries distinct."""
    denial = r"(?i)^(none|no |not |n/a)"
    values = F.transform("value", lambda v: F.when(v.rlike(r"^/?datasets/[^\s]+$"), F.concat(F.lit(hub), F.regexp_replace(v, "^/?datasets/", ""))).otherwise(strip(v)))
    return card.withColumn("value", F.when(F.col("is_list") & (F.size("value") == 1) & F.get("value", F.lit(0)).rlike(denial), F.array().cast("array<string>")).when(F.col("is_list"), F.array_distinct(values)).otherwise(F.col("value")))


def reorder(card: DataFrame, sections: list[str]) -> DataFrame:
    order = F.array_position(F.array(*map(F.lit, sections)), F.col("section"))
    return card.orderBy("card_id", order, "field")


def atoms_of(card: DataFrame) -> DataFrame:
    """(card_id, field, text): the entries to check; risks and stand-ins are left out."""
    rows = card.where("section <> 'targeted_risks'").select("card_id", path().alias("field"), F.explode("value").alias("text"))
    return rows.where(~F.lower(F.trim("text")).isin(*SENTINELS["atom"]))


def prose(card: DataFrame) -> DataFrame:
    """A sentence for each section."""
    said = F.concat(F.translate("field", "_", " "), F.lit(": "), F.array_join("value", ", "))
    return card.where(~empty(kind="card")).groupBy("card_id", "section").agg(F.array_join(F.array_sort(F.collect_list(said)), ". ").alias("text"))


def confidence(paper: Column, readme: Column, scores: Column, html: Column, metadata: Column | None = None) -> Column:
    """high with a paper and a page or metadata of the dataset, medium with a paper or a page and scores, else low."""
    page = readme | html if metadata is None else readme | html | metadata
    return F.when(paper & page, "high").when(paper | (scores & (readme | html)), "medium").otherwise("low")


#: Paths up to which the valid fields go to every task.
BROADCAST_FIELDS = 10_000


def statements(texts: DataFrame, key: str, valid: DataFrame, text: str = "text") -> DataFrame:
    """`- text [field.path]` lines; paths that are not valid are repaired from the statement, unknown ones dropped."""
    lines = texts.select(key, F.posexplode(F.split(text, "\n")).alias("pos", "line")).where(F.trim("line").startswith("- "))
    body = F.regexp_replace(F.trim("line"), r"^- ", "")
    found = lines.select(key, "pos", strip(F.regexp_replace(body, r"\s*\[[^\]]*\]\s*$", "")).alias("text"), F.nullif(F.regexp_extract(body, r"\[([^\]]*)\]\s*$", 1), F.lit("")).alias("field"))
    paths = valid.select(F.col("field").alias("_ok")).distinct()
    known = found.join(F.broadcast(paths) if paths.count() <= BROADCAST_FIELDS else paths, F.col("field") == F.col("_ok"), "left")
    fixed = F.when(F.col("_ok").isNotNull() | F.col("field").isNull(), F.col("field")).otherwise(repaired("field", "text"))
    return known.withColumn("field", fixed).where("field IS NULL OR field <> 'unknown'").drop("_ok")


# For a part of a made-up path, in order, the words of the statement that decide, in order, and the field they
# mean; the last entry of each part has no words and takes the rest.
REPAIRS = [
    ("methodology", [
        (["f1-score", "accuracy", "performance", "achieved", "result"], "methodology.interpretation"),
        (["kappa", "measure", "calculate", "formula"], "methodology.calculation"),
        (["metric", "precision", "recall"], "methodology.metrics"),
        (["method", "approach", "technique"], "methodology.methods"),
        (["validation", "annotator", "judgement"], "methodology.validation"),
        ([], "methodology.interpretation"),
    ]),
    ("data", [
        (["size", "count", "example", "comment"], "data.size"),
        (["format", "csv", "json"], "data.format"),
        (["annotator", "annotation", "platform"], "data.annotation"),
        ([], "data.source"),
    ]),
    ("benchmark_details", [(["name"], "benchmark_details.name"), ([], "benchmark_details.overview")]),
    ("purpose", [([], "purpose_and_intended_users.goal")]),
    ("ethical", [(["license"], "ethical_and_legal_considerations.data_licensing"), ([], "ethical_and_legal_considerations.privacy_and_anonymity")]),
    ("legal", [(["license"], "ethical_and_legal_considerations.data_licensing"), ([], "ethical_and_legal_considerations.privacy_and_anonymity")]),
]


def repaired(field: str, statement: str) -> Column:
    """A valid path for a made-up one, from words of the statement; unknown parts keep what they say."""
    said = F.lower(statement)
    out = F.when(F.lit(False), F.lit(""))
    for part, choices in REPAIRS:
        meant = F.when(F.lit(False), F.lit(""))
        for words, target in choices:
            hit = reduce(lambda a, b: a | b, [said.contains(w) for w in words]) if words else F.lit(True)
            meant = meant.when(hit, target)
        out = out.when(F.lower(field).contains(part), meant)
    return out.otherwise(F.coalesce(F.nullif(F.col(field), F.lit("")), F.lit("unknown")))


def carried_heading(lines: DataFrame, key: str, order: str, line: str = "line") -> DataFrame:
    """The `## heading` each line is under."""
    mark = F.when(F.col(line).startswith("## "), strip(F.substr(F.col(line), F.lit(4))))
    return lines.withColumn("heading", F.last(mark, ignorenulls=True).over(Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)))
