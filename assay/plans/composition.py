"""From the sources of a benchmark to a card: facts of each source, merged, overridden, checked and finalised.

Facts and cards are in long form: facts (card_id, source, section, field, value), cards (card_id, section, field,
value ARRAY<STRING>, is_list). What a language model would read out of a text is a provider's work; `listed` stands in for it
and takes the `- field: value` lines under `## section` headings that a text has.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import checks
from ..functions.artifacts import USE_CASE
from ..functions.missing import NOT_SPECIFIED, is_missing
from ..functions.names import strip, sub_label
from ..functions.text import targeted_paragraphs
from ..operators import cards as C
from ..operators import factuality, retrieval
from ..providers import Provider, hashed_vectors
from ..storage import materialise, release

# The sections of a card in order, the fields that are lists, and how much of a source is read.
SECTIONS = ("benchmark_details", "purpose_and_intended_users", "data", "methodology", "ethical_and_legal_considerations")
CARD_ORDER = (*SECTIONS, "possible_risks", "flagged_fields", "missing_fields", "card_info")
LIST_FIELDS = ("domains", "languages", "similar_benchmarks", "resources", "audience", "tasks", "out_of_scope_uses", "methods", "metrics")
LEAST, MOST = {"PAPER": 1, "HTML": 50, "HF_README": 100}, {"PAPER": None, "HTML": 15_000, "HF_README": 15_000}
# What to search a paper for where a field was not found.
GAP_QUERIES = {
    "domains": "domain area subject field topic application area research discipline",
    "limitations": "limitation weakness constraint bias shortcoming caveat",
    "annotation": "annotation annotator label crowdworker human judge agreement quality control",
    "source": "data collection source origin corpus created gathered compiled",
    "similar_benchmarks": "related work comparison benchmark dataset alternative prior",
    "audience": "intended user researcher practitioner developer community",
    "out_of_scope_uses": "not designed for out of scope limitation inappropriate use",
    "consent_procedures": "crowdworker consent compensation IRB ethical approval platform",
    "methods": "evaluation method zero-shot few-shot fine-tune prompt protocol",
    "baseline_results": "baseline result score performance accuracy model evaluation",
    "calculation": "overall score calculation aggregate average weighted macro",
}
NO_INFORMATION = "no information found"


# ---------------------------------------------------------------- facts


def source_texts(sources: DataFrame) -> DataFrame:
    """(card_id, name, anchor, source, text) of sources (card_id, name, anchor, paper, html, readme): one row for each usable text."""
    parts = F.array(*[F.struct(F.lit(s).alias("source"), F.col(c).alias("text"), F.lit(LEAST[s]).alias("least"), F.lit(MOST[s]).cast("int").alias("most")) for s, c in (("PAPER", "paper"), ("HTML", "html"), ("HF_README", "readme"))])
    rows = sources.select("card_id", "name", "anchor", F.explode(parts).alias("p")).where((F.length("p.text") >= F.col("p.least")) & (F.col("p.text") != "Not available"))
    return rows.select("card_id", "name", "anchor", "p.source", F.when(F.col("p.most").isNull(), F.col("p.text")).otherwise(F.substring("p.text", F.lit(1), F.col("p.most"))).alias("text"))


def listed(rows: DataFrame) -> DataFrame:
    """The stand-in for extraction: the text is its own list of facts."""
    return rows.withColumn("facts", F.col("text"))


def fact_lines(rows: DataFrame, facts: str = "facts") -> DataFrame:
    """(…, section, field, value, missing): the `- field: value` lines of facts, under their section's heading.

    A heading is a line `## name` or `**name**`, with `_` or blanks; lines under other headings than sections go. `missing`
    says that the source has no information.
    """
    others = [c for c in rows.columns if c != facts]
    none = F.array().cast("array<struct<section:string,line:string>>")

    def heading(line: Column) -> Column:
        name, bold = (F.regexp_extract(strip(line), p, 1) for p in (r"^(?:##\s*(.+?)|\*\*(.+?)\*\*)\s*$", r"^\*\*(.+?)\*\*\s*$"))
        return F.nullif(F.translate(F.lower(strip(F.when(name != "", name).otherwise(bold))), " ", "_"), F.lit(""))

    def under(text: Column) -> Column:
        """The facts between each heading and the next. No line meets a row of its own, with a copy of the others, before it is one."""
        lines, heads = text["lines"], text["heads"]
        after = lambda h, k: F.slice(lines, h["at"] + 2, F.coalesce(F.get(heads, k + 1)["at"], F.size(lines)) - h["at"] - 1)
        own = lambda h, k: F.transform(F.filter(after(h, k), lambda x: strip(x).rlike(r"^-\s*\w+\s*:")), lambda x: F.struct(h["section"].alias("section"), x.alias("line")))
        return F.flatten(F.transform(heads, lambda h, k: F.when(h["section"].isin(*SECTIONS), own(h, k)).otherwise(none)))

    lines = F.split(facts, "\n")
    heads = F.filter(F.transform(lines, lambda x, i: F.struct(i.alias("at"), heading(x).alias("section"))), lambda h: h["section"].isNotNull())
    # an array of one, so that lines and headings are found once
    found = F.flatten(F.transform(F.array(F.struct(lines.alias("lines"), heads.alias("heads"))), under))
    rows = rows.select(*others, F.explode(found).alias("_f")).select(*others, "_f.section", "_f.line")
    value = strip(F.regexp_replace(strip("line"), r"^-\s*\w+\s*:", ""))
    return rows.select(*others, "section", F.regexp_extract(strip("line"), r"^-\s*(\w+)\s*:", 1).alias("field"), value.alias("value"), F.lower("line").contains(NO_INFORMATION).alias("missing"), "line")


def extracted(texts: DataFrame, extract: Provider = listed) -> DataFrame:
    """(card_id, source, section, field, value, missing): what each source says, each read by itself.

    Lines that seem to be about something else than the source's benchmark are dropped.
    """
    rows = extract(texts)
    lines = fact_lines(rows.select("card_id", "name", "anchor", "source", "text", "facts"))
    note = checks.suspect_note("line", "text", "name", checks.topics("anchor"))
    return lines.where(note.isNull() & ~F.col("line").contains("[UNVERIFIED]")).select("card_id", "source", "section", "field", "value", "missing")


def paper_chunks(papers: DataFrame, size: int = 1000, overlap: int = 200, others: tuple[str, ...] = ()) -> DataFrame:
    """(card_id, others, chunk, text) of papers (card_id, others, text)."""
    return retrieval.split_chunks(papers, ["card_id", *others], size, overlap, ("\n\n", "\n", " "))


def gaps(facts: DataFrame) -> DataFrame:
    """(card_id, section, field, text): searches for the fields that a paper seemed not to have."""
    queries = F.create_map(*[F.lit(x) for pair in GAP_QUERIES.items() for x in pair])
    open_ = facts.where((F.col("source") == "PAPER") & F.col("missing") & F.col("field").isin(*GAP_QUERIES))
    return open_.select("card_id", "section", "field", F.element_at(queries, F.col("field")).alias("text")).distinct()


def fill_gaps(facts: DataFrame, papers: DataFrame, extract: Callable[[DataFrame], DataFrame] | None = None, embed: Provider | None = None, top: int = 2, most: int = 1500) -> DataFrame:
    """facts with the missing fields of papers read again from the chunks nearest to their search.

    extract adds `value` to rows (card_id, section, field, text); without one the chunks' own lines for the field count.
    """
    embed = embed or hashed_vectors()
    wanted = embed(gaps(facts)).groupBy("card_id").agg(F.collect_list(F.struct("section", "field", F.col("embedding").alias("_q"))).alias("_gaps"))
    # whole papers meet their searches and are cut then, so that a shuffle has each text once. By a hint, as searches that are
    # alike seem much smaller than they are
    chunks = embed(paper_chunks(papers.hint("merge").join(wanted, "card_id").select("card_id", "_gaps", "text"), others=("_gaps",)))
    rows = chunks.select("card_id", "chunk", "text", "embedding", F.explode("_gaps").alias("_g")).select("card_id", "_g.section", "_g.field", "chunk", "text", retrieval.cosine("embedding", "_g._q").alias("_s"))
    near = retrieval.ranked(rows, ["card_id", "section", "field"], [F.desc("_s"), F.col("chunk")], top)
    texts = near.groupBy("card_id", "section", "field").agg(F.substring(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "text"))), lambda s: s["text"]), "\n"), 1, most).alias("text"))
    lines = F.expr(r"regexp_extract_all(text, concat('(?mi)^-\\s*', field, ':\\s*(.+)$'), 1)")
    own = F.get(F.filter(lines, lambda v: ~F.contains(F.lower(v), F.lit(NO_INFORMATION))), F.lit(0))
    read = extract(texts) if extract else texts.withColumn("value", F.nullif(own, F.lit("")))
    new = read.where(F.col("value").isNotNull() & ~F.lower("value").contains(NO_INFORMATION)).select("card_id", F.lit("PAPER").alias("source"), "section", "field", F.col("value").alias("_v"))
    joined = facts.hint("merge").join(new, ["card_id", "source", "section", "field"], "left")
    fill = F.col("missing") & F.col("_v").isNotNull()
    return joined.withColumn("value", F.when(fill, F.col("_v")).otherwise(F.col("value"))).withColumn("missing", F.col("missing") & ~fill).drop("_v")


def tag_facts(tags: DataFrame) -> DataFrame:
    """DETERMINISTIC facts of tags (card_id, languages, data_licensing, size_category, format, tasks, domain_tags), lists joined."""
    places = {"languages": ("benchmark_details", "languages"), "data_licensing": ("ethical_and_legal_considerations", "data_licensing"), "format": ("data", "format"), "size_category": ("data", "size"), "tasks": ("purpose_and_intended_users", "tasks"), "domain_tags": ("benchmark_details", "domains")}
    kinds = dict(tags.dtypes)
    one = lambda c: F.array_join(c, ", ") if kinds[c].startswith("array") else F.col(c)
    entries = F.array(*[F.struct(F.lit(s).alias("section"), F.lit(f).alias("field"), one(c).alias("value")) for c, (s, f) in places.items() if c in kinds])
    return tags.select("card_id", F.lit("DETERMINISTIC").alias("source"), F.explode(entries).alias("e")).select("card_id", "source", "e.*").where("value IS NOT NULL")


# ---------------------------------------------------------------- composing


def compose(sources: DataFrame, deterministic: DataFrame | None = None, values: DataFrame | None = None, addresses: DataFrame | None = None, extract: Provider = listed) -> tuple[DataFrame, DataFrame]:
    """(card, provenance) of sources (card_id, name, anchor, paper, html, readme).

    The facts that are read out of the sources are written to a table, which the result reads.

    deterministic: facts of structured metadata; values: what overrides the card's fields, see cards.override; addresses
    (card_id, value ARRAY): resources to append. Every card has every field that any of its sources mentions, and its name.
    """
    # facts are few beside their texts and are read several times
    read, p_read = materialise(extracted(source_texts(sources), extract), "facts-read")
    facts, _ = materialise(fill_gaps(read, sources.where("paper IS NOT NULL").select("card_id", F.col("paper").alias("text"))), "facts-filled")
    release(sources.sparkSession, p_read)
    found = facts.where("NOT missing").select("card_id", "section", "field", "source", "value")
    names = sources.select("card_id", F.lit("benchmark_details").alias("section"), F.lit("name").alias("field"), F.lit("DETERMINISTIC").alias("source"), F.col("name").alias("value"))
    found = found.unionByName(names) if deterministic is None else found.unionByName(names).unionByName(deterministic.select("card_id", "section", "field", "source", "value"))
    merged = C.merge_facts(found, ["card_id", "section", "field"])
    fields = facts.select("card_id", "section", "field").unionByName(found.select("card_id", "section", "field")).distinct()
    is_list = F.col("field").isin(*LIST_FIELDS)
    value = F.when(is_list, F.transform(F.split("value", r"\s*[,;]\s*"), strip)).otherwise(F.array("value"))
    card = fields.hint("merge").join(merged, ["card_id", "section", "field"], "left").select("card_id", "section", "field", F.when(F.col("value").isNotNull(), value).alias("value"), is_list.alias("is_list"))
    if values is not None:
        card = C.override(card, values).drop("overridden")
    if addresses is not None:
        card = with_addresses(card, addresses)
    provenance = merged.select("card_id", "section", "field", "source", F.col("value").alias("evidence"))
    return C.normalize(C.post_process(card)), provenance


def with_addresses(card: DataFrame, addresses: DataFrame) -> DataFrame:
    """Appends addresses to the resources of cards, in order, none twice; a card without resources gets them."""
    here = (F.col("section") == "benchmark_details") & (F.col("field") == "resources")
    more = addresses.select("card_id", F.col("value").alias("_more"))
    own = card.where(here)
    empty = F.array().cast("array<string>")
    both = own.join(more, "card_id", "full_outer").select("card_id", F.lit("benchmark_details").alias("section"), F.lit("resources").alias("field"), F.array_union(F.when(C.empty(), empty).otherwise(F.col("value")), F.coalesce("_more", empty)).alias("value"), F.lit(True).alias("is_list"))
    return card.where(~here).unionByName(both)


def use_case(card: DataFrame) -> DataFrame:
    """(card_id, text): sentences on what is known of each benchmark; cards that say nothing have none."""
    order = F.array(*[F.lit(p) for p, _ in USE_CASE])
    before = F.create_map(*[F.lit(x) for pair in USE_CASE for x in pair])
    name = F.max(F.when(C.path() == "benchmark_details.name", F.get("value", F.lit(0))))
    rows = card.where(~C.empty()).withColumn("_p", C.path()).withColumn("_at", F.array_position(order, F.col("_p")))
    said = F.concat(F.element_at(before, F.col("_p")), F.array_join("value", ", "))
    parts = rows.groupBy("card_id").agg(name.alias("_name"), F.array_sort(F.collect_list(F.when(F.col("_at") > 0, F.struct("_at", said.alias("s"))))).alias("_parts"))
    sentences = F.concat(F.when(F.col("_name").isNotNull(), F.array(F.concat("_name", F.lit(" is a benchmark")))).otherwise(F.array().cast("array<string>")), F.transform("_parts", lambda p: p["s"]))
    text = F.array_join(sentences, ". ")
    return parts.where(F.size(sentences) > 0).select("card_id", F.when(text.endswith("."), text).otherwise(F.concat(text, F.lit("."))).alias("text"))


# The sentences on each section of a card: field, words before and after its value.
PROSE = {
    "overview": [("benchmark_details.overview", "", ""), ("benchmark_details.domains", "It is used for ", "."), ("benchmark_details.languages", "It supports ", " languages.")],
    "purpose": [("purpose_and_intended_users.goal", "", ""), ("purpose_and_intended_users.tasks", "The benchmark includes tasks such as: ", ".")],
    "data": [("data.size", "The dataset size is ", "."), ("data.format", "The data format is ", "."), ("data.source", "The data source is ", ".")],
    "methodology": [("methodology.metrics", "The benchmark uses ", " as metrics."), ("methodology.evaluation_approach", "The evaluation approach is ", ".")],
}


def output_text(card: DataFrame, field: str = "overview") -> DataFrame:
    """(card_id, text): a card's sentences on one part, or on all; the overview where there are none."""
    wanted = [x for part in (PROSE.values() if field == "all" else [PROSE[field]]) for x in part]
    order, before, after = F.array(*[F.lit(p) for p, _, _ in wanted]), F.create_map(*[F.lit(x) for p, b, _ in wanted for x in (p, b)]), F.create_map(*[F.lit(x) for p, _, a in wanted for x in (p, a)])
    rows = card.where(F.col("value").isNotNull() & (F.size("value") > 0)).withColumn("_p", C.path()).withColumn("_at", F.array_position(order, F.col("_p")))
    one = (F.col("_p") == "benchmark_details.languages") & (F.size("value") == 1)
    said = F.concat(F.element_at(before, F.col("_p")), F.array_join("value", ", "), F.when(one, " language.").otherwise(F.element_at(after, F.col("_p"))))
    parts = rows.groupBy("card_id").agg(F.array_sort(F.collect_list(F.when(F.col("_at") > 0, F.struct("_at", said.alias("s"))))).alias("_parts"), F.max(F.when(F.col("_p") == "benchmark_details.overview", F.get("value", F.lit(0)))).alias("_overview"))
    return parts.select("card_id", F.when(F.size("_parts") > 0, F.array_join(F.transform("_parts", lambda p: p["s"]), " ")).otherwise(F.coalesce("_overview", F.lit(""))).alias("text"))


# ---------------------------------------------------------------- checking and finalising


def atomised(card: DataFrame, split: Provider | None = None) -> DataFrame:
    """(card_id, nth, field, text): the statements to check; of a card that yields none, that it has its name.

    split adds statements to rows (card_id, field, text) as `statements`; without one every entry is a statement.
    """
    entries = C.atoms_of(card)
    if split is not None:
        entries = split(entries).select("card_id", "field", F.explode("statements").alias("text"))
    some = entries.where(F.length(strip("text")) > 0)
    named = card.where(C.path() == "benchmark_details.name").select("card_id", F.lit("benchmark_details").alias("field"), F.concat(F.lit("The benchmark is called "), F.get("value", F.lit(0))).alias("text"))
    rows = some.unionByName(named.join(some.select("card_id").distinct(), "card_id", "left_anti"))
    return rows.withColumn("nth", F.row_number().over(Window.partitionBy("card_id").orderBy("field", "text")) - 1).select("card_id", "nth", "field", "text")


def finalise(card: DataFrame, fields: DataFrame, provenance: DataFrame, overrides: DataFrame | None = None, model: str = "none", created: Column | None = None) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(card, flags, missing, info): the last steps, in this order, as each sees what the one before leaves.

    Flag by factuality; unflag analytical and identity fields; back-fill from provenance; normalise; override from tags;
    clear the flags of what was overridden; list missing paths; say when and by what model the card was made.
    fields are factuality's fields with card_id; overrides (card_id, section, field, value).
    """
    proven = provenance.select("card_id", F.concat_ws(".", "section", "field").alias("field"), "source", "evidence")
    flags = factuality.unflagged(factuality.flags(fields, proven, keys=["card_id"]))
    done = C.normalize(C.backfill(card, provenance))
    if overrides is not None:
        done = C.override(done, overrides, C.VALIDATED)
        changed = done.where("overridden").select("card_id", C.path().alias("_p"), F.col("field").alias("_f"))
        flags = flags.join(changed, (flags["card_id"] == changed["card_id"]) & ((flags["field"] == changed["_p"]) | (flags["field"] == changed["_f"])), "left_anti")
        done = done.drop("overridden")
    info = card.select("card_id").distinct().select("card_id", (F.current_timestamp() if created is None else created).alias("created_at"), F.lit(model).alias("llm"))
    return done, flags, C.missing_paths(done), info


def with_membership(card: DataFrame, kinds: DataFrame) -> DataFrame:
    """Adds benchmark_type, contains and appears_in of kinds (card_id, benchmark_type, contains, appears_in) to the details."""
    empty = F.array().cast("array<string>")
    entries = F.array(
        F.struct(F.lit("benchmark_type").alias("field"), F.array(F.coalesce("benchmark_type", F.lit("single"))).alias("value"), F.lit(False).alias("is_list")),
        F.struct(F.lit("contains").alias("field"), F.when(F.col("benchmark_type") == "composite", F.coalesce("contains", empty)).otherwise(empty).alias("value"), F.lit(True).alias("is_list")),
        F.struct(F.lit("appears_in").alias("field"), F.coalesce("appears_in", empty).alias("value"), F.lit(True).alias("is_list")),
    )
    rows = kinds.select("card_id", F.lit("benchmark_details").alias("section"), F.explode(entries).alias("e")).select("card_id", "section", "e.*").where((F.col("field") == "benchmark_type") | (F.size("value") > 0))
    own = card.join(rows.select("card_id", "section", "field"), ["card_id", "section", "field"], "left_anti")
    return own.unionByName(rows.select(*own.columns))


def with_risks(card: DataFrame, found: DataFrame) -> DataFrame:
    """Adds possible_risks of found (card_id, risks); cards whose risks are null or none stay as they are."""
    some = found.where(F.size("risks") > 0).select("card_id", F.lit("possible_risks").alias("section"), F.lit("risks").alias("field"), F.transform("risks", lambda r: F.to_json(F.struct(r["category"].alias("category"), r["description"].alias("description"), F.nullif(r["url"], F.lit("")).alias("url")))).alias("value"), F.lit(True).alias("is_list"))
    kept = card.join(some.select("card_id", "section"), ["card_id", "section"], "left_anti")
    return kept.unionByName(some.select(*kept.columns))


# ---------------------------------------------------------------- sub-benchmarks


def sub_facts(rows: DataFrame, read: Callable[[DataFrame], DataFrame], most: int = 30_000, readme_most: int = 15_000) -> DataFrame:
    """(card_id, facts): what paper, else README, says of a sub-benchmark; rows (card_id, name, parent, paper, readme).

    The paper's paragraphs on its label are read, or its beginning if there are none. read adds `facts` to rows (card_id,
    label, text); an answer that nothing was found counts as none.
    """
    label = sub_label("name", "parent")
    parts = F.split("paper", "\n\n")
    about = F.when(F.exists(parts, lambda p: F.lower(p).contains(F.lower(label))), targeted_paragraphs("paper", label))
    texts = F.array(F.struct(F.lit(0).alias("tier"), F.coalesce(about, F.substring("paper", 1, most)).alias("text")), F.struct(F.lit(1).alias("tier"), F.substring("readme", 1, readme_most).alias("text")))
    asked = rows.select("card_id", label.alias("label"), F.explode(texts).alias("t")).select("card_id", "label", "t.*").where(F.length("text") > 0)
    said = read(asked).where(F.col("facts").isNotNull() & ~F.upper("facts").contains("NO SPECIFIC INFORMATION FOUND"))
    return said.groupBy("card_id").agg(F.min_by("facts", "tier").alias("facts"))


def fallback_overview(description: Column | str, label: Column | str, parent: Column | str, overview: Column | str) -> Column:
    """The overview of a sub-benchmark of which nothing is known: a description of at most two sentences, then its parent's."""
    as_col = lambda c: F.col(c) if isinstance(c, str) else c
    two = F.array_join(F.slice(F.split(strip(as_col(description)), r"\. "), 1, 2), ". ")
    short = F.when(two.endswith("."), two).otherwise(F.concat(two, F.lit(".")))
    return F.concat(short, F.lit('\n\nThis is the "'), as_col(label), F.lit('" sub-component of '), as_col(parent), F.lit(". "), F.coalesce(as_col(overview), F.lit("")))


def sub_cards(parents: DataFrame, subs: DataFrame, specific: DataFrame | None = None) -> DataFrame:
    """Cards of subs (card_id, name, parent_id, appears_in, description): the parent's fields, with name, type, membership.

    specific (card_id, section, field, value) replaces inherited fields outside the protected section. A sub-benchmark
    without specific facts that has a description gets it before its parent's overview.
    """
    up = parents.withColumnRenamed("card_id", "parent_id").join(subs.select("card_id", "parent_id", "name", "description"), "parent_id")
    names = parents.where(C.path() == "benchmark_details.name").select(F.col("card_id").alias("parent_id"), F.get("value", F.lit(0)).alias("_parent"))
    up = up.join(names, "parent_id", "left")
    known = specific.select("card_id").distinct().withColumn("_known", F.lit(True)) if specific is not None else None
    up = up.join(known, "card_id", "left") if known is not None else up.withColumn("_known", F.lit(None).cast("boolean"))
    first = F.get("value", F.lit(0))
    overview = (C.path() == "benchmark_details.overview") & F.col("_known").isNull() & F.col("description").isNotNull()
    value = F.when(C.path() == "benchmark_details.name", F.array("name")).when(overview, F.array(fallback_overview("description", sub_label("name", "_parent"), "_parent", first))).otherwise(F.col("value"))
    card = up.select("card_id", "section", "field", value.alias("value"), "is_list")
    if specific is not None:
        new = specific.where(F.col("section") != C.PROTECTED).select("card_id", "section", "field", F.col("value").alias("_new"))
        card = card.join(new, ["card_id", "section", "field"], "full_outer").select("card_id", "section", "field", F.coalesce("_new", "value").alias("value"), F.coalesce("is_list", F.col("field").isin(*LIST_FIELDS)).alias("is_list"))
    kinds = subs.select("card_id", F.lit("sub-benchmark").alias("benchmark_type"), F.lit(None).cast("array<string>").alias("contains"), "appears_in")
    return C.post_process(with_membership(card, kinds))


# ---------------------------------------------------------------- stages


def stage(states: DataFrame, name: str, run: Callable[[DataFrame], DataFrame], out: str, ready: Column, key: str = "item") -> DataFrame:
    """states with column `out` of run(those that are ready), and an entry "<name> done" or "<name> failed" in their logs.

    run returns (key, out, error); a row without result failed, whatever its error. States that are not ready stay as they are.
    """
    made = run(states.where(ready)).select(F.col(key).alias("_k"), F.col(out).alias("_out"), F.col("error").alias("_error"))
    rows = states.withColumn("_ready", ready).join(made, F.col(key) == F.col("_k"), "left")
    told = F.when(F.col("_out").isNotNull(), F.lit(f"{name} done")).otherwise(F.concat(F.lit(f"{name} failed"), F.coalesce(F.concat(F.lit(": "), "_error"), F.lit(""))))
    value = F.when(F.col("_ready"), F.col("_out")).otherwise(F.col(out) if out in states.columns else F.lit(None))
    log = F.when(F.col("_ready"), F.concat(F.coalesce("log", F.array().cast("array<string>")), F.array(told))).otherwise(F.col("log"))
    return rows.withColumn(out, value).withColumn("log", log).drop("_ready", "_k", "_out", "_error")


def baseline(card: DataFrame, sentences: DataFrame) -> DataFrame:
    """Cards whose baseline results are missing get the sentence on their scores (card_id, sentence)."""
    joined = card.join(sentences.select("card_id", "sentence"), "card_id", "left")
    here = (C.path() == "methodology.baseline_results") & C.empty("value", "baseline") & F.col("sentence").isNotNull()
    return joined.withColumn("value", F.when(here, F.array("sentence")).otherwise(F.col("value"))).drop("sentence")


def specified(value: Column | str) -> Column:
    """Whether a text says something."""
    v = F.col(value) if isinstance(value, str) else value
    return v.isNotNull() & ~is_missing(v, "override")


def card_rows(card: DataFrame, order: tuple[str, ...] = CARD_ORDER) -> DataFrame:
    """(card_id, card): each card as one JSON text, sections in order, single values as texts, missing ones spelled out."""
    one = F.when(F.col("is_list"), F.to_json("value")).otherwise(F.to_json(F.array(F.coalesce(F.get("value", F.lit(0)), F.lit(NOT_SPECIFIED)))))
    single = F.when(F.col("is_list"), one).otherwise(F.regexp_replace(F.regexp_replace(one, r"^\[", ""), r"\]$", ""))
    fields = card.withColumn("_f", F.concat(F.to_json(F.array("field")), F.lit(":"), single)).withColumn("_f", F.regexp_replace("_f", r'^\["((?:[^"\\]|\\.)*)"\]:', '"$1":'))
    sections = fields.groupBy("card_id", "section").agg(F.concat(F.lit("{"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("field", "_f"))), lambda s: s["_f"]), ","), F.lit("}")).alias("_s"))
    place = F.array_position(F.array(*map(F.lit, order)), F.col("section"))
    rank = F.when(place == 0, 99).otherwise(place)
    whole = F.concat(F.lit("{"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(rank.alias("r"), F.col("section").alias("n"), F.col("_s").alias("s")))), lambda x: F.concat(F.lit('"'), x["n"], F.lit('":'), x["s"])), ","), F.lit("}"))
    return sections.groupBy("card_id").agg(whole.alias("card"))
