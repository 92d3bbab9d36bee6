"""Papers of benchmarks: a table of known ones, search results, candidates, and the log of a decision."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions._columns import Text, col
from ..functions.fuzzy import partial_ratio
from ..functions.names import strip, underscore_name
from ..functions.text import abstract_from_index, best_paper_url, markdown_title, strip_references
from ..providers import Provider

# Papers of well-known benchmarks, by name in lower case with `_`.
KNOWN_PAPERS = {
    "gsm8k": "https://arxiv.org/abs/2110.14168",
    "math": "https://arxiv.org/abs/2103.03874",
    "math_level5": "https://arxiv.org/abs/2103.03874",
    "hendrycks_math": "https://arxiv.org/abs/2103.03874",
    "minerva_math": "https://arxiv.org/abs/2103.03874",
    "agieval": "https://arxiv.org/abs/2304.06364",
    "drop": "https://arxiv.org/abs/1903.00161",
    "logiqa": "https://arxiv.org/abs/2007.08124",
    "logiqa2": "https://arxiv.org/abs/2007.08124",
    "humaneval": "https://arxiv.org/abs/2107.03374",
    "mbpp": "https://arxiv.org/abs/2108.07732",
    "apps": "https://arxiv.org/abs/2105.09938",
    "ds1000": "https://arxiv.org/abs/2211.11501",
    "livecodebench": "https://arxiv.org/abs/2403.07974",
    "swe_bench": "https://arxiv.org/abs/2310.06770",
    "bigcodebench": "https://arxiv.org/abs/2406.15877",
    "mmlu": "https://arxiv.org/abs/2009.03300",
    "mmlu_pro": "https://arxiv.org/abs/2406.01574",
    "hellaswag": "https://arxiv.org/abs/1905.07830",
    "winogrande": "https://arxiv.org/abs/1907.10641",
    "arc": "https://arxiv.org/abs/1803.05457",
    "arc_challenge": "https://arxiv.org/abs/1803.05457",
    "arc_easy": "https://arxiv.org/abs/1803.05457",
    "arc_agi": "https://arxiv.org/abs/1911.01547",
    "triviaqa": "https://arxiv.org/abs/1705.03551",
    "truthfulqa": "https://arxiv.org/abs/2109.07958",
    "openbookqa": "https://arxiv.org/abs/1809.02789",
    "commonsenseqa": "https://arxiv.org/abs/1811.00937",
    "piqa": "https://arxiv.org/abs/1911.11641",
    "siqa": "https://arxiv.org/abs/1904.09728",
    "gpqa": "https://arxiv.org/abs/2311.12022",
    "naturalquestions": "https://arxiv.org/abs/1905.10044",
    "naturalquestions_open_book": "https://arxiv.org/abs/1905.10044",
    "naturalquestions_closed_book": "https://arxiv.org/abs/1905.10044",
    "squad": "https://arxiv.org/abs/1606.05250",
    "squad_v2": "https://arxiv.org/abs/1806.03822",
    "boolq": "https://arxiv.org/abs/1905.10044",
    "race": "https://arxiv.org/abs/1704.04683",
    "quac": "https://arxiv.org/abs/1808.07036",
    "coqa": "https://arxiv.org/abs/1808.07042",
    "copa": "https://arxiv.org/abs/2012.15723",
    "rte": "https://arxiv.org/abs/1804.07461",
    "wsc": "https://arxiv.org/abs/1804.07461",
    "multirc": "https://arxiv.org/abs/1804.07461",
    "record": "https://arxiv.org/abs/1804.07461",
    "cb": "https://arxiv.org/abs/1804.07461",
    "wic": "https://arxiv.org/abs/1804.07461",
    "cnn_dailymail": "https://arxiv.org/abs/1602.06023",
    "xsum": "https://arxiv.org/abs/1808.08745",
    "samsum": "https://arxiv.org/abs/1911.12237",
    "imdb": "https://arxiv.org/abs/1011.4086",
    "sst2": "https://arxiv.org/abs/1804.07461",
    "wnli": "https://arxiv.org/abs/1804.07461",
    "mnli": "https://arxiv.org/abs/1804.07461",
    "qnli": "https://arxiv.org/abs/1804.07461",
    "mrpc": "https://arxiv.org/abs/1804.07461",
    "qqp": "https://arxiv.org/abs/1804.07461",
    "cola": "https://arxiv.org/abs/1804.07461",
    "ifeval": "https://arxiv.org/abs/2311.07911",
    "alpaca_eval": "https://arxiv.org/abs/2404.04475",
    "mt_bench": "https://arxiv.org/abs/2306.05685",
    "chatbot_arena": "https://arxiv.org/abs/2306.05685",
    "wildbench": "https://arxiv.org/abs/2406.04770",
    "bbh": "https://arxiv.org/abs/2210.09261",
    "big_bench_hard": "https://arxiv.org/abs/2210.09261",
    "musr": "https://arxiv.org/abs/2310.16049",
    "glue": "https://arxiv.org/abs/1804.07461",
    "superglue": "https://arxiv.org/abs/1905.00537",
    "helm": "https://arxiv.org/abs/2211.09110",
    "helm_capabilities": "https://arxiv.org/abs/2211.09110",
    "helm_lite": "https://arxiv.org/abs/2211.09110",
    "bfcl": "https://arxiv.org/abs/2402.15671",
    "bfcl_live": "https://arxiv.org/abs/2402.15671",
    "bfcl_non_live": "https://arxiv.org/abs/2402.15671",
    "bfcl_memory": "https://arxiv.org/abs/2402.15671",
    "bfcl_multi_turn": "https://arxiv.org/abs/2402.15671",
    "bfcl_web_search": "https://arxiv.org/abs/2402.15671",
    "bfcl_format_sensitivity": "https://arxiv.org/abs/2402.15671",
    "appworld": "https://arxiv.org/abs/2407.18901",
    "terminal_bench_2_0": "https://arxiv.org/abs/2601.11868",
    "tau_bench": "https://arxiv.org/abs/2406.12045",
    "wmt_2014": "https://arxiv.org/abs/1706.03762",
    "flores": "https://arxiv.org/abs/2106.03193",
    "pubmedqa": "https://arxiv.org/abs/1909.06146",
    "medqa": "https://arxiv.org/abs/2009.13081",
    "medmcqa": "https://arxiv.org/abs/2203.14371",
    "toxigen": "https://arxiv.org/abs/2203.09509",
    "bbq": "https://arxiv.org/abs/2110.08514",
    "crowspairs": "https://arxiv.org/abs/2010.00133",
    "lambada": "https://arxiv.org/abs/1606.06031",
    "self_instruct": "https://arxiv.org/abs/2212.10560",
    "omni_math": "https://arxiv.org/abs/2410.07985",
    "theory_of_mind": "https://arxiv.org/abs/2302.02083",
}
CANDIDATES, SURE = 10, 0.7


def with_known(rows: DataFrame, name: str = "name", table: dict[str, str] = KNOWN_PAPERS) -> DataFrame:
    """rows with known_paper; the table is a literal of fixed size."""
    spark = rows.sparkSession
    known = spark.createDataFrame(list(table.items()), "_key string, known_paper string")
    return rows.withColumn("_k", underscore_name(name)).join(F.broadcast(known), F.col("_k") == F.col("_key"), "left").drop("_k", "_key")


def of_parent(rows: DataFrame, table: DataFrame, parent: str = "parent", values: tuple[str, ...] = ("paper_url", "hf_repo")) -> DataFrame:
    """rows with parent_<value>: of the table (name, ord, values) the first row named like the parent."""
    first = table.groupBy(F.col("name").alias("_parent")).agg(*[F.min_by(F.struct(v), "ord")[v].alias(f"parent_{v}") for v in values])
    return rows.join(first, F.col(parent) == F.col("_parent"), "left").drop("_parent")


CANDIDATE = "struct<title:string,abstract:string,year:int,citations:bigint,doi:string,arxiv_id:string,url:string>"
_WORK = "title string, publication_year int, cited_by_count bigint, ids struct<doi: string>, locations array<struct<landing_page_url: string>>, primary_location struct<landing_page_url: string>, abstract_inverted_index map<string, array<int>>"
_PAPER = "title string, abstract string, year int, citationCount bigint, externalIds struct<ArXiv: string, DOI: string>, url string"


def _candidate(title: Column, abstract: Column, year: Column, citations: Column, doi: Column, arxiv: Column, url: Column) -> Column:
    text = lambda c: F.coalesce(c, F.lit(""))
    return F.struct(text(title).alias("title"), text(abstract).alias("abstract"), year.alias("year"), F.coalesce(citations, F.lit(0)).cast("long").alias("citations"), text(doi).alias("doi"), arxiv.alias("arxiv_id"), text(url).alias("url"))


def openalex(work: Text) -> Column:
    """A candidate from one work of an OpenAlex answer; the abstract is put together from its inverted index."""
    w = F.from_json(col(work), _WORK)
    page = F.get(F.filter(F.transform(w["locations"], lambda x: x["landing_page_url"]), lambda u: u.contains("arxiv.org")), F.lit(0))
    arxiv = F.element_at(F.split(F.regexp_replace(page, "/+$", ""), "/"), -1)
    doi = F.nullif(w["ids"]["doi"], F.lit(""))
    return _candidate(w["title"], abstract_from_index(w["abstract_inverted_index"]), w["publication_year"], w["cited_by_count"], doi, arxiv, F.coalesce(doi, w["primary_location"]["landing_page_url"]))


def semantic_scholar(paper: Text) -> Column:
    """A candidate from one paper of a Semantic Scholar answer."""
    p = F.from_json(col(paper), _PAPER)
    doi = F.nullif(p["externalIds"]["DOI"], F.lit(""))
    return _candidate(p["title"], p["abstract"], p["year"], p["citationCount"], doi, p["externalIds"]["ArXiv"], F.coalesce(F.concat(F.lit("https://doi.org/"), doi), p["url"]))


READERS = {"openalex": openalex, "semantic_scholar": semantic_scholar}


def candidates(answers: DataFrame, json: str = "json", source: str = "source") -> DataFrame:
    """answers (key, query, query_no, source, source_no, place, json) with the fields of a candidate."""
    read = F.when(F.lit(False), F.lit(None).cast(CANDIDATE))
    for name, reader in READERS.items():
        read = read.when(F.col(source) == name, reader(json))
    return answers.withColumn("_c", read).where(F.col("_c").isNotNull()).select(*[c for c in answers.columns if c != json], "_c.*")


def prefiltered(found: DataFrame, names: DataFrame, key: str = "key") -> DataFrame:
    """Candidates whose title is like one of the names, with `similarity`.

    names has (key, name, references ARRAY, domain). A short name needs 65, and below 80 a longer word of the domain, if there
    is one, in title or abstract; other names need 50.
    """
    rows = found.join(names, key)
    refs = rows.select(*found.columns, "name", "domain", F.explode(F.array_distinct(F.concat(F.array(F.lower("name")), F.transform(F.filter(F.coalesce("references", F.array().cast("array<string>")), lambda r: F.length(r) > 0), F.lower)))).alias("_ref"))
    scored = refs.withColumn("_s", partial_ratio("_ref", F.lower("title"))).groupBy(*found.columns, "name", "domain").agg(F.max("_s").alias("similarity"))
    short = F.length(F.regexp_replace("name", "[-_]", "")) <= 5
    terms = F.filter(F.split(F.lower(F.coalesce("domain", F.lit(""))), r"\s+"), lambda t: F.length(t) > 3)
    said = F.lower(F.concat_ws(" ", "title", "abstract"))
    other_field = short & (F.size(terms) > 0) & (F.col("similarity") < 80) & ~F.exists(terms, lambda t: said.contains(t))
    return scored.where((F.col("similarity") >= F.when(short, 65).otherwise(50)) & ~other_field).drop("name", "domain")


def to_verify(found: DataFrame, key: str = "key", most: int = CANDIDATES) -> DataFrame:
    """(…, idx): of candidates with one title the first, of these the first `most` for each key, numbered from 0."""
    order = ["query_no", "source_no", "place"]
    title = strip(F.lower("title"))
    first = found.where(title != "").withColumn("_r", F.row_number().over(Window.partitionBy(key, title).orderBy(*order))).where("_r = 1").drop("_r")
    return first.withColumn("idx", F.row_number().over(Window.partitionBy(key).orderBy(*order)) - 1).where(F.col("idx") < most)


def decided(batch: DataFrame, verdicts: DataFrame, key: str = "key", sure: float = SURE) -> DataFrame:
    """(…, is_match, confidence, reasoning, resolved): verdicts (key, match_index, confidence, reasoning) on the batch.

    `resolved` is the best address of the match, if the verdict is `sure`.
    """
    said = verdicts.select(F.col(key).alias("_k"), "match_index", F.col("confidence").alias("_c"), F.col("reasoning").alias("_why"))
    rows = batch.join(said, F.col(key) == F.col("_k"), "left")
    match = F.coalesce(F.col("match_index") == F.col("idx"), F.lit(False))
    url = best_paper_url("arxiv_id", "doi", "url")
    return rows.select(*batch.columns, match.alias("is_match"), F.when(match, F.col("_c")).otherwise(0.0).alias("confidence"), F.when(match, F.col("_why")).otherwise("").alias("reasoning"), F.when(match & (F.col("_c") >= sure), url).alias("resolved"))


def verification_log(rows: DataFrame, key: str = "key") -> DataFrame:
    """(key, log): the candidates of each key in order and what was decided, as JSON."""
    entry = F.struct("idx", "title", "query", "source", "arxiv_id", "doi", "citations", "year", "similarity", "is_match", "confidence", "reasoning")
    own = rows.groupBy(key).agg(F.array_sort(F.collect_list(entry)).alias("candidates"), F.max("resolved").alias("resolved_url"), F.max(F.when(F.col("resolved").isNotNull(), F.concat("source", F.lit("+batch_verification")))).alias("resolved_from"))
    return own.select(key, F.to_json(F.struct(F.col(key).alias("suite"), "candidates", "resolved_url", "resolved_from"), {"ignoreNullFields": "false"}).alias("log"))


def pdf_url(url: Text) -> Column:
    """The address of the PDF for an arXiv abstract page; others as they are."""
    at = F.regexp_replace(col(url), "/abs/", "/pdf/")
    return F.when(col(url).contains("arxiv.org/abs/"), F.when(at.endswith(".pdf"), at).otherwise(F.concat(at, F.lit(".pdf")))).otherwise(col(url))


def converted(rows: DataFrame, convert: Provider, url: str = "url", text: str = "markdown") -> DataFrame:
    """rows with markdown from a converter (a provider that adds `markdown` for `pdf`), title, and text without references.

    Each address is converted once, whatever number of rows has it.
    """
    pages = convert(rows.select(pdf_url(url).alias("pdf")).where("pdf IS NOT NULL").distinct())
    made = pages.select("pdf", text, markdown_title(text).alias("title"), strip_references(text).alias("text"))
    return rows.withColumn("pdf", pdf_url(url)).join(made, "pdf", "left")


def canonical_ids(rows: DataFrame, resolve: Provider, known: DataFrame | None = None, name: str = "name") -> DataFrame:
    """rows with canonical_id; names in `known` (name, canonical_id) are not asked for again, each other name once."""
    asked = rows.select(F.col(name).alias("name")).where("name IS NOT NULL").distinct()
    new = asked if known is None else asked.join(known, "name", "left_anti")
    ids = resolve(new).select("name", "canonical_id")
    ids = ids if known is None else ids.unionByName(known.select("name", "canonical_id"))
    return rows.join(ids.withColumnRenamed("name", "_n"), F.col(name) == F.col("_n"), "left").drop("_n")


def display_names(rows: DataFrame, look_up: Provider, name: str = "name") -> DataFrame:
    """rows with shown_name: a registry's description before its display name, up to a dash; names are looked up once."""
    found = look_up(rows.select(F.col(name).alias("name")).where("name IS NOT NULL").distinct())
    best = F.coalesce(F.nullif("description", F.lit("")), F.nullif("display_name", F.lit("")))
    shown = found.select(F.col("name").alias("_n"), F.when(best.contains(" — "), strip(F.substring_index(best, " — ", 1))).otherwise(best).alias("shown_name"))
    return rows.join(shown, F.col(name) == F.col("_n"), "left").drop("_n")


def write_log(spark: SparkSession, log: DataFrame, path: str) -> None:
    log.select(F.col("log").alias("value")).write.mode("append").text(path)
