"""Which paper describes a benchmark: tier by tier, each asking only for what the tiers before left open, answers kept.

Tiers, in order: an address that is given, one in the tags or the README, the table of known papers, answers kept from earlier
runs, and last the search services, whose candidates are sifted by title and put before a judge. Names are asked for once, by
their normalised form, however many rows have them.

Kept answers are a Parquet folder to which every run appends one row for each key it asked for, keys without a paper included,
so these are not asked for again. A key of which any search failed, and that has no paper, is not kept: that is no answer. Of
several rows of a key the latest counts, so a job that ran twice does no harm.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.checks import search_queries
from ..functions.names import underscore_name
from ..functions.text import arxiv_url
from ..operators.resolve import first_tier
from ..providers import Provider
from ..sources import papers
from ..storage import materialise, release

FIELDS = ("url", "title", "abstract", "year", "citations", "resolved_from")
ANSWERS = "key string, url string, title string, abstract string, year int, citations bigint, resolved_from string, asked timestamp"
OPTIONAL = {"full_name": "string", "paper_title": "string", "domain": "string", "paper_url": "string", "tags": "array<string>", "readme": "string"}


@dataclass(frozen=True)
class Resolution:
    """The rows with their papers, the log of what was put before the judge, and the tables both still read."""

    rows: DataFrame
    log: DataFrame
    tables: tuple[str, ...]

    def release(self) -> None:
        release(self.rows.sparkSession, *self.tables)


def kept_answers(spark: SparkSession, path: str, stale: Column | None = None) -> DataFrame:
    """(key, fields, asked): the latest kept answer of each key; those that are `stale` are left out, so they are asked again."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], ANSWERS)
    rows = spark.read.schema(ANSWERS).parquet(path)
    last = rows.groupBy("key").agg(F.max_by(F.struct(*rows.columns[1:]), F.struct("asked", "url", "resolved_from")).alias("_a")).select("key", "_a.*")
    return last if stale is None else last.where(~F.coalesce(stale, F.lit(False)))


def _searched(asked: DataFrame, search: Provider, verify: Provider) -> tuple[DataFrame, DataFrame, list[str]]:
    """(answers of the keys asked, log, tables): candidates of all queries, sifted, numbered, judged."""
    queries = asked.select("key", F.posexplode(search_queries("name", "full_name", "paper_title")).alias("query_no", "query"))
    answers, p_answers = materialise(search(queries), "papers-answers")
    errors = F.col("error") if "error" in answers.columns else F.lit(None).cast("string")
    failed = answers.where(errors.isNotNull()).select("key").distinct().withColumn("_failed", F.lit(True))
    found = papers.candidates(answers.where("json IS NOT NULL").drop("error"))
    references = F.filter(F.array("full_name", "paper_title"), lambda r: r.isNotNull())
    # Read as text, a name is its full name, or its words.
    names = asked.select("key", F.coalesce(F.nullif("full_name", F.lit("")), F.translate("name", "_", " ")).alias("name"), references.alias("references"), "domain")
    batch, p_batch = materialise(papers.to_verify(papers.prefiltered(found, names)), "papers-batch")
    judged, p_judged = materialise(papers.decided(batch, verify(batch)), "papers-judged")
    hit = judged.where("resolved IS NOT NULL").select("key", F.col("resolved").alias("url"), "title", "abstract", "year", "citations", F.concat("source", F.lit("+batch_verification")).alias("resolved_from"))
    new = asked.select("key").join(hit, "key", "left").join(failed, "key", "left")
    return new, papers.verification_log(judged), [p_answers, p_batch, p_judged]


def resolve(rows: DataFrame, search: Provider, verify: Provider, kept: str | None = None, stale: Column | None = None, name: str = "name") -> Resolution:
    """rows with url, title, abstract, year, citations and resolved_from ("given", "readme", "known", or the search that found it).

    Of the rows the columns `name`, full_name, paper_title, domain, paper_url, tags and readme are read, all but the first may be
    missing. `search` makes answers (key, query, query_no, source, source_no, place, json, and error where one failed) from
    queries (key, query, query_no); `verify` makes verdicts (key, match_index, confidence, reasoning) on numbered candidates.
    Rows of one name with different details are asked for with the least of them. Rows without a name, or with a blank one, are
    resolved by the first two tiers only. Input columns named like an output are replaced.
    """
    spark = rows.sparkSession
    own = [c for c in rows.columns if c not in FIELDS]
    have = lambda c: F.col(c) if c in rows.columns else F.lit(None).cast(OPTIONAL[c])
    key = F.nullif(underscore_name(name), F.lit(""))
    table = F.create_map(*[F.lit(x) for pair in papers.KNOWN_PAPERS.items() for x in pair])
    url, tier = first_tier([("given", F.nullif(have("paper_url"), F.lit(""))), ("readme", arxiv_url(have("tags"), have("readme"))), ("known", F.try_element_at(table, key))])
    first, p_first = materialise(rows.select(*own, key.alias("_key"), F.col(name).alias("_name"), *[have(c).alias(f"_{c}") for c in ("full_name", "paper_title", "domain")], url.alias("_url"), tier.alias("_from")), "papers-tiers")

    still = first.where("_url IS NULL AND _key IS NOT NULL").groupBy("_key").agg(F.min(F.struct("_name", "_full_name", "_paper_title", "_domain")).alias("_d"))
    still = still.select(F.col("_key").alias("key"), F.col("_d._name").alias("name"), F.col("_d._full_name").alias("full_name"), F.col("_d._paper_title").alias("paper_title"), F.col("_d._domain").alias("domain"))
    # What was kept is copied before this run appends to the folder.
    old, p_old = materialise(kept_answers(spark, kept, stale).join(still.select("key"), "key", "left_semi"), "papers-kept") if kept else (spark.createDataFrame([], ANSWERS), None)
    asked, p_asked = materialise(still.join(old.select("key"), "key", "left_anti"), "papers-asked")
    made, log, tables = _searched(asked, search, verify)
    new, p_new = materialise(made.select("key", *FIELDS, F.current_timestamp().alias("asked"), F.coalesce("_failed", F.lit(False)).alias("_failed")), "papers-new")
    if kept:
        new.where("NOT _failed OR url IS NOT NULL").drop("_failed").write.mode("append").parquet(kept)

    answers = new.drop("_failed", "asked").unionByName(old.drop("asked")).select(F.col("key").alias("_k"), F.struct(*FIELDS).alias("_a"))
    open_ = F.col("_url").isNull()
    joined = first.join(answers, F.col("_key") == F.col("_k"), "left")
    pick = lambda f: F.when(open_, F.col(f"_a.{f}"))
    out = joined.select(*own, F.coalesce("_url", "_a.url").alias("url"), pick("title").alias("title"), pick("abstract").alias("abstract"), pick("year").alias("year"), pick("citations").alias("citations"), F.when(open_, F.col("_a.resolved_from")).otherwise(F.col("_from")).alias("resolved_from"))
    judged, others = tables[-1], tables[:-1]
    release(spark, *others, p_asked)
    return Resolution(out, log, tuple(p for p in (p_first, p_new, p_old, judged) if p))
