"""Named queries over the driver's tables, each with its DuckDB counterpart where SQL can express it.

The tables stand in for the engine's own inputs: events are score facts (benchmark = event_type, model = user, metric from
props), documents the corpus, benchmark the statements, embeddings vectors, labels verdicts, pages web pages.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .functions import artifacts, checks, fuzzy, missing, names, tags, text
from .operators import belief, bm25_index, cards, evaluations, factuality, reports, resolve, retrieval, suites, vector_index
from .plans import composition, evidence, paper_resolution, routing
from .providers import Provider, hashed_vectors, risks, support
from .session import ship
from .sources import files, hub, pages, papers
from .storage import new_path, release
from .streaming import incremental, jobs

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql:
            ORACLE_SQL[name] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


# ---------------------------------------------------------------- evaluation scores

K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
SCORES = f"""scores AS (SELECT event_type AS bench, 'u' || user_id AS model, 'd' || (user_id % 10) AS developer, 'm' || ({K} % 3) AS metric,
 'e' || ({K} % 5) AS evaluation_name, 'f' || (event_id % 7) AS folder, value AS score, event_id AS ord FROM events)"""


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("long")
    return read(spark, sf_dir, "events").select(
        F.col("event_type").alias("bench"),
        F.col("event_type").alias("display_name"),
        F.concat(F.lit("u"), "user_id").alias("model"),
        F.concat(F.lit("d"), F.col("user_id") % 10).alias("developer"),
        F.concat(F.lit("m"), k % 3).alias("metric"),
        F.concat(F.lit("e"), k % 5).alias("evaluation_name"),
        F.concat(F.lit("f"), F.col("event_id") % 7).alias("folder"),
        F.col("value").alias("score"),
        F.col("event_id").alias("ord"),
    )


@query(
    "a4_evaluation_summary",
    f"""WITH {SCORES}, stats AS (SELECT bench, metric, count(*) n, avg(score) mean, coalesce(stddev_samp(score), 0) sd, min(score) least, max(score) greatest, min(ord) fo FROM scores GROUP BY 1, 2),
 pick AS (SELECT *, row_number() OVER (PARTITION BY bench ORDER BY n DESC, fo) r FROM stats),
 lead AS (SELECT *, row_number() OVER (PARTITION BY bench, metric ORDER BY score DESC, ord) rank FROM scores)
 SELECT p.bench, p.metric, p.n, round(p.mean, 4) AS mean, round(p.sd, 4) AS sd, round(p.least, 4) AS least, round(p.greatest, 4) AS greatest,
 (SELECT string_agg(model, ',' ORDER BY rank) FROM lead l WHERE l.bench = p.bench AND l.metric = p.metric AND rank <= 5) AS leaders FROM pick p WHERE r = 1""",
)
def _(spark, sf):
    return evaluations.summary(scores(spark, sf)).withColumn("leaders", F.array_join(F.col("leaders.model"), ","))


@query("w1_leaders", f"WITH {SCORES}, r AS (SELECT bench, metric, model, score, row_number() OVER (PARTITION BY bench, metric ORDER BY score DESC, ord) AS rank FROM scores) SELECT * FROM r WHERE rank <= 5")
def _(spark, sf):
    return evaluations.leaders(scores(spark, sf)).select("bench", "metric", "model", "score", "rank")


@query("a2_average_subjects", f"WITH {SCORES} SELECT bench, model, round(avg(score), 6) AS score, count(*) AS subjects, arg_min(developer, ord) AS developer FROM scores GROUP BY 1, 2 HAVING (SELECT count(DISTINCT evaluation_name) FROM scores s WHERE s.bench = scores.bench) >= 3")
def _(spark, sf):
    return evaluations.average_subjects(scores(spark, sf)).where("subject_scores IS NOT NULL").select("bench", "model", F.round("score", 6).alias("score"), F.size("subject_scores").cast("long").alias("subjects"), "developer")


@query("a1_roll_up", f"WITH {SCORES} SELECT bench, count(*) AS n_scores, count(DISTINCT model) AS num_models, (SELECT string_agg(folder, ',' ORDER BY o) FROM (SELECT folder, min(ord) o FROM scores t WHERE t.bench = s.bench GROUP BY folder)) AS folders, (SELECT string_agg(metric, ',' ORDER BY o) FROM (SELECT metric, min(ord) o FROM scores t WHERE t.bench = s.bench GROUP BY metric)) AS metrics FROM scores s GROUP BY bench")
def _(spark, sf):
    rows = scores(spark, sf).withColumn("urls", F.array().cast("array<string>")).withColumn("hf_repo", F.lit(None).cast("string")).withColumn("source_type", F.lit("other")).withColumn("eval_library", F.lit(None).cast("string"))
    return evaluations.roll_up(rows).select("bench", "n_scores", "num_models", F.array_join("folders", ",").alias("folders"), F.array_join("metrics", ",").alias("metrics"))


@query("a5_suite_statistics", f"WITH {SCORES}, members AS (SELECT DISTINCT folder, bench FROM scores) SELECT m.folder, count(DISTINCT s.model) AS num_models, (SELECT string_agg(x, ',' ORDER BY x) FROM (SELECT DISTINCT t.metric x FROM members n JOIN scores t USING (bench) WHERE n.folder = m.folder)) AS metrics, count(DISTINCT m.bench) AS members FROM members m JOIN scores s USING (bench) GROUP BY m.folder")
def _(spark, sf):
    s = scores(spark, sf)
    return evaluations.suite_statistics(s, s.select("folder", "bench").distinct()).withColumn("metrics", F.array_join("metrics", ","))


@query("j4_appears_in", f"WITH {SCORES} SELECT bench, string_agg(folder, ',' ORDER BY folder) AS suites FROM (SELECT DISTINCT bench, folder FROM scores) GROUP BY bench")
def _(spark, sf):
    return evaluations.appears_in(scores(spark, sf).select("bench", "folder")).withColumn("suites", F.array_join("suites", ","))


@query("p2_suite_filter", "WITH b AS (SELECT DISTINCT p_brand || ' ' || p_size AS bench, p_brand AS folder FROM part) SELECT DISTINCT bench FROM b WHERE lower(bench) = lower('brand#11 7') OR folder = 'Brand#22'")
def _(spark, sf):
    b = read(spark, sf, "part").select(F.concat("p_brand", F.lit(" "), "p_size").alias("bench"), F.col("p_brand").alias("folder")).distinct()
    return evaluations.filtered(b.select("bench", F.col("bench").alias("name")), b.select("folder", "bench"), ["brand#11 7", "BRAND#22"]).select("bench")


@query(
    "t33_baseline_sentence",
    f"""WITH {SCORES}, stats AS (SELECT bench, metric, count(*) n, round(avg(score), 4) mean, round(coalesce(stddev_samp(score), 0), 4) sd, min(ord) fo FROM scores GROUP BY 1, 2),
 pick AS (SELECT *, row_number() OVER (PARTITION BY bench ORDER BY n DESC, fo) r FROM stats),
 lead AS (SELECT *, row_number() OVER (PARTITION BY bench, metric ORDER BY score DESC, ord) rank FROM scores)
 SELECT p.bench, printf('Based on %d model evaluations: mean %s = %.4f (std = %.4f). Top performers: ', p.n, p.metric, p.mean, p.sd) || (SELECT string_agg(l.model || printf(' (%.4f)', l.score), ', ' ORDER BY rank) FROM lead l WHERE l.bench = p.bench AND l.metric = p.metric AND rank <= 3) || '.' AS sentence FROM pick p WHERE r = 1""",
)
def _(spark, sf):
    return evaluations.baseline_sentence(evaluations.summary(scores(spark, sf)))


@query("a19_f3_collapse_votes")
def _(spark, sf):
    parts = read(spark, sf, "part").select(F.col("p_brand").alias("folder"), names.normalize_name("p_name").alias("bench"), F.col("p_partkey").alias("pos"), F.array(F.concat(F.lit("u"), F.col("p_size") % 2)).alias("urls"), F.col("p_type").alias("hf_repo"))
    return evaluations.collapse_votes(parts).select("folder", "members", "least_name", "greatest_name", F.round("similarity", 6).alias("similarity"), "same_prefix", "same_url", "same_repo", "similar", "signals", "collapse", "merged_name")


@query("w2_first_files", "SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) r FROM documents) WHERE r <= 50")
def _(spark, sf):
    return retrieval.ranked(read(spark, sf, "documents").select("source", "doc_id"), "source", [F.col("doc_id")], 50).drop("rank")


# ---------------------------------------------------------------- names and text


@query("f1_names", "SELECT p_partkey, translate(lower(regexp_replace(p_name, '^\\s+|\\s+$', '', 'g')), '_ ', '--') AS key, translate(lower(regexp_replace(p_name, '^\\s+|\\s+$', '', 'g')), '- ', '__') AS other FROM part")
def _(spark, sf):
    return read(spark, sf, "part").select("p_partkey", names.normalize_name("p_name").alias("key"), names.underscore_name("p_name").alias("other"))


@query("t8_slug", "SELECT page_id, regexp_replace(regexp_replace(lower(url), '[^a-z0-9.]+', '-', 'g'), '^-+|-+$', '', 'g') AS slug FROM pages")
def _(spark, sf):
    return read(spark, sf, "pages").select("page_id", names.slug("url").alias("slug"))


@query("t45_output_key", "SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_mktsegment ELSE regexp_replace(regexp_replace(lower(c_name), '[^a-z0-9.]+', '-', 'g'), '^-+|-+$', '', 'g') END AS key FROM customer")
def _(spark, sf):
    return read(spark, sf, "customer").select("c_custkey", names.output_key(F.when(F.col("c_custkey") % 3 == 0, F.col("c_mktsegment")), "c_name").alias("key"))


@query("t32_suite_name")
def _(spark, sf):
    grouped = read(spark, sf, "part").groupBy("p_brand").agg(F.min(names.normalize_name("p_name")).alias("a"), F.max(names.normalize_name("p_name")).alias("b"))
    return grouped.select("p_brand", names.suite_name(F.lower("p_brand"), "a", "b").alias("name"), names.common_prefix("a", "b").alias("prefix"))


@query("t34_duration", "SELECT o_orderkey, CASE WHEN s < 60 THEN printf('%.1fs', s) WHEN s < 3600 THEN printf('%dm %ds', CAST(floor(s / 60) AS BIGINT), CAST(floor(s) AS BIGINT) % 60) ELSE printf('%dh %dm', CAST(floor(s / 3600) AS BIGINT), CAST(floor((CAST(floor(s) AS BIGINT) % 3600) / 60) AS BIGINT)) END AS took FROM (SELECT o_orderkey, o_totalprice / 20 AS s FROM orders)")
def _(spark, sf):
    return read(spark, sf, "orders").select("o_orderkey", names.duration(F.col("o_totalprice") / 20).alias("took"))


@query("t1_tokens", "SELECT doc_id, len(w) AS n_tokens, len(list_distinct(w)) AS n_distinct FROM (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+') w FROM documents)")
def _(spark, sf):
    return read(spark, sf, "documents").select("doc_id", F.size(text.tokens("text")).cast("long").alias("n_tokens"), F.size(F.array_distinct(text.tokens("text"))).cast("long").alias("n_distinct"))


TAGGED = "'language:' || lang || ' format: csv task_ids: qa ' || text"


@query("t6_expand_tags", f"SELECT doc_id, md5(replace(replace(replace(replace(replace(replace({TAGGED}, 'language:en format', 'language: English format'), 'language:de format', 'language: German format'), 'language:fr format', 'language: French format'), 'language:es format', 'language: Spanish format'), 'format: csv task_ids', 'data format: CSV task_ids'), 'task_ids: qa', 'task: qa')) AS words FROM documents")
def _(spark, sf):
    line = F.concat(F.lit("language:"), "lang", F.lit(" format: csv task_ids: qa "), "text")
    return read(spark, sf, "documents").select("doc_id", F.md5(text.expand_tags(line)).alias("words"))


@query("t7_strip_references")
def _(spark, sf):
    docs = read(spark, sf, "documents")
    cited = F.concat(F.col("text"), F.lit(" as shown [1, 2] and (3)."), F.when(F.col("doc_id") % 2 == 0, F.lit("\nReferences\n[1] A. Author. A title.\n")).otherwise(""))
    return docs.select("doc_id", F.md5(text.strip_references(cited)).alias("md5"), F.length(text.strip_references(cited)).alias("n"))


@query("t5_keywords")
def _(spark, sf):
    return read(spark, sf, "benchmark").select("item_id", F.array_join(text.keywords("text"), "|").alias("keywords"))


@query("t9_arxiv_url", "SELECT page_id, CASE WHEN page_id % 4 = 0 THEN 'https://arxiv.org/abs/2001.' || lpad(CAST(page_id AS VARCHAR), 5, '0') WHEN page_id % 4 = 1 THEN url WHEN page_id % 4 = 2 THEN 'https://arxiv.org/abs/1905.' || lpad(CAST(page_id AS VARCHAR), 5, '0') END AS paper FROM pages")
def _(spark, sf):
    p = F.lpad(F.col("page_id").cast("string"), 5, "0")
    k = F.col("page_id") % 4
    tag = F.when(k == 0, F.array(F.lit("language:en"), F.concat(F.lit("arxiv:2001."), p))).otherwise(F.array(F.lit("language:en")))
    readme = F.when(k == 1, F.concat(F.lit("**Paper**: "), F.col("url"))).when(k == 2, F.concat(F.lit("```bibtex\n@misc{a, eprint={arXiv:1905."), p, F.lit("}}\n```"))).otherwise("nothing")
    return read(spark, sf, "pages").select("page_id", text.arxiv_url(tag, readme).alias("paper"))


@query("p4_url_kinds", "SELECT page_id, lower(url) LIKE '%.pdf' OR contains(lower(url), 'arxiv.org') AS is_pdf, lower(url) LIKE 'http%' AND NOT contains(lower(url), 'arxiv.org') AND NOT (lower(url) LIKE '%.pdf' OR lower(url) LIKE '%.json' OR lower(url) LIKE '%.jsonl') AS is_html FROM (SELECT page_id, url || CASE page_id % 4 WHEN 0 THEN '.pdf' WHEN 1 THEN '/x.json' ELSE '' END AS url FROM pages)")
def _(spark, sf):
    u = F.concat("url", F.when(F.col("page_id") % 4 == 0, ".pdf").when(F.col("page_id") % 4 == 1, "/x.json").otherwise(""))
    return read(spark, sf, "pages").select("page_id", text.is_pdf_url(u).alias("is_pdf"), text.is_html_url(u).alias("is_html"))


@query("p9_paper_url", "SELECT page_id, CASE WHEN page_id % 3 = 0 THEN NULL WHEN page_id % 3 = 1 THEN 'https://aclanthology.org/' || page_id || '.pdf' ELSE url END AS paper FROM pages")
def _(spark, sf):
    k = F.col("page_id") % 3
    u = F.when(k == 0, F.concat(F.lit("https://www.semanticscholar.org/"), "page_id")).when(k == 1, F.concat(F.lit("https://aclanthology.org/"), "page_id", F.lit("/"))).otherwise(F.col("url"))
    return read(spark, sf, "pages").select("page_id", text.paper_url(u).alias("paper"))


@query("t12_html_title", "SELECT page_id, trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '\\s+', ' ', 'g')) AS title FROM pages")
def _(spark, sf):
    return read(spark, sf, "pages").select("page_id", text.html_title("html", "url").alias("title"))


@query("t25_best_paper_url", "SELECT item_id, CASE item_id % 3 WHEN 0 THEN 'https://arxiv.org/abs/a' || item_id WHEN 1 THEN 'https://doi.org/10.1/' || item_id ELSE 'https://x.org/' || item_id END AS best FROM benchmark")
def _(spark, sf):
    k = F.col("item_id") % 3
    return read(spark, sf, "benchmark").select("item_id", text.best_paper_url(F.when(k == 0, F.concat(F.lit("a"), "item_id")), F.when(k < 2, F.concat(F.lit("10.1/"), "item_id")), F.concat(F.lit("https://x.org/"), "item_id")).alias("best"))


LINE_TAGS = "['language:' || ['en', 'de', 'xx'][l_linenumber % 3 + 1], 'language:' || ['fr', 'de'][l_suppkey % 2 + 1], 'license:other', 'license:' || ['mit', 'own', 'unknown'][l_orderkey % 3 + 1], 'size_categories:' || ['n<1K', '1K<n<10K', 'odd'][l_partkey % 3 + 1], 'task_ids:question-answering', 'task_categories:' || ['a_b', 'question-answering'][l_linenumber % 2 + 1], 'modality:' || ['Text', 'image'][l_suppkey % 2 + 1], 'broken']"


@query(
    "t10_tag_fields",
    f"""WITH l AS (SELECT *, row_number() OVER () AS rid FROM lineitem), t AS (SELECT rid, l_orderkey, l_linenumber, unnest({LINE_TAGS}) AS tag, unnest(range(9)) AS i FROM l), p AS (SELECT rid, l_orderkey, l_linenumber, split_part(tag, ':', 1) AS k, substr(tag, instr(tag, ':') + 1) AS v, i FROM t WHERE contains(tag, ':')),
 v AS (SELECT *, CASE k WHEN 'language' THEN CASE v WHEN 'en' THEN 'English' WHEN 'de' THEN 'German' WHEN 'fr' THEN 'French' ELSE v END WHEN 'license' THEN CASE v WHEN 'mit' THEN 'MIT License' ELSE v END WHEN 'size_categories' THEN CASE v WHEN 'n<1K' THEN 'Less than 1K examples' WHEN '1K<n<10K' THEN '1K to 10K examples' ELSE v END ELSE v END AS w FROM p)
 SELECT l_orderkey, l_linenumber, string_agg(DISTINCT w, ', ' ORDER BY w) FILTER (k = 'language') AS languages, arg_max(w, i) FILTER (k = 'license' AND v NOT IN ('other', 'unknown')) AS license, arg_max(w, i) FILTER (k = 'size_categories') AS size, string_agg(DISTINCT upper(replace(replace(v, '-', ' '), '_', ' ')[1]) || substr(replace(replace(v, '-', ' '), '_', ' '), 2), ', ' ORDER BY upper(replace(replace(v, '-', ' '), '_', ' ')[1]) || substr(replace(replace(v, '-', ' '), '_', ' '), 2)) FILTER (k IN ('task_ids', 'task_categories')) AS tasks, lower(string_agg(v, ', ') FILTER (k = 'modality')) AS data_type FROM v GROUP BY rid, l_orderkey, l_linenumber""",
)
def _(spark, sf):
    at = lambda values, c, n: F.get(F.array(*map(F.lit, values)), (F.col(c) % n).cast("int"))
    tag = lambda k, v: F.concat(F.lit(f"{k}:"), v)
    made = F.array(tag("language", at(["en", "de", "xx"], "l_linenumber", 3)), tag("language", at(["fr", "de"], "l_suppkey", 2)), F.lit("license:other"), tag("license", at(["mit", "own", "unknown"], "l_orderkey", 3)), tag("size_categories", at(["n<1K", "1K<n<10K", "odd"], "l_partkey", 3)), F.lit("task_ids:question-answering"), tag("task_categories", at(["a_b", "question-answering"], "l_linenumber", 2)), tag("modality", at(["Text", "image"], "l_suppkey", 2)), F.lit("broken"))
    rows = read(spark, sf, "lineitem").select(F.struct("l_orderkey", "l_linenumber").alias("k"), made.alias("tags"))
    out = tags.tag_fields(rows, "k")
    return out.select("k.l_orderkey", "k.l_linenumber", F.array_join("languages", ", ").alias("languages"), "license", "size", F.array_join("tasks", ", ").alias("tasks"), "data_type")


@query("t11_first_tags", "SELECT l_orderkey, l_linenumber, ['en', 'de', 'xx'][l_linenumber % 3 + 1] || ',' || ['fr', 'de'][l_suppkey % 2 + 1] AS codes, 'other' AS license, ['n<1K', '1K<n<10K', 'odd'][l_partkey % 3 + 1] AS size FROM lineitem")
def _(spark, sf):
    at = lambda values, c, n: F.get(F.array(*map(F.lit, values)), (F.col(c) % n).cast("int"))
    tag = lambda k, v: F.concat(F.lit(f"{k}:"), v)
    rows = read(spark, sf, "lineitem").select(F.struct("l_orderkey", "l_linenumber").alias("k"), F.array(tag("language", at(["en", "de", "xx"], "l_linenumber", 3)), tag("language", at(["fr", "de"], "l_suppkey", 2)), F.lit("license:other"), F.lit("license:mit"), tag("size_categories", at(["n<1K", "1K<n<10K", "odd"], "l_partkey", 3)), F.lit("size_categories:last")).alias("tags"))
    back = F.create_map(*[F.lit(x) for code, name in tags.LANGUAGES.items() for x in (name, code)])
    out = tags.first_tag_facts(rows, "k")
    return out.select("k.l_orderkey", "k.l_linenumber", F.array_join(F.transform("languages", lambda v: F.coalesce(F.element_at(back, v), v)), ",").alias("codes"), F.col("data_licensing").alias("license"), F.col("size_category").alias("size"))


@query("t38_description", "SELECT doc_id, substr(regexp_replace(split_part(regexp_replace(text, '^\\s+|\\s+$', '', 'g'), chr(10), 1), '^\\s+|\\s+$', '', 'g'), 1, 280) AS d FROM documents")
def _(spark, sf):
    return read(spark, sf, "documents").select("doc_id", text.description("text").alias("d"))


@query("t39_md5", "SELECT doc_id, md5(text) AS key FROM documents")
def _(spark, sf):
    return read(spark, sf, "documents").select("doc_id", F.md5("text").alias("key"))


@query("t24_abstract", "SELECT item_id, md5(array_to_string(regexp_split_to_array(text, '\\s+'), ' ')) AS md5 FROM benchmark")
def _(spark, sf):
    words = read(spark, sf, "benchmark").select("item_id", F.posexplode(F.split("text", r"\s+")).alias("p", "w")).groupBy("item_id", "w").agg(F.collect_list("p").alias("ps")).groupBy("item_id").agg(F.map_from_entries(F.collect_list(F.struct("w", "ps"))).alias("i"))
    return words.select("item_id", F.md5(text.abstract_from_index("i")).alias("md5"))


@query("t21_t22_model_output", "SELECT item_id, CAST(item_id % 10 AS DOUBLE) + 2.5 AS total FROM benchmark")
def _(spark, sf):
    raw = F.concat(F.lit("<think>[9]\nhm</think> scores: ["), (F.col("item_id") % 10).cast("string"), F.lit(", 2.5, \"x\"] done"))
    return read(spark, sf, "benchmark").select("item_id", F.aggregate(text.json_array(text.strip_thinking(raw)), F.lit(0.0), lambda a, b: a + b).alias("total"))


MAYBE = "CASE s_suppkey % 6 WHEN 0 THEN ' Not Specified. ' WHEN 1 THEN chr(9) || 'no information found' || chr(10) WHEN 2 THEN NULL WHEN 3 THEN s_name WHEN 4 THEN 'not specified, ' || s_name ELSE '' END"


@query("p3_missing", f"SELECT s_suppkey, coalesce(lower(regexp_replace({MAYBE}, '^\\s+|\\s+$', '', 'g')) IN ('not specified', 'not specified.', 'no information found', 'no information found.'), false) AS missing, coalesce(lower(regexp_replace({MAYBE}, '^\\s+|\\s+$', '', 'g')) IN ('not specified', 'not specified.', 'no information found', ''), false) AS overridable FROM supplier")
def _(spark, sf):
    k = F.col("s_suppkey") % 6
    v = F.when(k == 0, " Not Specified. ").when(k == 1, "\tno information found\n").when(k == 3, F.col("s_name")).when(k == 4, F.concat(F.lit("not specified, "), "s_name")).when(k == 5, "")
    return read(spark, sf, "supplier").select("s_suppkey", missing.is_missing(v).alias("missing"), missing.is_missing(v, "override").alias("overridable"))


@query("w5_carried_heading", "SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN regexp_replace(text, '^\\s+|\\s+$', '', 'g') END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS heading FROM conversations")
def _(spark, sf):
    lines = read(spark, sf, "conversations").withColumn("line", F.when(F.col("role") == "user", F.concat(F.lit("## "), "text")).otherwise(F.concat(F.lit("- "), "text")))
    return cards.carried_heading(lines, "conv_id", "turn").select("conv_id", "turn", "heading")


@query("w4_neighbours", "SELECT conv_id, turn FROM (SELECT conv_id, turn, max(CASE WHEN contains(lower(text), 'er') AND role = 'system' THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN 1 PRECEDING AND 1 FOLLOWING) AS near FROM conversations) WHERE near = 1")
def _(spark, sf):
    hit = (F.lower("text").contains("er") & (F.col("role") == "system")).cast("int")
    return reports.near_hits(read(spark, sf, "conversations"), "conv_id", "turn", hit).select("conv_id", "turn")


# ---------------------------------------------------------------- retrieval


@query("t3_chunks", "SELECT doc_id, CAST(i AS INTEGER) AS chunk, substr(text, CAST(i * 800 + 1 AS INTEGER), 1000) AS chunk_text FROM (SELECT doc_id, text, unnest(generate_series(0, greatest(1, CAST(ceil((length(text) - 200) / 800.0) AS BIGINT)) - 1)) AS i FROM documents)")
def _(spark, sf):
    return retrieval.stride_chunks(read(spark, sf, "documents").select("doc_id", "text"), 1000, 200).select("doc_id", "chunk", "chunk_text")


@query("t2_recursive_chunks")
def _(spark, sf):
    return retrieval.recursive_chunks(read(spark, sf, "documents"), "doc_id").select("doc_id", "parent_idx", "child_idx", "text")


@query(
    "f5_bm25",
    """WITH w AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+') l FROM documents), d AS (SELECT doc_id, len(l) dl FROM w), p AS (SELECT doc_id, unnest(l) term FROM w),
 tf AS (SELECT doc_id, term, count(*) tf FROM p GROUP BY 1, 2), df AS (SELECT term, count(*) df FROM tf GROUP BY 1), c AS (SELECT count(*) n, avg(dl) a FROM d),
 q AS (SELECT item_id, term, count(*) times FROM (SELECT item_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+')) term FROM benchmark) GROUP BY 1, 2),
 s AS (SELECT item_id, doc_id, sum(times * ln((n - df + 0.5) / (df + 0.5)) * tf * 2.5 / (tf + 1.5 * (0.25 + 0.75 * dl / a))) score FROM q JOIN tf USING (term) JOIN df USING (term) JOIN d USING (doc_id), c GROUP BY 1, 2),
 r AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY round(score, 9) DESC, doc_id) AS rank FROM s) SELECT item_id, doc_id, round(score, 6) AS score FROM r WHERE rank <= 15 AND score > 0""",
)
def _(spark, sf):
    hits = retrieval.bm25(read(spark, sf, "documents"), read(spark, sf, "benchmark"))
    return hits.select("item_id", "doc_id", F.round("score", 6).alias("score"))


@query("l1_bm25_index", ORACLE_SQL["f5_bm25"])
def _(spark, sf):
    """The documents in two batches of a new index, searched for the benchmark's items."""
    docs, path = read(spark, sf, "documents"), new_path(spark, "bm25-index")
    for half in (0, 1):
        bm25_index.add(docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == half), path)
    hits = bm25_index.search(spark, path, read(spark, sf, "benchmark"))
    release(spark, path)
    return hits.select("item_id", "doc_id", F.round("score", 6).alias("score"))


@query("a6_document_frequency", "SELECT term, count(*) AS df FROM (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+')) term FROM documents) GROUP BY term")
def _(spark, sf):
    return retrieval.postings(read(spark, sf, "documents"), "doc_id").groupBy("term").agg(F.count("*").alias("df"))


@query("f6_dense_search", "WITH s AS (SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(CAST(q.embedding AS DOUBLE[]), CAST(v.embedding AS DOUBLE[])) score FROM embeddings q, embeddings v WHERE q.vec_id % 100 = 0), r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) SELECT query_id, vec_id, rank, round(score, 4) AS score FROM r WHERE rank <= 15")
def _(spark, sf):
    v = read(spark, sf, "embeddings")
    q = v.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    return retrieval.dense_search(v, q).select("query_id", "vec_id", "rank", F.round("score", 4).alias("score"))


def vector_hits(spark: SparkSession, sf_dir: str, **how) -> DataFrame:
    v, path = read(spark, sf_dir, "embeddings"), new_path(spark, "vector-index")
    vector_index.build(v, path)
    hits = vector_index.search(spark, path, v.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "embedding"), **how)
    release(spark, path)
    return hits.select("query_id", "vec_id", "rank", F.round("score", 4).alias("score"))


@query("x3_vector_index", ORACLE_SQL["f6_dense_search"])
def _(spark, sf):
    return vector_hits(spark, sf, exact=True)


@query("x3_vector_probe")
def _(spark, sf):
    return vector_hits(spark, sf)


@query("l2_mmr")
def _(spark, sf):
    v = read(spark, sf, "embeddings")
    q = v.where("vec_id % 100 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    near = retrieval.dense_search(v, q, top=23)
    return retrieval.mmr(near.join(v, "vec_id"), "query_id", "vec_id", 9)


@query("f7_keyword_hits", "SELECT doc_id FROM documents WHERE contains(lower(text), 'idiot') OR contains(lower(text), 'licensed')")
def _(spark, sf):
    return retrieval.keyword_hits(read(spark, sf, "documents"), F.array(F.lit("Idiot"), F.lit("licensed"))).select("doc_id")


@query("w3_first_of_equals", "SELECT doc_id FROM (SELECT doc_id, row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) r FROM documents) WHERE r = 1")
def _(spark, sf):
    d = read(spark, sf, "documents").select("doc_id", F.md5("text").alias("h"))
    return reports.first_of_equals(d, F.col("h"), "doc_id").select("doc_id")


@query("u1_fuse", "WITH c AS (SELECT source q, md5(text) h, doc_id, doc_id % 3 prio FROM documents), f AS (SELECT *, row_number() OVER (PARTITION BY q, h ORDER BY prio, doc_id) r FROM c), p AS (SELECT q, doc_id, row_number() OVER (PARTITION BY q ORDER BY prio, doc_id) AS place FROM f WHERE r = 1) SELECT q, doc_id, place FROM p WHERE place <= 20")
def _(spark, sf):
    d = read(spark, sf, "documents").select(F.col("source").alias("q"), "text", "doc_id", F.col("doc_id").alias("rank"))
    return retrieval.fuse([d.where(f"doc_id % 3 = {i}") for i in range(3)], "q", "text").select("q", "doc_id", "place")


@query("f8_grade")
def _(spark, sf):
    d = read(spark, sf, "conversations").select("conv_id", "turn", "text")
    return retrieval.grade(d, "conv_id", "turn").select("conv_id", "turn")


@query("l4_rerank", "WITH c AS (SELECT source q, doc_id, CAST(doc_id % 11 AS DOUBLE) s, row_number() OVER (PARTITION BY source ORDER BY doc_id) place FROM documents), r AS (SELECT q, doc_id, s, row_number() OVER (PARTITION BY q ORDER BY s DESC, place) AS rank FROM c WHERE place <= 10 AND s >= 6) SELECT * FROM r WHERE rank <= 3")
def _(spark, sf):
    d = read(spark, sf, "documents").select(F.col("source").alias("q"), "doc_id", (F.col("doc_id") % 11).cast("double").alias("s")).withColumn("place", F.row_number().over(Window.partitionBy("q").orderBy("doc_id")))
    return retrieval.rerank(d, "q", "s").select("q", "doc_id", "s", "rank")


@query("w6_budget", "WITH c AS (SELECT source, doc_id, length(text) n, sum(length(text)) OVER (PARTITION BY source ORDER BY doc_id) t FROM documents) SELECT source, doc_id, CAST(CASE WHEN t <= 25000 THEN n ELSE 25000 - (t - n) END AS BIGINT) AS n FROM c WHERE t <= 25000 OR (t - n < 25000 AND 25000 - (t - n) > 100)")
def _(spark, sf):
    return retrieval.budget(read(spark, sf, "documents").select("source", "doc_id", "text"), "source", "doc_id").select("source", "doc_id", F.length("text").cast("long").alias("n"))


# ---------------------------------------------------------------- factuality

ATOMS = "atoms AS (SELECT doc_id, 'd' || doc_id AS atom_id, 'data.' || source AS field, CASE WHEN doc_id % 11 = 0 THEN NULL WHEN doc_id % 7 = 0 THEN 0.5 ELSE CAST((doc_id * 37) % 101 AS DOUBLE) / 100 END AS p_true FROM documents)"
LABEL = "CASE WHEN p_true IS NULL THEN 'NO_SCORE' WHEN p_true > 0.8 THEN 'HIGH_CONFIDENCE_CORRECT' WHEN p_true > 0.6 THEN 'LIKELY_CORRECT' WHEN p_true >= 0.4 THEN 'UNCERTAIN' WHEN p_true >= 0.2 THEN 'LIKELY_INCORRECT' ELSE 'HIGH_CONFIDENCE_INCORRECT' END"
FIELDS = f"{ATOMS}, fields AS (SELECT field, count(*) AS total_atoms, count(*) FILTER (p_true > 0.8) AS c1, count(*) FILTER (p_true > 0.6 AND p_true <= 0.8) AS c2, count(*) FILTER (p_true >= 0.4 AND p_true <= 0.6) AS c3, count(*) FILTER (p_true >= 0.2 AND p_true < 0.4) AS c4, count(*) FILTER (p_true < 0.2) AS c5, count(*) FILTER (p_true = 0.5) AS neutral_count, avg(p_true) FILTER (p_true <> 0.5) AS m FROM atoms WHERE p_true IS NOT NULL GROUP BY field)"


def atoms(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    p = F.when(d % 11 == 0, F.lit(None)).when(d % 7 == 0, 0.5).otherwise(((d * 37) % 101).cast("double") / 100)
    return read(spark, sf_dir, "documents").select(F.concat(F.lit("d"), d).alias("atom_id"), F.concat(F.lit("data."), "source").alias("field"), p.alias("p_true"), "text", "doc_id")


@query("a9_field_factuality", f"WITH {FIELDS} SELECT field, total_atoms, c1 AS high_confidence_correct, c2 AS likely_correct, c3 AS uncertain, c4 AS likely_incorrect, c5 AS high_confidence_incorrect, neutral_count, m IS NULL AS all_neutral, round(coalesce(m, 0.5), 6) AS avg_probability, round((c1 + c2) * 100.0 / total_atoms, 6) AS accuracy_percentage, round((c4 + c5) * 100.0 / total_atoms, 6) AS error_percentage FROM fields")
def _(spark, sf):
    out = factuality.by_field(atoms(spark, sf))
    return out.withColumns({c: F.round(c, 6) for c in ("avg_probability", "accuracy_percentage", "error_percentage")})


@query("a10_extremes", f"WITH {FIELDS}, a AS (SELECT *, (c1 + c2) * 100.0 / total_atoms acc, c4 + c5 err FROM fields) SELECT count(*) AS total_fields, count(*) FILTER (err > 0) AS fields_with_errors, (SELECT field FROM a ORDER BY acc DESC, field LIMIT 1) AS most_accurate_field, (SELECT field FROM a ORDER BY acc, field LIMIT 1) AS most_problematic_field FROM a")
def _(spark, sf):
    return factuality.extremes(factuality.by_field(atoms(spark, sf)))


@query("a11_entropy", f"WITH {ATOMS}, p AS (SELECT field, greatest(1e-7, least(1 - 1e-7, p_true)) p FROM atoms WHERE p_true IS NOT NULL), e AS (SELECT field, count(*) n, sum(-p * log10(p) - (1 - p) * log10(1 - p)) h FROM p GROUP BY field) SELECT field, n, round(h, 6) AS entropy, round(h / n, 6) AS mean_entropy, round(CASE WHEN n > 1 THEN h / n / log10(n) ELSE 0 END, 6) AS scaled_entropy FROM e")
def _(spark, sf):
    out = factuality.entropy(atoms(spark, sf), ["field"])
    return out.withColumns({c: F.round(c, 6) for c in ("entropy", "mean_entropy", "scaled_entropy")})


@query("c5_flags", f"WITH {FIELDS} SELECT field, CASE WHEN m IS NULL THEN 'all_atoms_neutral' ELSE 'low_factuality_score' END AS reason FROM fields WHERE (coalesce(m, 0.5) < 0.8 OR m IS NULL) AND field NOT IN ('data.src1', 'data.src2')")
def _(spark, sf):
    proof = spark.createDataFrame([("data.src1", "PAPER", "said"), ("data.src2", "HTML", "said"), ("data.src3", "", "said")], "field string, source string, evidence string")
    return factuality.flags(factuality.by_field(atoms(spark, sf)), proof).select("field", "reason")


@query("c7_l5_atom_summary", f"WITH {ATOMS} SELECT atom_id, field, p_true, {LABEL} AS label FROM atoms")
def _(spark, sf):
    return factuality.atom_summary(atoms(spark, sf))


@query("j2_match_exact", "SELECT 'd' || d.doc_id AS atom_id, CAST(l.quality AS DOUBLE) AS p_true FROM documents d LEFT JOIN labels l USING (doc_id)")
def _(spark, sf):
    marginals = read(spark, sf, "labels").select(F.concat(F.lit("d"), "doc_id").alias("variable"), F.col("quality").cast("double").alias("p_true"), F.col("doc_id").alias("ord"))
    return factuality.match(atoms(spark, sf).drop("p_true"), marginals).select("atom_id", "p_true")


@query("j2_match_compat", "SELECT a.atom_id, (SELECT v.p FROM (SELECT 'v' || doc_id // 2 || '_x' AS name, arg_max(CAST(toxic AS DOUBLE) + quality / 4.0, doc_id) p, min(doc_id) o FROM labels GROUP BY 1) v WHERE contains(v.name, a.atom_id) ORDER BY o LIMIT 1) AS p_true FROM (SELECT 'v' || item_id // 2 AS atom_id FROM benchmark) a")
def _(spark, sf):
    half = lambda c: F.floor(F.col(c) / 2)
    marginals = read(spark, sf, "labels").select(F.concat(F.lit("v"), half("doc_id"), F.lit("_x")).alias("variable"), (F.col("toxic") + F.col("quality") / 4.0).alias("p_true"), F.col("doc_id").alias("ord"))
    a = read(spark, sf, "benchmark").select(F.concat(F.lit("v"), half("item_id")).alias("atom_id"), "text", F.lit("data.size").alias("field"))
    return factuality.match(a, marginals, "compat").select("atom_id", "p_true")


@query(
    "x4_marginals",
    """WITH r AS (SELECT doc_id, CASE WHEN x.kind = 'q' THEN CASE WHEN quality = 1 THEN 'entailment' WHEN quality = 0 THEN 'contradiction' ELSE 'neutral' END ELSE CASE WHEN toxic = 1 THEN 'contradiction' ELSE 'equivalence' END END AS kind, 0.6 + (doc_id % 4) / 10.0 AS p, 0.95 AS q FROM labels, (VALUES ('q'), ('t')) x(kind)),
 s AS (SELECT doc_id, sum(CASE kind WHEN 'entailment' THEN ln(p / (p * (1 - q) + (1 - p) * q)) WHEN 'contradiction' THEN ln((p * (1 - q) + (1 - p) * q) / p) WHEN 'equivalence' THEN ln(((1 - p) * (1 - q) + p * q) / (p * (1 - q) + (1 - p) * q)) ELSE 0 END) AS o FROM r GROUP BY doc_id)
 SELECT doc_id, round(1 / (1 + exp(-coalesce(o, 0))), 6) AS p_true FROM documents LEFT JOIN s USING (doc_id)""",
)
def _(spark, sf):
    """Each document is a statement; its labels are two contexts that speak for it or against it."""
    said = read(spark, sf, "labels").select("doc_id", (0.6 + (F.col("doc_id") % 4) / 10).alias("p"), F.when(F.col("quality") == 1, "entailment").when(F.col("quality") == 0, "contradiction").otherwise("neutral").alias("q"), F.when(F.col("toxic") == 1, "contradiction").otherwise("equivalence").alias("t"))
    docs = read(spark, sf, "documents").select("doc_id", F.concat(F.lit("a"), "doc_id").alias("variable"))
    name = lambda c: F.concat(F.lit(f"c{c}"), "doc_id")
    relations = [said.select(name(c).alias("source"), F.concat(F.lit("a"), "doc_id").alias("target"), F.col(c).alias("kind"), "p") for c in ("q", "t")]
    contexts = [said.select(name(c).alias("variable"), F.lit(0.95).alias("prior")) for c in ("q", "t")]
    variables = docs.select("variable", F.lit(0.5).alias("prior")).unionByName(contexts[0]).unionByName(contexts[1])
    out = belief.marginals(variables, relations[0].unionByName(relations[1]))
    return docs.join(out, "variable").select("doc_id", F.round("p_true", 6).alias("p_true"))


@query("a12_flag_counters", f"WITH {ATOMS} SELECT count(*) FILTER (p_true < 0.3) AS low, count(*) FILTER (p_true < 0.3 OR p_true = 0.5) AS low_or_neutral FROM atoms")
def _(spark, sf):
    return reports.flag_counters(atoms(spark, sf))


# ---------------------------------------------------------------- cards


def card(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("s_suppkey") % 4
    v = F.when(k == 0, F.array(F.lit("Not specified"))).when(k == 1, F.array("s_name", "s_name")).when(k == 2, F.array().cast("array<string>")).otherwise(F.array(F.col("s_acctbal").cast("string")))
    field = F.when(F.col("s_suppkey") % 2 == 0, "languages").otherwise("size")
    return read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("card_id"), F.lit("benchmark_details").alias("section"), field.alias("field"), v.alias("value"), (k == 1).alias("is_list"))


@query("c1_merge_facts", "WITH f AS (SELECT n_regionkey AS card_id, 'data' AS section, 'size' AS field, CASE n_nationkey % 3 WHEN 0 THEN 'EEE' WHEN 1 THEN 'PAPER' ELSE 'HTML' END AS source, CASE WHEN n_nationkey % 5 = 1 THEN 'not specified' ELSE n_name END AS value FROM nation), r AS (SELECT *, row_number() OVER (PARTITION BY card_id ORDER BY CASE source WHEN 'PAPER' THEN 2 WHEN 'HTML' THEN 3 ELSE 5 END, value) r FROM f WHERE value <> 'not specified') SELECT card_id, section, field, source, value FROM r WHERE r = 1")
def _(spark, sf):
    k = F.col("n_nationkey") % 3
    f = read(spark, sf, "nation").select(F.col("n_regionkey").alias("card_id"), F.lit("data").alias("section"), F.lit("size").alias("field"), F.when(k == 0, "EEE").when(k == 1, "PAPER").otherwise("HTML").alias("source"), F.when(F.col("n_nationkey") % 5 == 1, "not specified").otherwise(F.col("n_name")).alias("value"))
    return cards.merge_facts(f, ["card_id", "section", "field"])


@query("c2_override", "SELECT s_suppkey AS card_id, CASE WHEN s_suppkey % 3 = 0 AND (s_suppkey % 2 = 0 OR s_suppkey % 4 IN (0, 2)) THEN 'new' WHEN s_suppkey % 4 = 0 THEN 'Not specified' WHEN s_suppkey % 4 = 1 THEN s_name || '|' || s_name WHEN s_suppkey % 4 = 2 THEN '' ELSE CAST(s_acctbal AS VARCHAR) END AS value FROM supplier")
def _(spark, sf):
    c = card(spark, sf)
    values = c.where("card_id % 3 = 0").select("card_id", "section", "field", F.array(F.lit("new")).alias("value"))
    return cards.override(c, values).select("card_id", F.array_join("value", "|").alias("value"))


@query("t27_missing_paths", "SELECT s_suppkey AS card_id, 'benchmark_details.languages' AS path FROM supplier WHERE s_suppkey % 4 IN (0, 2)")
def _(spark, sf):
    return cards.missing_paths(card(spark, sf))


@query("t28_normalize", "SELECT s_suppkey AS card_id, CASE WHEN s_suppkey % 4 IN (0, 2) THEN 'Not specified' WHEN s_suppkey % 4 = 1 THEN s_name || '|' || s_name ELSE CAST(s_acctbal AS VARCHAR) END AS value FROM supplier")
def _(spark, sf):
    return cards.normalize(card(spark, sf)).select("card_id", F.array_join("value", "|").alias("value"))


@query("t16_t17_statements", "SELECT item_id, CASE item_id % 3 WHEN 0 THEN 'data.size' WHEN 1 THEN 'methodology.interpretation' ELSE 'purpose_and_intended_users.goal' END AS field, 'accuracy of ' || item_id AS text FROM benchmark")
def _(spark, sf):
    k = F.col("item_id") % 3
    line = F.concat(F.lit("- accuracy of "), "item_id", F.when(k == 0, " [data.size]").when(k == 1, " [methodology.result]").otherwise(" [purpose.x]"), F.lit("\nno statement\n- gone [unknown]"))
    valid = spark.createDataFrame([("data.size",), ("methodology.interpretation",)], "field string")
    return cards.statements(read(spark, sf, "benchmark").select("item_id", line.alias("t")), "item_id", valid, "t").select("item_id", "field", "text")


@query("a18_confidence", "WITH c AS (SELECT c_custkey, c_custkey % 2 = 0 paper, c_custkey % 3 = 0 readme, c_custkey % 5 = 0 scores, c_custkey % 7 = 0 html, c_nationkey % 4 = 0 meta FROM customer) SELECT c_custkey, CASE WHEN paper AND (readme OR meta OR html) THEN 'high' WHEN paper OR (readme AND scores) OR (html AND scores) THEN 'medium' ELSE 'low' END AS confidence FROM c")
def _(spark, sf):
    by = lambda n: F.col("c_custkey") % n == 0
    return read(spark, sf, "customer").select("c_custkey", cards.confidence(by(2), by(3), by(5), by(7), F.col("c_nationkey") % 4 == 0).alias("confidence"))


# ---------------------------------------------------------------- resolution, routing, incremental


@query("j6_override_lookup", "SELECT n_nationkey, CASE WHEN n_regionkey = 1 THEN NULL WHEN n_regionkey = 2 THEN 'set' ELSE n_name END AS repo, n_regionkey IN (1, 2) AS is_override FROM nation")
def _(spark, sf):
    known = spark.createDataFrame([(1, None), (2, "set")], "key int, value string")
    return resolve.with_override(read(spark, sf, "nation").select("n_nationkey", "n_regionkey", F.col("n_name").alias("repo")), known, F.col("n_regionkey"), "repo").select("n_nationkey", "repo", "is_override")


@query("j8_fuzzy_match")
def _(spark, sf):
    c = read(spark, sf, "customer").select(F.regexp_replace("c_name", "#0", "# ").alias("name"))
    return resolve.fuzzy_match(c, read(spark, sf, "customer").select(F.col("c_name").alias("other")), "name", "other").withColumn("similarity", F.round("similarity", 6))


@query("f2_f4_similarity")
def _(spark, sf):
    p = read(spark, sf, "part").select("p_partkey", F.lower("p_name").alias("a"), F.lower("p_type").alias("b"))
    return p.select("p_partkey", F.round(fuzzy.ratio("a", "b"), 6).alias("ratio"), F.round(fuzzy.partial_ratio("a", "b"), 6).alias("partial"))


@query("j9_not_done", "SELECT c_custkey FROM customer WHERE c_custkey % 2 = 1 AND c_custkey % 3 <> 0")
def _(spark, sf):
    c = read(spark, sf, "customer").select("c_custkey", F.col("c_name").alias("name"), F.concat(F.lit("id"), "c_custkey").alias("canonical_id"))
    done = c.where("c_custkey % 2 = 0").select(F.col("canonical_id").alias("key")).union(c.where("c_custkey % 3 = 0").select(names.slug("name")))
    return resolve.not_done(c, done).select("c_custkey")


@query("j10_new_items", "SELECT DISTINCT o_custkey AS c_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')")
def _(spark, sf):
    return resolve.new_items(read(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey")), read(spark, sf, "customer").where("c_mktsegment <> 'BUILDING'"), "c_custkey")


@query("r5_closure", "WITH RECURSIVE n AS (SELECT c_custkey k FROM customer UNION SELECT o_custkey FROM orders), e AS (SELECT k AS src, k // 2 AS dst FROM n UNION SELECT k, k // 3 FROM n), c(root, node, depth) AS (SELECT c_custkey, c_custkey, 0 FROM customer UNION SELECT root, dst, depth + 1 FROM c JOIN e ON c.node = e.src WHERE c.node > 0) SELECT root, node, min(depth) AS depth FROM c GROUP BY root, node")
def _(spark, sf):
    return resolve.closure(key_edges(spark, sf), read(spark, sf, "customer").select(F.col("c_custkey").cast("long").alias("root")))


def key_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every key refers to its half and its third: a graph in which most nodes are reached in several ways."""
    keys = read(spark, sf_dir, "customer").select(F.col("c_custkey").cast("long").alias("src")).union(read(spark, sf_dir, "orders").select(F.col("o_custkey").cast("long"))).distinct()
    return keys.select("src", F.explode(F.array(F.floor(F.col("src") / 2), F.floor(F.col("src") / 3))).alias("dst"))


@query("f13_tiers", "SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'given' WHEN page_id % 3 = 0 THEN 'readme' ELSE 'search' END AS resolved_from FROM pages")
def _(spark, sf):
    p = F.col("page_id")
    value, tier = resolve.first_tier([("given", F.when(p % 2 == 0, "a")), ("readme", F.when(p % 3 == 0, "b")), ("search", F.col("url"))])
    return read(spark, sf, "pages").select("page_id", value.alias("value"), tier.alias("resolved_from")).select("page_id", "resolved_from")


@query(
    "f13_staged_resolution",
    """WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN 'MMLU' ELSE c_name END AS name FROM customer),
o AS (SELECT o_custkey, o_orderkey, year(o_orderdate) AS y, o_orderpriority AS p, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS up,
 row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS down FROM orders),
found AS (SELECT *, 0 AS source, up AS place FROM o WHERE up <= 5 UNION ALL SELECT *, 1 AS source, down AS place FROM o WHERE down <= 5),
once AS (SELECT * FROM found QUALIFY row_number() OVER (PARTITION BY o_orderkey ORDER BY source, place) = 1),
batch AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY source, place) - 1 AS idx FROM once),
said AS (SELECT o_custkey, max(y) AS year, arg_max(o_orderkey, y * 100 - idx) AS best, arg_max(source, y * 100 - idx) AS source, arg_max(p, y * 100 - idx) AS p FROM batch GROUP BY 1),
hit AS (SELECT *, CASE WHEN source = 1 THEN 'https://arxiv.org/abs/' || best WHEN best % 3 = 0 THEN 'https://doi.org/10.1/' || best ELSE 'https://papers.example/' || best END AS url FROM said WHERE p <> '1-URGENT')
SELECT c_custkey,
 CASE WHEN c_custkey % 5 = 0 THEN 'https://papers.example/given/' || c_custkey WHEN c_custkey % 5 = 1 THEN 'https://arxiv.org/abs/' || (1000 + c_custkey % 9000) || '.00001'
  WHEN name = 'MMLU' THEN 'https://arxiv.org/abs/2009.03300' ELSE hit.url END AS url,
 CASE WHEN c_custkey % 5 = 0 THEN 'given' WHEN c_custkey % 5 = 1 THEN 'readme' WHEN name = 'MMLU' THEN 'known'
  WHEN hit.url IS NULL THEN NULL WHEN source = 0 THEN 'openalex+batch_verification' ELSE 'semantic_scholar+batch_verification' END AS resolved_from,
 CASE WHEN c_custkey % 5 > 1 AND name <> 'MMLU' THEN hit.year END AS year
FROM c LEFT JOIN hit ON o_custkey = c_custkey""",
)
def _(spark, sf):
    k = F.col("c_custkey")
    rows = read(spark, sf, "customer").select(
        "c_custkey",
        F.when(k % 7 == 0, "MMLU").otherwise(F.col("c_name")).alias("name"),
        F.when(k % 5 == 0, F.concat(F.lit("https://papers.example/given/"), k)).otherwise("").alias("paper_url"),
        F.when(k % 5 == 1, F.concat(F.lit("**Paper:** https://arxiv.org/abs/"), 1000 + k % 9000, F.lit(".00001"))).alias("readme"),
    )
    return paper_resolution.resolve(rows, order_search(spark, sf), latest_paper).rows.select("c_custkey", "url", "resolved_from", "year")


def order_search(spark: SparkSession, sf_dir: str) -> Provider:
    """Recorded answers: a customer's first five orders from one service, the last five from the other, as their services write them."""
    o = read(spark, sf_dir, "orders").join(read(spark, sf_dir, "customer").select("c_name", F.col("c_custkey").alias("o_custkey")), "o_custkey")
    at = lambda order: F.row_number().over(Window.partitionBy("o_custkey").orderBy(order))
    key = F.col("o_orderkey").cast("string")
    title, year = F.concat("c_name", F.lit(": a benchmark of "), key, F.lit(" "), F.col("o_orderpriority")), F.year("o_orderdate")
    doi = F.when(F.col("o_orderkey") % 3 == 0, F.concat(F.lit("https://doi.org/10.1/"), key))
    page = F.struct(F.concat(F.lit("https://papers.example/"), key).alias("landing_page_url"))
    work = F.to_json(F.struct(title.alias("title"), year.alias("publication_year"), F.struct(doi.alias("doi")).alias("ids"), F.array(page).alias("locations"), page.alias("primary_location")))
    paper = F.to_json(F.struct(title.alias("title"), year.alias("year"), F.struct(key.alias("ArXiv")).alias("externalIds")))
    ranked = o.select("c_name", at("o_orderkey").alias("_up"), at(F.desc("o_orderkey")).alias("_down"), work.alias("_work"), paper.alias("_paper"))
    answer = lambda source, no, place, json: F.struct(F.lit(source).alias("source"), F.lit(no).alias("source_no"), F.col(place).alias("place"), F.col(json).alias("json"))
    told = ranked.select(F.concat("c_name", F.lit(" benchmark evaluation")).alias("query"), F.inline(F.array(answer("openalex", 0, "_up", "_work"), answer("semantic_scholar", 1, "_down", "_paper")))).where(F.col("place") <= 5)
    return lambda queries: queries.join(told, "query")


def latest_paper(batch: DataFrame) -> DataFrame:
    """The judge of the query: the candidate of the latest year, the first of several; unsure of those marked urgent."""
    best = batch.groupBy("key").agg(F.max_by(F.struct("idx", "title"), F.struct("year", -F.col("idx"))).alias("_b"))
    return best.select("key", F.col("_b.idx").alias("match_index"), F.when(F.col("_b.title").endswith("URGENT"), 0.5).otherwise(0.9).alias("confidence"), F.lit("latest").alias("reasoning"))


@query("r1_routing", "SELECT item, CASE WHEN item % 2 = 0 AND item % 3 <> 0 THEN 'catalog' WHEN item % 5 = 0 THEN 'resolver' WHEN item % 7 = 0 THEN 'compose' WHEN item % 11 = 0 THEN 'END' ELSE 'evidence' END AS next FROM (SELECT s_suppkey AS item FROM supplier)")
def _(spark, sf):
    i = F.col("s_suppkey")
    yes = F.lit(True)
    even = (i % 2 == 0) & (i % 3 != 0)
    states = read(spark, sf, "supplier").select(
        i.alias("item"), (~even).alias("is_scored"), (i % 11 == 0).alias("is_composite"), F.lit(False).alias("has_catalog"), F.lit(False).alias("has_ids"), F.lit(False).alias("has_repo"), F.lit(False).alias("has_hub"), (i % 5 != 0).alias("has_paper"), F.lit(False).alias("hub_ids_tried"), F.lit(False).alias("resolver_tried"),
        yes.alias("has_text"), yes.alias("has_html"), yes.alias("has_web"), (i % 7 != 0).alias("has_card"), yes.alias("has_risk"), F.lit(False).alias("has_evidence"), F.lit(False).alias("has_factuality"), F.array(F.lit("loaded")).alias("log"),
    )
    return routing.routed(states).select("item", "next")


@query("a14_histogram", "SELECT o_orderpriority AS reason, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1")
def _(spark, sf):
    return reports.histogram(read(spark, sf, "orders").where("o_orderstatus = 'F'"), "o_orderpriority")


@query("a15_success_rate", "SELECT o_orderpriority, round(count(*) FILTER (o_orderstatus = 'O') * 100.0 / count(*) FILTER (o_orderstatus IN ('O', 'F')), 1) AS rate FROM orders GROUP BY 1")
def _(spark, sf):
    return read(spark, sf, "orders").groupBy("o_orderpriority").agg(reports.success_rate(F.col("o_orderstatus") == "O", F.col("o_orderstatus") == "F").alias("rate"))


@query("s11_latest", "SELECT o_custkey, max(o_orderkey) AS o_orderkey FROM orders GROUP BY 1")
def _(spark, sf):
    return files.latest(read(spark, sf, "orders").select("o_custkey", "o_orderkey"), "o_custkey", "o_orderkey")


@query("q5_history", "SELECT event_id FROM events ORDER BY ts DESC, event_id DESC LIMIT 50")
def _(spark, sf):
    return reports.recent(read(spark, sf, "events"), [F.desc("ts"), F.desc("event_id")], incremental.HISTORY).select("event_id")


# ---------------------------------------------------------------- papers, pages, metadata


@query("j7_known_papers", "SELECT p_partkey, CASE replace(replace(lower(n), '-', '_'), ' ', '_') WHEN 'gsm8k' THEN 'https://arxiv.org/abs/2110.14168' WHEN 'mmlu_pro' THEN 'https://arxiv.org/abs/2406.01574' WHEN 'arc_agi' THEN 'https://arxiv.org/abs/1911.01547' END AS known_paper FROM (SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN 'GSM8K' WHEN 1 THEN 'MMLU-Pro' WHEN 2 THEN 'arc agi' ELSE p_name END AS n FROM part)")
def _(spark, sf):
    k = F.col("p_size") % 5
    n = F.when(k == 0, "GSM8K").when(k == 1, "MMLU-Pro").when(k == 2, "arc agi").otherwise(F.col("p_name"))
    return papers.with_known(read(spark, sf, "part").select("p_partkey", n.alias("name"))).select("p_partkey", "known_paper")


@query("j17_parent", "SELECT c.c_custkey, p.paper AS parent_paper_url FROM customer c LEFT JOIN (SELECT n_nationkey, arg_min(n_name, n_regionkey) AS paper FROM nation GROUP BY n_nationkey) p ON p.n_nationkey = c.c_nationkey")
def _(spark, sf):
    table = read(spark, sf, "nation").select(F.col("n_nationkey").cast("string").alias("name"), F.col("n_regionkey").alias("ord"), F.col("n_name").alias("paper_url"))
    rows = read(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").cast("string").alias("parent"))
    return papers.of_parent(rows, table, values=("paper_url",)).select("c_custkey", "parent_paper_url")


@query("s9_candidates", "SELECT page_id, 'T' || page_id AS title, 'a b ' || page_id AS abstract, CAST(2000 + page_id % 20 AS INTEGER) AS year, page_id * 3 AS citations, CASE WHEN page_id % 2 = 0 THEN '10.1/' || page_id ELSE '' END AS doi, CASE WHEN page_id % 3 = 0 THEN '2001.' || page_id END AS arxiv_id, CASE WHEN page_id % 2 = 0 AND page_id % 5 = 0 THEN '10.1/' || page_id WHEN page_id % 2 = 0 THEN 'https://doi.org/10.1/' || page_id ELSE url END AS url FROM pages")
def _(spark, sf):
    p = F.col("page_id")
    doi = F.when(p % 2 == 0, F.concat(F.lit("10.1/"), p))
    arxiv = F.when(p % 3 == 0, F.concat(F.lit("2001."), p))
    opts = {"ignoreNullFields": "true"}
    index = F.map_from_arrays(F.array(F.lit("b"), p.cast("string"), F.lit("a")), F.array(F.array(F.lit(1)), F.array(F.lit(2)), F.array(F.lit(0))))
    work = F.to_json(F.struct(F.concat(F.lit("T"), p).alias("title"), (2000 + p % 20).alias("publication_year"), (p * 3).alias("cited_by_count"), F.struct(doi.alias("doi")).alias("ids"), F.array(F.struct(F.lit("https://x.org").alias("landing_page_url")), F.struct(F.concat(F.lit("https://arxiv.org/abs/"), arxiv, F.lit("/")).alias("landing_page_url"))).alias("locations"), F.struct(F.col("url").alias("landing_page_url")).alias("primary_location"), index.alias("abstract_inverted_index")), opts)
    paper = F.to_json(F.struct(F.concat(F.lit("T"), p).alias("title"), F.concat(F.lit("a b "), p).alias("abstract"), (2000 + p % 20).alias("year"), (p * 3).alias("citationCount"), F.struct(arxiv.alias("ArXiv"), doi.alias("DOI")).alias("externalIds"), "url"), opts)
    first = p % 5 == 0
    answers = read(spark, sf, "pages").select("page_id", F.when(first, "openalex").otherwise("semantic_scholar").alias("source"), F.when(first, work).otherwise(paper).alias("json"))
    return papers.candidates(answers).select("page_id", "title", "abstract", "year", "citations", "doi", "arxiv_id", "url")


@query("l7_to_verify", "WITH c AS (SELECT source AS key, doc_id, lower(regexp_extract(text, '\\S+', 0)) AS t FROM documents), f AS (SELECT key, t, min(doc_id) AS doc_id FROM c WHERE t <> '' GROUP BY 1, 2), r AS (SELECT key, doc_id, row_number() OVER (PARTITION BY key ORDER BY doc_id) - 1 AS idx FROM f) SELECT * FROM r WHERE idx < 10")
def _(spark, sf):
    rows = read(spark, sf, "documents").select(F.col("source").alias("key"), "doc_id", F.regexp_extract("text", r"\S+", 0).alias("title"), F.lit(0).alias("query_no"), F.lit(0).alias("source_no"), F.col("doc_id").alias("place"))
    return papers.to_verify(rows).select("key", "doc_id", F.col("idx").cast("long").alias("idx"))


@query("k4_decision", "SELECT s_suppkey AS key, CASE WHEN s_suppkey % 3 = 0 AND s_suppkey % 4 >= 2 THEN 'https://arxiv.org/abs/' || s_suppkey WHEN s_suppkey % 3 = 1 AND s_suppkey % 4 >= 2 THEN 'https://x.org/' || s_suppkey END AS resolved FROM supplier")
def _(spark, sf):
    k = F.col("s_suppkey")
    base = read(spark, sf, "supplier").select(k.alias("key"), F.explode(F.array(F.lit(0), F.lit(1))).alias("idx"))
    batch = base.select("key", "idx", F.lit("q").alias("query"), F.lit("openalex").alias("source"), F.lit("t").alias("title"), F.lit(0).alias("citations"), F.lit(2000).alias("year"), F.lit(60.0).alias("similarity"), F.when(F.col("idx") == 0, F.col("key").cast("string")).alias("arxiv_id"), F.lit("").alias("doi"), F.when(F.col("idx") == 1, F.concat(F.lit("https://x.org/"), "key")).alias("url"))
    verdicts = read(spark, sf, "supplier").select(k.alias("key"), F.when(k % 3 < 2, (k % 3)).cast("int").alias("match_index"), F.when(k % 4 >= 2, 0.7).otherwise(0.69).alias("confidence"), F.lit("why").alias("reasoning"))
    log = papers.verification_log(papers.decided(batch, verdicts))
    return log.select("key", F.get_json_object("log", "$.resolved_url").alias("resolved"))


@query("f14_f15_registry", "SELECT c_custkey, CASE WHEN c_nationkey % 3 = 0 THEN 'id' || c_nationkey END AS canonical_id, CASE c_nationkey % 4 WHEN 0 THEN 'Long ' || c_nationkey WHEN 1 THEN 'Shown ' || c_nationkey END AS shown_name FROM customer")
def _(spark, sf):
    number = F.regexp_extract("name", "[0-9]+", 0)
    ids = lambda d: d.withColumn("canonical_id", F.when(number.cast("int") % 3 == 0, F.concat(F.lit("id"), number)))
    shown = lambda d: d.select("name", F.when(number.cast("int") % 4 == 0, F.concat(F.lit("Long "), number, F.lit(" — more"))).alias("description"), F.when(number.cast("int") % 4 < 2, F.concat(F.lit("Shown "), number)).alias("display_name"))
    rows = read(spark, sf, "customer").select("c_custkey", F.concat(F.lit("n"), "c_nationkey").alias("name"))
    known = spark.createDataFrame([("n0", "id0"), ("n1", None)], "name string, canonical_id string")
    return papers.display_names(papers.canonical_ids(rows, ids, known), shown).select("c_custkey", "canonical_id", "shown_name")


@query("s16_accessible", "SELECT page_id, NOT (page_id % 4 = 0 OR (page_id % 3 = 0 AND page_id % 5 <> 0)) OR page_id % 7 = 0 AS ok FROM pages")
def _(spark, sf):
    p = F.col("page_id")
    status = F.when(p % 7 != 0, F.when(p % 4 == 0, 403).otherwise(200))
    kind = F.when(p % 7 != 0, F.when(p % 3 == 0, "text/html; charset=utf-8").otherwise("application/pdf"))
    url = F.when(p % 5 == 0, "https://openreview.net/x").otherwise("https://publisher.example/x")
    return read(spark, sf, "pages").select("page_id", pages.accessible(status, kind, url).alias("ok"))


@query("s8_t13_page_text")
def _(spark, sf):
    return pages.content(read(spark, sf, "pages"), ["page_id"])


@query("s6_s17_hub_metadata", "SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN 'a/' || s_suppkey END AS repo, 'R' || s_suppkey AS readme_markdown, 't' || s_suppkey AS tag FROM supplier UNION ALL SELECT s_suppkey, 'b/' || s_suppkey, NULL, NULL FROM supplier WHERE s_suppkey % 3 = 0")
def _(spark, sf):
    k = F.col("s_suppkey").cast("string")
    one = F.concat(F.lit('{"readme_markdown": "R'), k, F.lit('", "tags": ["t'), k, F.lit('"]}'))
    many = F.concat(F.lit('{"a/'), k, F.lit('": '), one, F.lit(', "b/'), k, F.lit('": {"error": "gone"}}'))
    rows = read(spark, sf, "supplier").select("s_suppkey", F.when(F.col("s_suppkey") % 3 == 0, many).otherwise(one).alias("json"))
    return hub.metadata(rows).select("s_suppkey", "repo", "readme_markdown", F.get("tags", F.lit(0)).alias("tag"))


@query("t36_catalog_ids", "SELECT n_nationkey, CASE n_nationkey % 4 WHEN 0 THEN 'o/' || n_nationkey WHEN 1 THEN 'a/' || n_nationkey || ',b/x' WHEN 2 THEN 'c/1,d/' || n_nationkey END AS repos, CASE n_nationkey % 4 WHEN 0 THEN 'https://arxiv.org/abs/1' || n_nationkey WHEN 1 THEN 'https://p/' || n_nationkey WHEN 2 THEN 'https://arxiv.org/abs/2' || n_nationkey ELSE 'https://arxiv.org/abs/3' || n_nationkey END AS paper FROM nation")
def _(spark, sf):
    k, n = F.col("n_nationkey").cast("string"), F.col("n_nationkey") % 4
    c = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    entry = (
        F.when(n == 0, c('{"root": {"loader": {"path": "o/', k, '"}, "__tags__": {"arxiv": ["1', k, '", "9"]}}}'))
        .when(n == 1, c('{"root": {"loader": {"__type__": "multiple_source_loader", "sources": [{"__type__": "load_hf", "path": "a/', k, '"}, {"__type__": "csv", "path": "no"}, {"__type__": "load_hf", "path": "b/x"}]}, "__tags__": {"urls": {"arxiv": "http://p/', k, '"}}}}'))
        .when(n == 2, c('{"components": {"cards": {"x": {"loader": {"path": "c/1"}}, "y": {"loader": {"path": "d/', k, '"}}, "z": {"loader": {"path": "c/1"}}}}, "root": {"__tags__": {"arxiv": "2', k, '"}}}'))
        .otherwise(c('{"tags": ["x", "arxiv:3', k, '"]}'))
    )
    return read(spark, sf, "nation").select("n_nationkey", F.array_join(artifacts.hub_repositories(entry), ",").alias("repos"), artifacts.paper_of(entry).alias("paper"))


@query("t41_unwrap", "SELECT event_id, props AS card FROM events")
def _(spark, sf):
    wrapped = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit('{"benchmark_card": '), "props", F.lit("}"))).otherwise(F.col("props"))
    return read(spark, sf, "events").select("event_id", F.regexp_replace(artifacts.unwrapped(wrapped), '":(?=[^ ])', '": ').alias("card"))


@query("a13_split_totals", "SELECT l_orderkey, string_agg('s' || l_linenumber || ': ' || CAST(l_quantity AS BIGINT), '|' ORDER BY l_linenumber, l_quantity) AS splits, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS total FROM lineitem GROUP BY l_orderkey")
def _(spark, sf):
    entry = F.struct("l_linenumber", F.col("l_quantity").cast("long").alias("q"))
    rows = read(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(entry)), lambda s: F.struct(F.concat(F.lit("s"), s["l_linenumber"]).alias("name"), s["q"].alias("num_examples"))).alias("s"))
    listed, total = artifacts.split_totals("s")
    return rows.select("l_orderkey", F.array_join(listed, "|").alias("splits"), total.alias("total"))


@query("t44_context_block", "SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN '' ELSE 'Known information:' || chr(10) || 'Known full name: ' || c_name || CASE WHEN c_custkey % 4 = 2 THEN chr(10) || 'Domains: ' || c_mktsegment ELSE '' END END AS block FROM customer")
def _(spark, sf):
    k = F.col("c_custkey") % 4
    domains = F.when(k == 2, F.array(F.lit("Not Specified"), F.col("c_mktsegment"))).otherwise(F.array(F.lit("not specified")))
    block = artifacts.context_block(F.when(k != 0, F.col("c_name")), F.lit(None).cast("string"), domains, F.lit(None).cast("array<string>"))
    return read(spark, sf, "customer").select("c_custkey", block.alias("block"))


@query("t4_nested_json", "SELECT event_id, 'Top Key: x' || chr(10) || 'K: ' || json_extract_string(props, '$.k') || chr(10) || 'Many: a, b' AS lines FROM events")
def _(spark, sf):
    nested = F.concat(F.lit('{"top_key": "x", "none": null, "inner": '), "props", F.lit(', "many": ["a", "b"]}'))
    return read(spark, sf, "events").select("event_id", artifacts.readable(nested).alias("lines"))


# ---------------------------------------------------------------- from sources to cards


def card_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document is the paper of a benchmark; facts of its fields are lists in it and in its README."""
    d = F.col("doc_id").cast("string")
    paper = F.concat(F.lit("## benchmark_details\n- overview: about "), d, F.lit("\n- domains: No information found\n## data\n- size: "), d, F.lit(" rows\n- source: No information found\n\n"), "text", F.lit("\n\n- source: collected in "), d)
    readme = F.concat(F.lit("## benchmark_details\n- overview: other\n- languages: xx\n## data\n- format: csv "), F.repeat(F.lit("."), 60))
    return read(spark, sf_dir, "documents").select(F.col("doc_id").alias("card_id"), F.concat(F.lit("b"), d).alias("name"), F.lit("").alias("anchor"), paper.alias("paper"), F.lit(None).cast("string").alias("html"), F.when(F.col("doc_id") % 2 == 0, readme).alias("readme"))


@query("c10_compose", "SELECT doc_id AS card_id, 'about ' || doc_id AS overview, doc_id || ' rows' AS size, CASE WHEN doc_id % 3 = 0 THEN 'English|German' WHEN doc_id % 2 = 0 THEN 'xx' END AS languages, 'b' || doc_id AS name FROM documents")
def _(spark, sf):
    values = read(spark, sf, "documents").where("doc_id % 3 = 0").select(F.col("doc_id").alias("card_id"), F.lit("benchmark_details").alias("section"), F.lit("languages").alias("field"), F.array(F.lit("English"), F.lit("German")).alias("value"))
    facts = values.select("card_id", "section", "field", F.lit("DETERMINISTIC").alias("source"), F.array_join("value", ", ").alias("value"))
    card, _ = composition.compose(card_sources(spark, sf), facts, values)
    at = lambda f: F.max(F.when(F.col("field") == f, F.array_join("value", "|"))).alias(f)
    return card.where("field <> 'source'").groupBy("card_id").agg(at("overview"), at("size"), at("languages"), at("name"))


@query("t15_fact_lines", "SELECT doc_id AS card_id, 'data' AS section, 'size' AS field, doc_id || ' rows' AS value, false AS missing FROM documents UNION ALL SELECT doc_id, 'data', 'source', 'No information found', true FROM documents")
def _(spark, sf):
    facts = F.concat(F.lit("- loose: x\n**Data**\n- size: "), F.col("doc_id").cast("string"), F.lit(" rows\nno line\n- source : No information found\n## Other\n- size: 3"))
    return composition.fact_lines(read(spark, sf, "documents").select(F.col("doc_id").alias("card_id"), facts.alias("facts"))).drop("line")


# ---------------------------------------------------------------- further forms over whole tables


@query("a5_suite_statistics_whole", ORACLE_SQL["a5_suite_statistics"])
def _(spark, sf):
    s = scores(spark, sf)
    return evaluations.suite_statistics(s, s.select("folder", "bench").distinct()).withColumn("metrics", F.array_join("metrics", ","))


@query("p2_suite_filter_whole", f"WITH {SCORES} SELECT DISTINCT bench FROM scores WHERE lower(bench) = 'click' OR bench IN (SELECT bench FROM scores WHERE folder = 'f1')")
def _(spark, sf):
    s = scores(spark, sf)
    return evaluations.filtered(s.select("bench", F.col("bench").alias("name")).distinct(), s.select("folder", "bench").distinct(), ["click", "F1"]).select("bench")


@query("t6_expand_tags_whole", ORACLE_SQL["t6_expand_tags"].replace("md5(", "(", 1))
def _(spark, sf):
    line = F.concat(F.lit("language:"), "lang", F.lit(" format: csv task_ids: qa "), "text")
    return read(spark, sf, "documents").select("doc_id", text.expand_tags(line).alias("words"))


@query("t10_tag_fields_whole", "SELECT l_orderkey, l_linenumber, 'English, German' AS languages, 'MIT License' AS license, '1K to 10K examples' AS size, 'Question answering' AS tasks, 'text' AS data_type FROM lineitem")
def _(spark, sf):
    return line_tags(read(spark, sf, "lineitem"))


@query("w5_carried_heading_whole", ORACLE_SQL["w5_carried_heading"])
def _(spark, sf):
    lines = read(spark, sf, "conversations").withColumn("line", F.when(F.col("role") == "user", F.concat(F.lit("## "), "text")).otherwise(F.col("text")))
    return cards.carried_heading(lines, "conv_id", "turn").select("conv_id", "turn", "heading")


@query("r5_closure_whole", "WITH RECURSIVE e AS (SELECT DISTINCT o_custkey AS src, (o_custkey * 7 + 3) % 1500 AS dst FROM orders), c(root, node, path, depth) AS (SELECT c_custkey, c_custkey, [c_custkey], 0 FROM customer UNION ALL SELECT root, dst, list_append(path, dst), depth + 1 FROM c JOIN e ON c.node = e.src WHERE NOT list_contains(path, dst)) SELECT root, node, min(depth) AS depth FROM c GROUP BY root, node")
def _(spark, sf):
    return resolve.closure(order_edges(spark, sf), read(spark, sf, "customer").select(F.col("c_custkey").cast("long").alias("root")))


@query("j5_exact_then_suffix_whole", "SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN 'exact' ELSE 'loose' END AS found FROM nation")
def _(spark, sf):
    return nation_repositories(read(spark, sf, "nation"))


def line_tags(lines: DataFrame) -> DataFrame:
    rows = lines.select("l_orderkey", "l_linenumber", F.array(*map(F.lit, ["language:en", "language:de", "license:other", "license:mit", "size_categories:1K<n<10K", "task_ids:question-answering", "modality:text", "broken"])).alias("tags"))
    out = tags.tag_fields(rows.withColumn("k", F.struct("l_orderkey", "l_linenumber")), "k")
    return out.select("k.l_orderkey", "k.l_linenumber", F.array_join("languages", ", ").alias("languages"), "license", "size", F.array_join("tasks", ", ").alias("tasks"), "data_type")


def order_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "orders").select(F.col("o_custkey").cast("long").alias("src"), ((F.col("o_custkey").cast("long") * 7 + 3) % 1500).alias("dst")).distinct()


# ---------------------------------------------------------------- checks, queries, evidence


@query("t18_suspect_facts", "SELECT item_id, CASE item_id % 3 WHEN 0 THEN '[SUSPECT: topic ''arithmetic'' doesn''t match benchmark domain]' WHEN 1 THEN '[SUSPECT: terms ''Upwork, Crowdflower'' not found in source]' END AS note FROM benchmark")
def _(spark, sf):
    k = F.col("item_id") % 3
    line = F.when(k == 0, "- about arithmetic").when(k == 1, "- labelled on Upwork and Crowdflower").otherwise("- labelled by Someone known")
    return read(spark, sf, "benchmark").select("item_id", checks.suspect_note(line, F.lit("someone wrote it"), F.lit("IFEval"), F.array(F.lit("Instruction following"))).alias("note"))


@query("p11_valid_name", r"SELECT p_partkey, regexp_matches(p_name, '^[A-Za-z0-9.\-_]{1,100}$') AS ok FROM part")
def _(spark, sf):
    return read(spark, sf, "part").select("p_partkey", checks.valid_name("p_name").alias("ok"))


@query("p5_merged_events", "SELECT event_id FROM events WHERE event_id % 3 = 0")
def _(spark, sf):
    body = F.format_string('{"discussion": {"status": "%s", "isPullRequest": true}}', F.when(F.col("event_id") % 3 == 0, "merged").otherwise("open"))
    return read(spark, sf, "events").where(checks.is_merged(body)).select("event_id")


@query("q2_single_flight")
def _(spark, sf):
    """The events as a stream: purchases and clicks bring folders, signups end jobs, views and errors are ignored; an hour each."""
    source = spark.readStream.schema(read(spark, sf, "events").schema).parquet(f"{sf}/events.parquet*")  # a pattern: the path itself would have to be a folder
    kind = F.when(F.col("event_type").isin("purchase", "click"), "new").when(F.col("event_type") == "signup", "done")
    folders = F.array(F.concat(F.lit("f"), F.col("event_id") % 7))
    rows = source.select(F.concat(F.lit("u"), "user_id").alias("key"), "ts", kind.alias("kind"), F.when(kind == "new", folders).alias("folders"), F.lit(None).cast("long").alias("job"))
    out, checkpoint = new_path(spark, "single-flight"), new_path(spark, "single-flight-state")
    flights = jobs.single_flight(rows).writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    flights.awaitTermination()
    release(spark, checkpoint)
    return spark.read.schema(jobs.ACTIONS).parquet(out)


@query("p10_skip_aggregates", "SELECT n_nationkey FROM nation WHERE n_nationkey % 2 = 1")
def _(spark, sf):
    name = F.when(F.col("n_nationkey") % 2 == 0, F.element_at(F.array(*map(F.lit, resolve.AGGREGATES)), (F.col("n_nationkey") % 6 + 1).cast("int"))).otherwise(F.col("n_name"))
    return read(spark, sf, "nation").where(~F.lower(name).isin(*resolve.AGGREGATES)).select("n_nationkey")


SUITE = "(SELECT p_partkey, p_name, CASE p_size % 4 WHEN 0 THEN 'helm_' WHEN 1 THEN 'hf_' ELSE '' END || CASE p_size % 3 WHEN 0 THEN replace(p_name, ' ', '_') ELSE split_part(p_name, ' ', 1) END || CASE p_size % 5 WHEN 0 THEN '_v2.1' WHEN 1 THEN ' 3' ELSE '' END AS suite, CASE p_size % 7 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE p_type END AS full_name, CASE p_size % 2 WHEN 0 THEN p_brand ELSE '' END AS title FROM part)"


def suite_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    suite = F.concat(F.when(size % 4 == 0, "helm_").when(size % 4 == 1, "hf_").otherwise(""), F.when(size % 3 == 0, F.translate("p_name", " ", "_")).otherwise(F.split_part("p_name", F.lit(" "), F.lit(1))), F.when(size % 5 == 0, "_v2.1").when(size % 5 == 1, " 3").otherwise(""))
    return read(spark, sf_dir, "part").select("p_partkey", suite.alias("suite"), F.when(size % 7 == 1, "").when(size % 7 > 1, F.col("p_type")).alias("full_name"), F.when(size % 2 == 0, F.col("p_brand")).otherwise("").alias("title"))


@query(
    "t26_search_queries",
    f"""WITH a AS (SELECT p_partkey, suite, nullif(full_name, '') f, nullif(title, '') t, replace(suite, '_', ' ') w FROM {SUITE}), b AS (SELECT *, trim(regexp_replace(w, '\\s+v?\\d+(\\.\\d+)*$', '')) base FROM a),
 q AS (SELECT p_partkey, [CASE WHEN lower(f) <> lower(suite) THEN f END, CASE WHEN lower(f) <> lower(suite) THEN f || ' benchmark' END, t, CASE WHEN base <> '' AND lower(base) <> lower(w) THEN base END, CASE WHEN base <> '' AND lower(base) <> lower(w) THEN base || ' benchmark' END,
 w || CASE WHEN (w LIKE 'helm %' AND len(string_split(substr(w, 6), ' ')) = 1) OR (w LIKE 'hf %' AND len(string_split(substr(w, 4), ' ')) = 1) THEN ' benchmark' ELSE ' benchmark evaluation' END] AS l FROM b),
 u AS (SELECT p_partkey, unnest(l) AS x, generate_subscripts(l, 1) AS i FROM q), d AS (SELECT p_partkey, arg_min(x, i) AS x, min(i) AS i FROM u WHERE x IS NOT NULL GROUP BY p_partkey, lower(x)) SELECT p_partkey, string_agg(x, '|' ORDER BY i) AS queries FROM d GROUP BY p_partkey""",
)
def _(spark, sf):
    return suite_names(spark, sf).select("p_partkey", F.array_join(checks.search_queries("suite", "full_name", "title"), "|").alias("queries"))


@query("a21_failure_kinds", "WITH f AS (SELECT CASE l_linenumber % 5 WHEN 0 THEN 'Composer returned None' WHEN 1 THEN 'Card is Empty' WHEN 2 THEN 'all fields Not Specified' WHEN 3 THEN 'timeout' END AS said, CASE WHEN l_returnflag = 'R' THEN '' ELSE 'p' END AS paper, CASE WHEN l_linestatus = 'F' THEN NULL ELSE 'r' END AS repo FROM lineitem), k AS (SELECT CASE WHEN paper = '' AND repo IS NULL THEN 'no_sources' WHEN contains(said, 'returned None') THEN 'composer_failed' WHEN contains(lower(said), 'empty') OR contains(lower(said), 'not specified') THEN 'empty_content' ELSE 'composer_failed' END AS kind FROM f) SELECT kind, count(*) AS n FROM k GROUP BY 1")
def _(spark, sf):
    k = F.col("l_linenumber") % 5
    said = F.when(k == 0, "Composer returned None").when(k == 1, "Card is Empty").when(k == 2, "all fields Not Specified").when(k == 3, "timeout")
    paper, repo = F.when(F.col("l_returnflag") == "R", "").otherwise("p"), F.when(F.col("l_linestatus") != "F", "r")
    return reports.histogram(read(spark, sf, "lineitem"), checks.failure_kind(said, paper, repo), "kind")


@query(
    "t37_identity",
    """WITH a AS (SELECT p_partkey, p_brand AS name, CASE WHEN p_size % 3 = 0 THEN p_brand WHEN p_size % 3 = 1 THEN p_type ELSE '' END AS title, CASE WHEN p_size % 4 = 0 THEN [] ELSE ['task_categories: ' || replace(p_name, ' ', '-'), 'language:en', split_part(p_name, ' ', 1), 'ab', upper(split_part(p_name, ' ', 1)), split_part(p_type, ' ', 2)] END AS tags, CASE WHEN p_size % 5 = 0 THEN p_name ELSE repeat('x', 300) END AS summary, CASE WHEN p_size % 7 = 0 THEN '' ELSE p_type END AS description FROM part),
 s AS (SELECT p_partkey, name, list_concat(list_concat([CASE WHEN title <> '' AND lower(title) <> lower(name) THEN 'Also known as: ' || title END], list_concat(list_transform(list_filter(tags, lambda t: starts_with(t, 'task_categories:')), lambda t: replace(trim(substr(t, 17)), '-', ' ')), list_transform(list_filter(tags, lambda t: NOT contains(t, ':') AND len(t) > 2), lambda t: replace(t, '-', ' ')))), [CASE WHEN len(summary) < 300 THEN summary END, CASE WHEN description <> '' THEN description END]) AS l FROM a),
 u AS (SELECT p_partkey, name, unnest(l) AS x, generate_subscripts(l, 1) AS i FROM s), d AS (SELECT p_partkey, name, arg_min(x, i) AS x, min(i) AS i FROM u WHERE trim(x) <> '' GROUP BY p_partkey, name, lower(trim(x))), r AS (SELECT *, row_number() OVER (PARTITION BY p_partkey ORDER BY i) AS n FROM d),
 j AS (SELECT p_partkey, name, string_agg(trim(x), ', ' ORDER BY i) AS x FROM r WHERE n <= 6 GROUP BY p_partkey, name) SELECT a.p_partkey, CASE WHEN x IS NULL THEN '' ELSE 'BENCHMARK IDENTITY: "' || a.name || '" is about: ' || x || '. Only extract facts that are relevant to this topic.' END AS anchor FROM a LEFT JOIN j USING (p_partkey)""",
)
def _(spark, sf):
    size, word = F.col("p_size"), F.split_part("p_name", F.lit(" "), F.lit(1))
    tags_ = F.when(size % 4 == 0, F.array().cast("array<string>")).otherwise(F.array(F.concat(F.lit("task_categories: "), F.translate("p_name", " ", "-")), F.lit("language:en"), word, F.lit("ab"), F.upper(word), F.split_part("p_type", F.lit(" "), F.lit(2))))
    rows = read(spark, sf, "part").select("p_partkey", F.col("p_brand").alias("name"), F.when(size % 3 == 0, F.col("p_brand")).when(size % 3 == 1, F.col("p_type")).otherwise("").alias("title"), tags_.alias("tags"), F.when(size % 5 == 0, F.col("p_name")).otherwise(F.repeat(F.lit("x"), 300)).alias("summary"), F.when(size % 7 == 0, "").otherwise(F.col("p_type")).alias("description"))
    return rows.select("p_partkey", checks.identity("name", "title", "tags", "summary", "description").alias("anchor"))


@query("t30_use_case", "SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'Goal: ' || c_name || '. Audience: ' || c_mktsegment ELSE 'Goal: ' || c_name END AS text FROM customer")
def _(spark, sf):
    return read(spark, sf, "customer").select("c_custkey", checks.use_case(Goal="c_name", Tasks=F.lit(""), Audience=F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment"))).alias("text"))


@query("t4_json_lines", "SELECT event_id, 'K: ' || json_extract_string(props, '$.k') AS lines FROM events")
def _(spark, sf):
    return read(spark, sf, "events").select("event_id", checks.json_lines("props").alias("lines"))


@query("t19_sub_label", "SELECT p_partkey, translate(lower(p_type), '_-', '  ') AS label FROM part")
def _(spark, sf):
    return read(spark, sf, "part").select("p_partkey", names.sub_label(F.concat("p_brand", F.lit("_"), "p_type"), "p_brand").alias("label"))


@query("j5_exact_then_suffix", "SELECT n_nationkey, CASE WHEN n_nationkey % 2 = 0 THEN 'exact' ELSE 'loose' END AS found FROM nation")
def _(spark, sf):
    return nation_repositories(read(spark, sf, "nation"))


def nation_repositories(nations: DataFrame) -> DataFrame:
    n = nations.select("n_nationkey", F.concat(F.lit("org/"), "n_name").alias("repo"))
    index = n.select(F.when(F.col("n_nationkey") % 2 == 0, F.col("repo")).otherwise(F.upper(F.concat(F.lit("else/"), F.substr(F.col("repo"), F.lit(5))))).alias("key"), F.when(F.col("n_nationkey") % 2 == 0, "exact").otherwise("loose").alias("value"), F.col("n_nationkey").alias("ord"))
    return resolve.exact_then_suffix(n, index, "repo", "found").select("n_nationkey", "found")


@query("j14_inherit", "SELECT CASE s_suppkey % 3 WHEN 0 THEN 'data' WHEN 1 THEN 'benchmark_details' ELSE 'ethical_and_legal_considerations' END AS section, 'f' || s_suppkey AS field, CASE WHEN s_suppkey % 2 = 0 THEN 'own' WHEN s_suppkey % 3 = 2 THEN 'Not specified' ELSE s_name END AS value FROM supplier")
def _(spark, sf):
    k = F.col("s_suppkey") % 3
    base = read(spark, sf, "supplier").select(F.when(k == 0, "data").when(k == 1, "benchmark_details").otherwise("ethical_and_legal_considerations").alias("section"), F.concat(F.lit("f"), "s_suppkey").alias("field"), F.lit(False).alias("is_list"), "s_name", "s_suppkey")
    child = base.select("section", "field", F.array(F.when(F.col("s_suppkey") % 2 == 0, "own").otherwise("Not specified")).alias("value"), "is_list")
    return cards.inherit(child, base.select("section", "field", F.array("s_name").alias("value"), "is_list")).select("section", "field", F.array_join("value", "|").alias("value"))


@query("c4_backfill", "SELECT s_suppkey AS card_id, CASE WHEN s_suppkey % 4 IN (0, 2) AND s_suppkey % 3 = 0 THEN 'evidence of ' || s_name WHEN s_suppkey % 4 = 0 THEN 'Not specified' WHEN s_suppkey % 4 = 2 THEN '' WHEN s_suppkey % 4 = 1 THEN s_name || '|' || s_name ELSE CAST(s_acctbal AS VARCHAR) END AS value FROM supplier")
def _(spark, sf):
    c = card(spark, sf)
    said = read(spark, sf, "supplier").select(F.col("s_suppkey").alias("card_id"), F.lit("benchmark_details").alias("section"), F.lit("languages").alias("field"), F.when(F.col("s_suppkey") % 3 == 0, F.concat(F.lit("evidence of "), "s_name")).otherwise("short").alias("evidence"))
    return cards.backfill(c, said).select("card_id", F.array_join("value", "|").alias("value"))


@query("c6_unflagged", f"WITH {FIELDS} SELECT field FROM fields WHERE (coalesce(m, 0.5) < 0.8 OR m IS NULL) AND field <> 'data.src4'")
def _(spark, sf):
    found = factuality.flags(factuality.by_field(atoms(spark, sf)))
    return factuality.unflagged(found, spark.createDataFrame([("data.src4",)], "field string")).select("field")


@query("c14_x5_risks")
def _(spark, sf):
    rules = spark.createDataFrame([("r1", "Toxic output", "d", "u", ["idiot", "trash"]), ("r2", "Licence", "d", "u", ["licensed"])], "id string, name string, description string, url string, words array<string>")
    return risks(read(spark, sf, "documents").select(F.col("doc_id").alias("card_id"), "text"), rules).select("card_id", F.array_join("risks.id", ",").alias("risks"))


@query("f9_f11_hybrid_evidence")
def _(spark, sf):
    embed = hashed_vectors()
    chunks = embed(read(spark, sf, "documents").select(F.col("doc_id").alias("chunk_id"), "text"))
    said = embed(read(spark, sf, "benchmark").select(F.col("item_id").alias("atom_id"), "text"))
    found = evidence.contexts(evidence.hybrid(chunks, said))
    out = support()(evidence.formatted(said.drop("embedding"), found))
    return out.select("atom_id", F.array_join("contexts", ",").alias("contexts"), F.round("p_true", 6).alias("p_true"))


@query("a7_corpus_statistics", r"SELECT count(*) AS n, round(avg(len(regexp_extract_all(lower(text), '[\p{L}\p{N}_]+'))), 6) AS avgdl FROM documents")
def _(spark, sf):
    return read(spark, sf, "documents").agg(F.count("*").alias("n"), F.round(F.avg(F.size(text.tokens("text"))), 6).alias("avgdl"))


@query("a16_job_outcomes", "SELECT count(*) FILTER (o_orderstatus = 'O') AS running, count(*) FILTER (o_orderstatus = 'F') AS failed, count(*) AS jobs FROM orders")
def _(spark, sf):
    return reports.outcomes(read(spark, sf, "orders"), "o_orderstatus", running="O", failed="F")


@query("r2_append_log", "SELECT conv_id, string_agg(role, '>' ORDER BY turn) AS log FROM conversations GROUP BY conv_id")
def _(spark, sf):
    return reports.appended(read(spark, sf, "conversations"), "conv_id", "turn", "role").withColumn("log", F.array_join("log", ">"))


@query("u4_pending_queue", "SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'a,b,c' ELSE 'a,b' END AS queue FROM customer")
def _(spark, sf):
    new = F.when(F.col("c_custkey") % 2 == 0, F.array(F.lit("b"), F.lit("c"))).otherwise(F.array(F.lit("a")))
    return read(spark, sf, "customer").withColumn("queue", F.array(F.lit("a"), F.lit("b"))).withColumn("new", new).select("c_custkey", F.array_join(incremental.pending("queue", "new"), ",").alias("queue"))


@query("w8_recent_sessions", "SELECT o_orderkey FROM orders ORDER BY o_orderdate DESC, o_orderkey LIMIT 10")
def _(spark, sf):
    return reports.recent(read(spark, sf, "orders"), [F.desc("o_orderdate"), F.col("o_orderkey")], 10).select("o_orderkey")


@query("ext_event_windows", "SELECT time_bucket(INTERVAL 1 HOUR, ts) AS hour, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def _(spark, sf):
    return incremental.windowed_counts(read(spark, sf, "events"), "ts", ["event_type"]).select(F.col("window.start").alias("hour"), "event_type", "n")
