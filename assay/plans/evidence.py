"""From sources and statements to evidence, in the form that factuality scoring takes."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import expand_tags, keywords
from ..operators import factuality
from ..operators import retrieval as R
from ..providers import REGISTRY
from ..storage import materialise, release


def build_documents(catalog: DataFrame | None = None, hub: DataFrame | None = None, papers: DataFrame | None = None) -> DataFrame:
    """(doc_id, text, source, type) of what there is: catalog JSON, dataset pages, papers."""
    parts = [d.select(F.concat(F.lit(f"{name}:"), F.col("id").cast("string")).alias("doc_id"), "text", F.lit(name).alias("source"), F.lit(kind).alias("type")) for d, name, kind in ((catalog, "catalog", "json"), (hub, "hub", "readme"), (papers, "paper", "text")) if d is not None]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.where("text IS NOT NULL AND trim(text) <> ''")


def _asked(statements: DataFrame, column: str, out: str) -> DataFrame:
    """With the vector of a column, by the registered provider; the statement's own where it says the same."""
    made = REGISTRY["embed"](text=column, out="_e")(statements)
    return made.withColumn(out, F.when(F.col(column) == F.col("text"), F.col("embedding")).otherwise(F.col("_e"))).drop("_e")


def candidates(chunks: DataFrame, statements: DataFrame, k: int, pool: int = 20, least: int = 5, lexical: int = 10) -> DataFrame:
    """(atom_id, chunk_id, place, text, way): what three searches find, of equal texts the first, `pool` a statement.

    Statements (atom_id, text, embedding) are rewritten by the registered provider. The ways, in order: `k` vectors near the
    query, by marginal relevance among the 2k + 5 nearest; BM25 of the query; and chunks near the first three keywords of
    statement and query, taken from twice as many as are kept, that hold one of all the keywords. Where all find fewer than
    `least`, the first way stands alone.
    """
    texts = chunks.select("chunk_id", "text")
    # vectors may be costly to make, and are read several times
    vectors, p_vectors = materialise(chunks.select(F.col("chunk_id").alias("vec_id"), "embedding"), "evidence-vectors")
    queried = _asked(REGISTRY["rewrite"](text="text", out="query")(statements), "query", "_q")
    words = F.array_sort(F.array_union(keywords("text"), keywords("query")))
    queried = _asked(queried.withColumn("_words", words).withColumn("_three", F.array_join(F.slice("_words", 1, 3), " ")), "_three", "_k")
    asked, p_asked = materialise(queried.select("atom_id", "query", "_q", "_words", "_k"), "evidence-queries")

    pick = lambda c: asked.select(F.col("atom_id").alias("query_id"), F.col(c).alias("embedding"))
    as_hit = lambda way, d, chunk, rank: d.select("atom_id", F.col(chunk).alias("chunk_id"), F.col(rank).alias("rank"), F.lit(way).alias("way"))
    # few rows for each statement; as tables of their own they have a size that Spark knows before it joins them with the corpus
    wide, p_wide = materialise(R.dense_search(vectors, pick("_q"), top=2 * k + 5), "evidence-near")
    near = R.mmr(wide.join(vectors, "vec_id"), "query_id", "vec_id", k).withColumnRenamed("query_id", "atom_id")
    terms = R.bm25(texts.withColumnRenamed("chunk_id", "doc_id"), asked.select(F.col("atom_id").alias("item_id"), F.col("query").alias("text"))).withColumnRenamed("item_id", "atom_id")
    holds = R.dense_search(vectors, pick("_k").join(asked.where(F.size("_words") > 0).select(F.col("atom_id").alias("query_id")), "query_id", "left_semi"), top=2 * lexical).withColumnRenamed("query_id", "atom_id")
    hits, p_hits = materialise(as_hit("vector", near, "vec_id", "step").unionByName(as_hit("bm25", terms, "doc_id", "rank")).unionByName(as_hit("keyword", holds, "vec_id", "rank")), "evidence-hits")
    # the corpus is read once for the texts of all hits
    own, p_own = materialise(texts.join(hits.select("chunk_id").distinct(), "chunk_id", "left_semi"), "evidence-texts")
    told = hits.join(own, "chunk_id")

    ways = {way: told.where(F.col("way") == way).select("atom_id", "chunk_id", "rank", "text", "way") for way in ("vector", "bm25", "keyword")}
    worded = ways["keyword"].join(asked.select("atom_id", "_words"), "atom_id").where(F.exists("_words", lambda w: F.contains(F.lower("text"), F.lower(w))))
    ways["keyword"] = R.ranked(worded.drop("_words").withColumnRenamed("rank", "_r"), "atom_id", [F.col("_r")], lexical).drop("_r")
    fused, p_fused = materialise(R.fuse(list(ways.values()), "atom_id", "text", pool).select("atom_id", "chunk_id", "place", "text", "way"), "evidence-candidates")
    few = fused.groupBy("atom_id").count().where(F.col("count") < least).select("atom_id")
    alone = ways["vector"].join(few, "atom_id", "left_semi").select("atom_id", "chunk_id", F.col("rank").alias("place"), "text", F.lit("vector").alias("way"))
    out, _ = materialise(fused.join(few, "atom_id", "left_anti").unionByName(alone), "evidence-found")
    release(chunks.sparkSession, p_vectors, p_asked, p_wide, p_hits, p_own, p_fused)
    return out


def hybrid(chunks: DataFrame, statements: DataFrame, top: int = 3, pool: int = 20, rerank: bool = False, parents: DataFrame | None = None) -> DataFrame:
    """(atom_id, chunk_id, place, text): candidates, reranked if asked for, graded, the best `top`.

    chunks has (chunk_id, text, embedding), statements (atom_id, text, embedding). Reranking takes three times as many vectors
    and keeps what the registered provider grades well among the first ten. With `parents` (chunk_id, parent_text) the winners
    come with the text that surrounds them, as far as there is one.
    """
    found = candidates(chunks, statements, 3 * top if rerank else top, pool)
    if rerank:
        seen = found.where("place <= 10").join(chunks.select("chunk_id", "embedding"), "chunk_id").join(statements.select("atom_id", F.col("embedding").alias("_q")), "atom_id")
        scored_ = REGISTRY["grade"](a="_q", b="embedding", out="grade")(seen)
        found = R.rerank(scored_, "atom_id", "grade", top=top).select("atom_id", "chunk_id", F.col("rank").alias("place"), "text")
    graded = R.grade(found.select("atom_id", "chunk_id", "place", "text"), "atom_id", "place")
    best = graded.withColumn("place", F.row_number().over(Window.partitionBy("atom_id").orderBy("place")).cast("int")).where(F.col("place") <= top)
    if parents is None:
        return best
    return R.widen(best, parents.select("chunk_id", "parent_text"), ["chunk_id"]).withColumn("text", F.coalesce("parent_text", "text")).drop("parent_text").select("atom_id", "chunk_id", "place", "text")


def contexts(hits: DataFrame) -> DataFrame:
    """(context_id, atom_id, text): evidence with ids c_<atom>_<n>, tags in words."""
    return hits.select(F.concat(F.lit("c_"), F.col("atom_id").cast("string"), F.lit("_"), (F.col("place") - 1).cast("string")).alias("context_id"), "atom_id", expand_tags("text").alias("text"))


def formatted(atoms: DataFrame, found: DataFrame) -> DataFrame:
    """One row for each atom with the ids of its contexts and their texts joined."""
    own = found.groupBy("atom_id").agg(F.array_sort(F.collect_list("context_id")).alias("contexts"), F.concat_ws("\n", F.transform(F.array_sort(F.collect_list(F.struct("context_id", "text"))), lambda s: s["text"])).alias("context"))
    return atoms.join(own, "atom_id", "left").withColumn("contexts", F.coalesce("contexts", F.array().cast("array<string>")))


def scored(rows: DataFrame) -> DataFrame:
    """p_true of each formatted atom by the registered provider."""
    return REGISTRY["support"]()(rows)


# What of a result file is read.
RESULTS = "benchmark string, results array<struct<statement: struct<text: string, field: string>, retrieved_chunks: array<struct<content: string>>>>"


def from_results(rows: DataFrame, json: str = "json") -> tuple[DataFrame, DataFrame]:
    """(atoms (topic, atom_id, field, text), contexts (topic, context_id, atom_id, text)) of retrieval results in JSON."""
    parsed = rows.select(F.from_json(json, RESULTS).alias("r")).select(F.coalesce("r.benchmark", F.lit("unknown")).alias("topic"), F.posexplode("r.results").alias("i", "x"))
    atom = F.concat(F.lit("a"), F.col("i").cast("string"))
    atoms = parsed.select("topic", atom.alias("atom_id"), F.col("x.statement.field").alias("field"), F.coalesce("x.statement.text", F.lit("")).alias("text"))
    chunks = parsed.select("topic", atom.alias("atom_id"), F.posexplode("x.retrieved_chunks").alias("j", "c"))
    return atoms, chunks.select("topic", F.concat(F.lit("c_"), "atom_id", F.lit("_"), F.col("j").cast("string")).alias("context_id"), "atom_id", expand_tags("c.content").alias("text"))


def factuality_results(scored: DataFrame, key: str = "card_id") -> DataFrame:
    """(key, results): field analysis, atom labels and entropy of each card's atoms (key, atom_id, field, p_true), as JSON."""
    fields = factuality.by_field(scored, [key, "field"])
    names = [c for c in fields.columns if c not in (key,)]
    by_field = fields.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("field", *[c for c in names if c != "field"]))).alias("field_analysis"))
    atoms = scored.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct(F.coalesce("p_true", F.lit(-1.0)).alias("o"), "atom_id", "field", "p_true", factuality.label().alias("label")))), lambda a: a.dropFields("o")).alias("atoms"))
    both = atoms.join(by_field, key, "left").join(factuality.entropy(scored, [key]), key, "left")
    return both.select(key, F.to_json(F.struct("field_analysis", "atoms", F.struct("n", "entropy", "mean_entropy", "scaled_entropy").alias("entropy")), {"ignoreNullFields": "false"}).alias("results"))
