"""The queries of this subpackage, as the driver registers them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import compression_toxicity, decontaminate, divergence, filter_lattice, hyperminhash, mixing, mixture_langid, oracles, quality_rules, substring_dedup, tagpath, token_attribution, url_rules, warc
from .storage import bound_batches

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bound_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = quality_rules.assess(docs, ["doc_id"])
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("quality", 6).alias("quality"))


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = substring_dedup.remove_repeats(docs, ["doc_id"])
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op3_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hyperminhash.near_duplicates(table(spark, sf_dir, "documents"), size=2, percent=80)


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


def op5_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    out = warc.derive(warc.responses(pages, ["page_id"]), ["page_id"])
    h = lambda name: F.element_at("headers", name)
    return out.select(
        "page_id",
        h("WARC-Type").alias("warc_type"),
        h("WARC-Record-ID").alias("record_id"),
        h("WARC-Refers-To").alias("refers_to"),
        h("X-Linked-Record").alias("linked_record"),
        h("WARC-Target-URI").alias("target_uri"),
        h("X-Source-Payload-Digest").alias("source_payload_digest"),
        h("WARC-Block-Digest").alias("block_digest"),
        h("Content-Type").alias("content_type"),
        h("Content-Length").cast("long").alias("content_length"),
    )


def op6_token_attribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = token_attribution.count_tokens(table(spark, sf_dir, "documents"), ["doc_id"])
    return out.withColumn("section_tokens", F.col("section_tokens").cast("array<bigint>"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learn, held = mixture_langid.learnable("doc_id", 4, 2)
    model = mixture_langid.fit(docs.where(learn))
    return mixture_langid.identify(docs.select("doc_id", "text", held.alias("held_out")), model, ["doc_id", "held_out"])


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learn, held = mixture_langid.learnable("doc_id", 5, 0)
    model = compression_toxicity.fit(compression_toxicity.labelled(docs, table(spark, sf_dir, "labels").where(learn)))
    out = compression_toxicity.score(docs.select("doc_id", "text", held.alias("held_out")), model, ["doc_id", "held_out"])
    return out.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = decontaminate.find(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), ["doc_id"], hints=True)
    found = F.col("found")
    return out.select(
        "doc_id",
        (F.size(found) > 0).alias("contaminated"),
        F.array_sort(found["item_id"]).alias("item_ids"),
        F.coalesce(F.array_max(found["n_words"]), F.lit(0)).alias("matched_words"),
        F.exists(found, lambda x: x["kind"] == "reparameterised").alias("reparameterised"),
        *[F.array_sort(F.filter("hints", lambda x: x["kind"] == kind)["item_id"]).alias(f"{kind}_ids") for kind in decontaminate.HINTS],  # noqa: B023
    )


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tagpath.extract(table(spark, sf_dir, "pages"), ["page_id", "url"])


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_filter_interaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_lattice.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(table(spark, sf_dir, "pages"), ["page_id"])


def quality_base_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What op2 measures before any vote."""
    stats = quality_rules.with_statistics(table(spark, sf_dir, "documents"), "text", ["doc_id"])
    return stats.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", F.expr(quality_rules.BASE_FAILED).alias("base_failed"))


def mixing_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The targets that op4 mixes to, by source."""
    docs = table(spark, sf_dir, "documents")
    hist = docs.select(mixing.source_key().alias("s"), mixing.token_size().alias("size")).groupBy("s", "size").agg(F.count("*").alias("n"))
    return mixing.targets(hist).select(F.when(F.col("s") != "", F.substr(F.col("s"), F.lit(2))).alias("source"), "source_size", F.round("target", 4).alias("target"))


QUERIES: dict[str, Query] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_quality_rules": op2_quality_rules,
    "op3_minhash_near_dedup": op3_minhash_near_dedup,
    "op4_source_mixing": op4_source_mixing,
    "op5_warc_derivatives": op5_warc_derivatives,
    "op6_token_attribution": op6_token_attribution,
    "op7_benchmark_decontamination": op7_benchmark_decontamination,
    "op8_language_id": op8_language_id,
    "op9_toxicity": op9_toxicity,
    "op10_html_extraction": op10_html_extraction,
    "op11_source_divergence": op11_source_divergence,
    "op12_filter_interaction": op12_filter_interaction,
    "op13_url_filters": op13_url_filters,
    "quality_base_statistics": quality_base_statistics,
    "mixing_targets": mixing_targets,
}

ORACLE_SQL: dict[str, str] = {
    "op1_substring_dedup": oracles.SUBSTRING,
    "op3_minhash_near_dedup": oracles.NEAR,
    "op11_source_divergence": oracles.DIVERGENCE,
    "op12_filter_interaction": oracles.LATTICE,
    "op13_url_filters": oracles.URLS,
    "quality_base_statistics": oracles.BASE,
    "mixing_targets": oracles.TARGETS,
}
