"""The corpus pipeline: quality rules, near-dedup, substring dedup, decontamination, mixing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes each stage's result as Parquet to the shared
folder and reads it again as the next one's docs. All stages but the last return the columns of documents; the last adds
`copy`, the number of the copy of a document that the mix takes more than once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assay.llm import decontaminate, hyperminhash, mixing, quality_rules, substring_dedup
from assay.llm.storage import bound_batches, materialise, release

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or that the rules together find bad go."""
    bound_batches(spark)
    return quality_rules.filter_quality(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents that 5-word shingles link at 0.8 or more the one with the smallest doc_id stays."""
    bound_batches(spark)
    return hyperminhash.keep_one(docs, size=5, percent=80)


def substring(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words that repeat an earlier passage of 20 words or more go; n_chars follows the text."""
    bound_batches(spark)
    out = substring_dedup.dedup_documents(docs)
    if "n_chars" in out.columns:
        out = out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast("long")))
    return out.select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, verbatim or with other numbers, names or units, go."""
    bound_batches(spark)
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mixing.mixed_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality),
    ("minhash_near_dedup", near_dedup),
    ("substring_dedup", substring),
    ("benchmark_decontamination", decontamination),
    ("source_mixing", mix),
]

#: The label model, the sketches and the entropy balancing have no SQL form; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, old = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        docs, path = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if old:
            release(spark, old)
        old = path
    return docs
