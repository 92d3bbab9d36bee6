"""Evaluation files: one model with many results each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Never inferred: details of scores would become a struct of free-form names.
SCHEMA = """schema_version STRING, evaluation_id STRING, retrieved_timestamp STRING, evaluation_timestamp STRING,
source_metadata STRUCT<source_name: STRING, source_type: STRING, source_organization_name: STRING, source_organization_url: STRING, evaluator_relationship: STRING>,
model_info STRUCT<name: STRING, id: STRING, developer: STRING, inference_platform: STRING>, eval_library STRUCT<name: STRING>,
evaluation_results ARRAY<STRUCT<evaluation_name: STRING,
source_data: STRUCT<dataset_name: STRING, source_type: STRING, hf_repo: STRING, hf_split: STRING, url: ARRAY<STRING>>,
metric_config: STRUCT<metric_id: STRING, evaluation_description: STRING, lower_is_better: BOOLEAN, score_type: STRING, min_score: DOUBLE, max_score: DOUBLE>,
score_details: STRUCT<score: DOUBLE>>>, _corrupt STRING"""

# Rows that sum up a suite instead of naming a benchmark.
AGGREGATE_ROWS = ("mean win rate", "mean score")


def scan(spark: SparkSession, root: str, max_files: int | None = 50) -> DataFrame:
    """The files under root with path, folder and ord, the first `max_files` of each folder in path order.

    A file's folder is its first directory below root, or its stem if it lies in root itself. Unreadable files keep their
    row, with `_corrupt` set; see errors().
    """
    base = "/" + root.split(":", 1)[-1].strip("/") + "/"
    files = spark.read.schema(SCHEMA).option("multiLine", True).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt").option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").json(root)
    path = F.regexp_replace(F.col("_metadata.file_path"), "^[a-z]+:/*", "/")
    relative = F.substr(path, F.lit(len(base) + 1))
    folder = F.when(relative.contains("/"), F.substring_index(relative, "/", 1)).otherwise(F.regexp_replace(relative, r"\.json$", ""))
    files = files.select("*", path.alias("path"), folder.alias("folder"))
    if max_files is None:
        return files
    return files.withColumn("_n", F.row_number().over(Window.partitionBy("folder").orderBy("path"))).where(F.col("_n") <= max_files).drop("_n")


def errors(files: DataFrame) -> DataFrame:
    """(path, error) of the files that could not be read."""
    return files.where("_corrupt IS NOT NULL AND evaluation_results IS NULL").select("path", F.concat(F.lit("unreadable: "), F.substring("_corrupt", 1, 80)).alias("error"))


def results(files: DataFrame) -> DataFrame:
    """One row for each result of a readable file; defaults are filled in, rows without a dataset name are dropped."""
    r = F.col("r")
    named = lambda c: F.coalesce(c, F.lit("unknown"))
    rows = files.where("_corrupt IS NULL AND evaluation_results IS NOT NULL").select("path", "folder", "model_info", "eval_library", F.posexplode("evaluation_results").alias("pos", "r"))
    return rows.select(
        "folder",
        F.struct("path", "pos").alias("ord"),
        named(r["source_data"]["dataset_name"]).alias("display_name"),
        named(F.col("model_info.name")).alias("model"),
        named(F.col("model_info.developer")).alias("developer"),
        r["evaluation_name"].alias("evaluation_name"),
        F.coalesce(r["metric_config"]["metric_id"], r["evaluation_name"], F.lit("unknown")).alias("metric"),
        r["metric_config"].alias("metric_config"),
        r["score_details"]["score"].alias("score"),
        F.coalesce(r["source_data"]["source_type"], F.lit("other")).alias("source_type"),
        r["source_data"]["hf_repo"].alias("hf_repo"),
        F.coalesce(r["source_data"]["url"], F.array().cast("array<string>")).alias("urls"),
        F.col("eval_library.name").alias("eval_library"),
        (F.coalesce(F.lower(r["evaluation_name"]).isin(*AGGREGATE_ROWS), F.lit(False)) | F.coalesce(F.lower(r["metric_config"]["evaluation_description"]).isin(*AGGREGATE_ROWS), F.lit(False))).alias("is_aggregate"),
    ).where("display_name <> 'unknown'")


def scores(rows: DataFrame) -> DataFrame:
    """The results that score a benchmark."""
    return rows.where("NOT is_aggregate")


def folder_metadata(rows: DataFrame) -> DataFrame:
    """(folder, urls, eval_library) from the rows that sum up a suite."""
    return rows.where("is_aggregate").groupBy("folder").agg(F.array_distinct(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("ord", "urls"))), lambda s: s["urls"]))).alias("urls"), F.min_by("eval_library", "ord").alias("eval_library"))
