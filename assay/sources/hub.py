"""Metadata of datasets on a hub, as JSON that was fetched before: one file for a dataset, or one for several by name."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions._columns import Text, col

FIELDS = "id string, tags array<string>, license string, description string, card_data string, dataset_info string, readme_markdown string, error string"


def landed(spark: SparkSession, path: str) -> DataFrame:
    """(path, json) of the files under a folder."""
    rows = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").text(path, wholetext=True)
    return rows.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("json"))


def nested(json: Text) -> Column:
    """Whether metadata are those of several datasets by name: no field of a dataset, and an object in every entry."""
    entries = F.from_json(col(json), "map<string,string>")
    known = F.exists(F.array(*map(F.lit, ("tags", "readme_markdown", "card_data", "id"))), lambda k: F.map_contains_key(entries, k))
    return F.coalesce(~known & (F.size(entries) > 0) & F.forall(F.map_values(entries), lambda v: v.startswith("{")), F.lit(False))


def metadata(rows: DataFrame, json: str = "json") -> DataFrame:
    """One row for each dataset: the rows' other columns, repo (null for a single one without id), and FIELDS.

    A dataset that could not be fetched has its `error` and nothing else.
    """
    others = [c for c in rows.columns if c != json]
    entries = F.map_entries(F.when(nested(json), F.from_json(json, "map<string,string>")).otherwise(F.create_map(F.lit(""), F.col(json))))
    each = rows.select(*others, F.explode(entries).alias("_e")).select(*others, F.nullif(F.col("_e.key"), F.lit("")).alias("_repo"), F.from_json("_e.value", FIELDS).alias("_m"))
    return each.select(*others, F.coalesce("_repo", "_m.id").alias("repo"), *[F.col("_m")[f.split()[0]].alias(f.split()[0]) for f in FIELDS.split(", ") if not f.startswith("id ")])


def readme(json: Text) -> Column:
    """The README of flat metadata, else the first of nested ones, else ""."""
    own = F.nullif(F.get_json_object(col(json), "$.readme_markdown"), F.lit(""))
    inner = F.transform(F.filter(F.map_values(F.from_json(col(json), "map<string,string>")), lambda v: v.startswith("{")), lambda v: F.get_json_object(v, "$.readme_markdown"))
    return F.coalesce(own, F.get(F.filter(inner, lambda r: r.isNotNull() & (r != "")), F.lit(0)), F.lit(""))


def first_metadata(json: Text) -> Column:
    """The metadata with tags: the whole, else the first entry that has some, else the whole."""
    inner = F.filter(F.map_values(F.from_json(col(json), "map<string,string>")), lambda v: v.startswith("{") & F.get_json_object(v, "$.tags").isNotNull())
    return F.when(F.get_json_object(col(json), "$.tags").isNotNull(), col(json)).otherwise(F.coalesce(F.get(inner, F.lit(0)), col(json)))
