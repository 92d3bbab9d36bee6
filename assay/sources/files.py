"""Other file sources and sinks: catalogs, sessions, checklists, artifacts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import checklist_item

# Name spaces of catalog references.
NAMESPACES = ("augmentors", "benchmarks", "cards", "formats", "metrics", "operators", "processors", "serializers", "splitters", "system_prompts", "tasks", "templates", "types")


def catalog(spark: SparkSession, root: str) -> DataFrame:
    """(ref_id, bucket, json) of a catalog of JSON files; a file's id is its path below root, dotted."""
    base = "/" + root.split(":", 1)[-1].strip("/") + "/"
    rows = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", "*.json").text(root, wholetext=True)
    path = F.regexp_replace(F.col("_metadata.file_path"), "^[a-z]+:/*", "/")
    ref = F.translate(F.regexp_replace(F.substr(path, F.lit(len(base) + 1)), r"\.json$", ""), "/", ".")
    return rows.select(ref.alias("ref_id"), F.substring_index(ref, ".", 1).alias("bucket"), F.col("value").alias("json"))


def candidates(name: str) -> list[str]:
    """Ids under which a benchmark may be in the catalog, in order."""
    return [f"benchmarks.{name}", f"cards.{name}"]


def references(entries: DataFrame) -> DataFrame:
    """(src, dst): the ids in known name spaces that an entry's JSON mentions."""
    found = F.regexp_extract_all("json", F.lit(r'"((?:' + "|".join(NAMESPACES) + r')\.[A-Za-z0-9_.\-]+)'), 1)
    return entries.select(F.col("ref_id").alias("src"), F.explode(F.array_distinct(found)).alias("dst")).where("src <> dst")


def card_names(entries: DataFrame) -> DataFrame:
    return entries.where("bucket = 'cards'").select(F.regexp_replace("ref_id", r"^cards\.", "").alias("name"))


def repository_index(entries: DataFrame) -> DataFrame:
    """(key, value, ord): loader path and the card that uses it; the first card of equals is kept by lookups."""
    path = F.get_json_object("json", "$.loader.path")
    return entries.where("bucket = 'cards'").select(path.alias("key"), F.col("ref_id").alias("value"), F.col("ref_id").alias("ord")).where("key IS NOT NULL")


def checklist(spark: SparkSession, path: str) -> DataFrame:
    """Names of unticked items."""
    return spark.read.text(path).select(checklist_item("value").alias("name")).where("name IS NOT NULL")


def latest(artifacts: DataFrame, key: str, path: str = "path") -> DataFrame:
    """The artifact with the last path of each key."""
    return artifacts.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(F.desc(path)))).where("_r = 1").drop("_r")


def sessions(spark: SparkSession, root: str, cards: str = "card") -> DataFrame:
    """(session, files, bytes, tools, modified, completed) of an output folder of sessions. File contents are not read."""
    base = "/" + root.split(":", 1)[-1].strip("/") + "/"
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root).select("path", "modificationTime", "length")
    relative = F.substr(F.regexp_replace("path", "^[a-z]+:/*", "/"), F.lit(len(base) + 1))
    parts = F.split(relative, "/")
    tool = F.when((F.size(parts) > 3) & (parts[1] == "tool_output"), parts[2])
    return listing.select(parts[0].alias("session"), tool.alias("tool"), "modificationTime", "length", relative.contains(f"/{cards}/").alias("is_card")).groupBy("session").agg(
        F.count("*").alias("files"), F.sum("length").alias("bytes"), F.countDistinct("tool").alias("tools"), F.max("modificationTime").alias("modified"), F.max("is_card").alias("completed")
    )


def write_cards(cards: DataFrame, path: str) -> None:
    cards.write.mode("overwrite").option("ignoreNullFields", "false").json(path)


def write_artifacts(rows: DataFrame, path: str, tool: str = "tool") -> None:
    rows.write.mode("append").partitionBy(tool).json(path)


def write_lines(rows: DataFrame, path: str) -> None:
    """One JSON object a line."""
    rows.select(F.to_json(F.struct(*rows.columns)).alias("value")).write.mode("overwrite").text(path)


def retrieval_results(spark: SparkSession, path: str) -> DataFrame:
    """(path, json) of result files: JSON files whole, of JSON lines the first line only."""
    rows = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    return rows.select("path", F.when(F.col("path").endswith(".jsonl"), F.substring_index("value", "\n", 1)).otherwise(F.col("value")).alias("json"))


def in_catalog(entries: DataFrame, names: DataFrame, name: str = "name", fallback: DataFrame | None = None) -> DataFrame:
    """(name, ref_id, json): the entry of each name, as a benchmark before a card; of a custom catalog before the library's.

    A name is an exact id below its name space, or a file's stem.
    """
    both = entries.select("ref_id", "json", F.lit(0).alias("_c"))
    both = both if fallback is None else both.unionByName(fallback.select("ref_id", "json", F.lit(1).alias("_c")))
    wanted = names.select(F.col(name).alias("name")).distinct().select("name", F.posexplode(F.array(F.concat(F.lit("benchmarks."), "name"), F.concat(F.lit("cards."), "name"), F.col("name"))).alias("_o", "ref_id"))
    return wanted.join(both, "ref_id").groupBy("name").agg(F.min_by(F.struct("ref_id", "json"), F.struct("_c", "_o")).alias("e")).select("name", "e.*")
