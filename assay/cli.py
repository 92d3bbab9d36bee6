"""Command line: `python -m assay.cli generate|list|show|validate`."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.names import slug
from .operators import evaluations
from .plans.evaluation import prepare
from .session import session, ship
from .sources import files
from .storage import materialise


def generate(spark: SparkSession, root: str, out: str, only: list[str] | None = None, max_files: int = 50, collapse: bool = True) -> DataFrame:
    """Writes a summary for each benchmark under root, by slug, and returns (bench, status). Summaries that exist are skipped."""
    found = prepare(spark, root, max_files, collapse)
    scores = found.scores
    if only:
        named = scores.groupBy("bench").agg(F.min_by("display_name", "ord").alias("name"))
        scores = scores.join(evaluations.filtered(named, found.suites, only).select("bench"), "bench", "left_semi")
    summaries, _ = materialise(evaluations.summary(scores).withColumn("key", slug("bench")), "summaries")
    at = spark._jvm.org.apache.hadoop.fs.Path(out)
    if at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        done = spark.read.json(out).select("key").distinct()
        fresh = summaries.join(done, "key", "left_anti")
    else:
        fresh = summaries
    status = summaries.select("bench", "key").join(fresh.select("key", F.lit(True).alias("_new")), "key", "left").select("bench", F.when(F.col("_new"), "written").otherwise("skipped").alias("status"))
    rows = status.collect()
    fresh.write.mode("append").json(out)
    return spark.createDataFrame(rows, status.schema)


def sessions(spark: SparkSession, root: str, recent: int = 10, completed: bool = False) -> DataFrame:
    rows = files.sessions(spark, root)
    return (rows.where("completed") if completed else rows).orderBy(F.desc("modified"), "session").limit(recent)


def show(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The files of one session with their sizes."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{root.rstrip('/')}/{name}")
    return listing.select("path", "length", "modificationTime").orderBy("path")


def validate(spark: SparkSession) -> DataFrame:
    """What the engine needs, and whether it is there."""
    conf = lambda k: spark.conf.get(k, None)
    checks = [("spark", spark.version, spark.version >= "4"), ("time zone", conf("spark.sql.session.timeZone"), conf("spark.sql.session.timeZone") == "UTC"), ("adaptive execution", conf("spark.sql.adaptive.enabled"), conf("spark.sql.adaptive.enabled") == "true"), ("shared folder", conf("spark.checkpoint.dir"), bool(conf("spark.checkpoint.dir")))]
    for module in ("numpy", "pandas", "pyarrow"):
        checks.append((module, getattr(__import__(module), "__version__", None), True))
    return spark.createDataFrame(checks, "what string, value string, ok boolean")


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="assay")
    commands = parser.add_subparsers(dest="command", required=True)
    g = commands.add_parser("generate")
    g.add_argument("root")
    g.add_argument("out")
    g.add_argument("-b", "--benchmarks", help="names, separated by commas; a suite stands for its members")
    g.add_argument("--max-files", type=int, default=50)
    g.add_argument("--no-collapse", action="store_true")
    g = commands.add_parser("list")
    g.add_argument("root")
    g.add_argument("--recent", type=int, default=10)
    g.add_argument("--completed", action="store_true")
    g.add_argument("--format", choices=("table", "json"), default="table")
    g = commands.add_parser("show")
    g.add_argument("root")
    g.add_argument("session")
    commands.add_parser("validate")
    a = parser.parse_args(args)
    spark = ship(session())
    if a.command == "generate":
        out = generate(spark, a.root, a.out, a.benchmarks.split(",") if a.benchmarks else None, a.max_files, not a.no_collapse)
    elif a.command == "list":
        out = sessions(spark, a.root, a.recent, a.completed)
        if a.format == "json":
            print("\n".join(out.toJSON().collect()))
            return 0
    elif a.command == "show":
        out = show(spark, a.root, a.session)
    else:
        out = validate(spark)
        out.show(100, False)
        return 0 if out.where("NOT ok").count() == 0 else 1
    out.show(1000, False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
