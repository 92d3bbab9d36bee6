"""New data only: folders and files as they come, jobs one at a time, a bounded history."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources.evaluations import SCHEMA

HISTORY = 50


def evaluation_stream(spark: SparkSession, root: str, max_files: int | None = None) -> DataFrame:
    """Evaluation files that are new since the last run; the checkpoint is the set of known files."""
    reader = spark.readStream.schema(SCHEMA).option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json")
    return (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).json(root)


def run_available(stream: DataFrame, checkpoint: str, step: Callable[[DataFrame, int], None], timeout: int = 3600) -> StreamingQuery:
    """Gives all that is new to `step` in micro-batches, one after the other, and stops; jobs that take too long are stopped."""
    query = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True).foreachBatch(step).start()
    if not query.awaitTermination(timeout):
        query.stop()
    return query


def _files(spark: SparkSession, path: str):
    """(file system, path as an object) of a folder."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def recover(spark: SparkSession, path: str) -> None:
    """Puts a table right that a crash left between two versions: forward to a new one that is complete, else back."""
    files, at = _files(spark, path)
    folder = spark._jvm.org.apache.hadoop.fs.Path
    old, new = folder(path + ".old"), folder(path + ".new")
    if not files.exists(at):
        if files.exists(folder(path + ".new/_SUCCESS")):
            files.rename(new, at)
        elif files.exists(old):
            files.rename(old, at)
    if files.exists(at) and files.exists(old):
        files.delete(old, True)


def replace(table: DataFrame, path: str) -> None:
    """Writes a table in place of the one at `path`, which the new one may be made from.

    The new version is complete before the old one moves aside; at any moment one of both is there for recover().
    """
    spark = table.sparkSession
    table.write.mode("overwrite").parquet(path + ".new")
    files, at = _files(spark, path)
    folder = spark._jvm.org.apache.hadoop.fs.Path
    if files.exists(at):
        files.rename(at, folder(path + ".old"))
    files.rename(folder(path + ".new"), at)
    files.delete(folder(path + ".old"), True)


def upsert(path: str, key: str, order: str | None = None) -> Callable[[DataFrame, int], None]:
    """A step that keeps one row a key in a table: a batch's rows replace older ones.

    Of a batch's rows with one key that with the largest `order` counts, without one that with the largest hash of all columns.
    """

    def step(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        recover(spark, path)
        last = F.xxhash64(*batch.columns) if order is None else F.struct(F.col(order), F.xxhash64(*batch.columns))
        new = batch.groupBy(F.col(key).alias("_key")).agg(F.max_by(F.struct(*batch.columns), last).alias("_row")).select("_row.*")
        files, at = _files(spark, path)
        replace(spark.read.parquet(path).join(new, key, "left_anti").unionByName(new) if files.exists(at) else new, path)

    return step


def pending(queue: str, new: str):
    """A queue with new entries at its end, none twice."""
    return F.array_union(queue, new)


def history(jobs: DataFrame, order: str, limit: int = HISTORY) -> DataFrame:
    return jobs.orderBy(F.desc(order)).limit(limit)


def windowed_counts(events: DataFrame, ts: str, keys: list[str], size: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """Counts in event-time windows; rows later than the watermark are dropped by a streaming run."""
    return events.withWatermark(ts, late).groupBy(F.window(ts, size), *keys).agg(F.count("*").alias("n"))
