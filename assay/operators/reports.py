"""Counts and tails of job logs, first and last rows of groups, neighbours in a sequence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def histogram(rows: DataFrame, reason: Column | str, name: str = "reason") -> DataFrame:
    """(reason, n)."""
    return rows.groupBy((F.col(reason) if isinstance(reason, str) else reason).alias(name)).agg(F.count("*").alias("n"))


def success_rate(done: Column, failed: Column) -> Column:
    """Per cent of what ended well, one decimal; 0 if nothing ended. For use in agg()."""
    n, bad = F.count_if(done), F.count_if(failed)
    return F.round(F.coalesce(F.try_divide(n, n + bad) * 100, F.lit(0.0)), 1)


def outcomes(jobs: DataFrame, status: str, **prefixes: str) -> DataFrame:
    """One row: how many jobs have a status with each prefix, and all jobs."""
    return jobs.agg(*[F.count_if(F.col(status).startswith(p)).alias(name) for name, p in prefixes.items()], F.count("*").alias("jobs"))


def first_of_equals(rows: DataFrame, key: Column, order: str) -> DataFrame:
    """Of rows with one key that with the least `order`; the rest of the row comes with it."""
    return rows.groupBy(key.alias("_key")).agg(F.min_by(F.struct(*rows.columns), order).alias("_row")).select("_row.*")


def recent(rows: DataFrame, order: list[Column], limit: int) -> DataFrame:
    """The `limit` first rows in order: a report of the latest, a bounded history."""
    return rows.orderBy(*order).limit(limit)


def near_hits(rows: DataFrame, key: str, order: str, hit: Column, distance: int = 1) -> DataFrame:
    """Rows with a hit at most `distance` places away in their group."""
    around = Window.partitionBy(key).orderBy(order).rowsBetween(-distance, distance)
    return rows.withColumn("_near", F.max(hit.cast("int")).over(around)).where("_near = 1").drop("_near")


def appended(rows: DataFrame, key: str, order: str, entry: str, name: str = "log") -> DataFrame:
    """(key, log): the entries of each key in order, as the append reducer of a log leaves them."""
    return rows.groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(entry).alias("e")))), lambda s: s["e"]).alias(name))


def flag_counters(scored: DataFrame, low: float = 0.3) -> DataFrame:
    """One row: atoms below `low`, and those together with the neutral ones."""
    p = F.col("p_true")
    return scored.agg(F.count_if(p < low).alias("low"), F.count_if((p < low) | (p == 0.5)).alias("low_or_neutral"))
