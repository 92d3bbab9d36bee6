"""Driver-side helpers: retries, and paths in any file system that Spark knows."""

from __future__ import annotations

import time
from collections.abc import Callable
from typing import TypeVar

from pyspark.sql import SparkSession

Result = TypeVar("Result")


def retried(call: Callable[[], Result], attempts: int = 3, delay: float = 5.0, backoff: float = 2.0, wait: Callable[[float], None] = time.sleep) -> Result:
    """The result of a call that may fail for a moment; waits delay, delay * backoff, ... between attempts, the last failure is raised.

    For calls of the driver, such as a job over a service; tasks are retried by Spark.
    """
    for attempt in range(attempts):
        try:
            return call()
        except Exception:
            if attempt + 1 == attempts:
                raise
            wait(delay * backoff**attempt)
    raise ValueError("attempts is at least 1")


def qualified(spark: SparkSession, path: str, must_exist: bool = True) -> str:
    """The full address of a path; an error if it has to be there and is not."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    full = files.makeQualified(at)
    if must_exist and not files.exists(full):
        raise FileNotFoundError(str(full))
    return full.toString()
