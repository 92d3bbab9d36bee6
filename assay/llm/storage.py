"""Lineage cuts and bounds of Arrow batches for the corpus operators."""

from __future__ import annotations

from pyspark.sql import SparkSession

from ..session import ship
from ..storage import materialise, new_path, release, shared_dir

__all__ = ["bound_batches", "materialise", "new_path", "release", "shared_dir"]

ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def bound_batches(spark: SparkSession, limit: str = "16m") -> None:
    """Bounds the bytes of an Arrow batch, as texts differ in length, unless the cluster has set a bound of its own."""
    ship(spark)
    if not spark.sparkContext.getConf().contains(ARROW_BYTES):
        spark.conf.set(ARROW_BYTES, limit)
