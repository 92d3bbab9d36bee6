"""Sessions with the settings the engine relies on."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import SparkSession

HOME = str(Path(__file__).resolve().parent.parent)

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(name: str = "assay", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(name).config(map=SETTINGS | {k.replace("__", "."): v for k, v in settings.items()})
    return (builder.master(master) if master else builder).getOrCreate()


def ship(spark: SparkSession) -> SparkSession:
    """Lets Python workers on this machine import the package; on a cluster pass it with --py-files."""
    workers = getattr(spark.sparkContext, "environment", None)
    if workers is not None:
        known = workers.get("PYTHONPATH", "").split(os.pathsep)
        if HOME not in known:
            workers["PYTHONPATH"] = os.pathsep.join([HOME, *filter(None, known)])
    return spark
