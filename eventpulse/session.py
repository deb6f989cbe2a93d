"""Spark sessions with the settings that the engine's semantics rest on."""

from __future__ import annotations

import shutil
import tempfile
from pathlib import Path

from pyspark.sql import SparkSession

#: Fixed settings: one clock (UTC), strict casts, adaptive plans.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.requireAllClusterKeysForCoPartition": "false",  # a mart bucketed by repository serves joins on repository and day
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def session(master: str | None = None, name: str = "eventpulse", **more: str) -> SparkSession:
    """A session with these settings. ``master`` stays what the cluster says unless given."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **more}.items():
        builder = builder.config(key, value)
    return ship(builder.getOrCreate())


def ship(spark: SparkSession) -> SparkSession:
    """Give the executors this package, which functions that run there need; in a local session they have it."""
    if not spark.sparkContext.master.startswith("local["):
        package = Path(__file__).resolve().parent
        with tempfile.TemporaryDirectory() as folder:  # the driver's own: it serves the file, and keeps a copy to do so
            spark.sparkContext.addPyFile(shutil.make_archive(f"{folder}/{package.name}", "zip", package.parent, package.name))
    return spark
