"""Session settings the jobs are written for."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def build_session(app: str = "cutgrid", cores: str | int | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution on.

    Without `cores` the master comes from spark-submit, and so does the number of shuffle
    partitions; adaptive execution merges small ones and splits skewed ones at run time.
    """
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if cores is not None:
        builder = (
            builder.master(f"local[{cores}]")
            .config("spark.sql.shuffle.partitions", str(cores))
            .config("spark.driver.memory", os.environ.get("CUTGRID_DRIVER_MEMORY", "12g"))
            .config("spark.ui.enabled", "false")
        )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
