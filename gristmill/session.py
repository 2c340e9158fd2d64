"""Session defaults."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
}


def session(name: str = "gristmill", **conf: str) -> SparkSession:
    """The running session, or a new one with these defaults; local unless a master is set."""
    builder = SparkSession.builder.appName(name).config(map=DEFAULTS | conf)
    if not any(k in os.environ for k in ("MASTER", "SPARK_MASTER")) and SparkSession.getActiveSession() is None and "spark.master" not in conf:
        builder = builder.config("spark.sql.shuffle.partitions", conf.get("spark.sql.shuffle.partitions", str(os.cpu_count() or 8)))
    return builder.getOrCreate()


def tasks_of(spark: SparkSession) -> int:
    """Tasks for rows that take long for their bytes, which would come a whole table to a task."""
    return max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
