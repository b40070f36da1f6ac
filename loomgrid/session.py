"""Session factory: UTC, adaptive execution, modest defaults that a cluster's own settings override."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(master: str | None = None, name: str = "loomgrid", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    defaults = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
    }
    for key, value in (defaults | conf).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
