"""Spark session settings the jobs rely on."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def build_session(app: str = "brightledger", master: str | None = None, **conf: str) -> SparkSession:
    """Session in UTC with adaptive execution; a cluster's own settings win over these."""
    builder = SparkSession.builder.appName(app)
    if master or "SPARK_MASTER" not in os.environ:
        builder = builder.master(master or "local[*]")
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.ui.enabled": "false",
    }
    settings.update({k.replace("__", "."): v for k, v in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
