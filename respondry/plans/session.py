"""Session settings the plans are designed for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # splits a join partition made large by one key
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # bounds the Arrow batches of the neighbour and scoring steps
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
}


def session(name: str = "respondry", **overrides: str) -> SparkSession:
    """Session with :data:`SETTINGS`; master, memory and the shared folder are the caller's."""
    builder = SparkSession.builder.appName(name)
    for key, value in {**SETTINGS, **overrides}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
