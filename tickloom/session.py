"""Session defaults."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.aggregatePushdown": "true",
    # INT96 has no statistics: neither pruning nor bounds from footers.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}


def session(name: str = "tickloom", **more: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    for k, v in (DEFAULTS | more).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
