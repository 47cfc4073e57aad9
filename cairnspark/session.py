"""Session settings that the engine's results rely on, and those that make it fast."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.optimizer.nestedSchemaPruning.enabled": "true",
}


def session(name: str = "cairnspark", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(name).config(map=SETTINGS | settings)
    return (builder.master(master) if master else builder).getOrCreate()
