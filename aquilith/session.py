"""The session that results depend on: UTC, and adaptive execution."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build(master: str | None = None, app: str = "aquilith", **conf: str) -> SparkSession:
    """A session in UTC; dates derived from timestamps shift in any other zone."""
    builder = SparkSession.builder.appName(app).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def in_utc(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark
