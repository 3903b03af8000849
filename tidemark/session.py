"""Spark sessions with the settings that results depend on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build(name: str = "tidemark", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with adaptive execution; other settings are the caller's or the cluster's."""
    b = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true").config("spark.sql.adaptive.skewJoin.enabled", "true").config("spark.sql.sources.partitionOverwriteMode", "dynamic")
    if master:
        b = b.master(master)
    for key, value in conf.items():
        b = b.config(key.replace("__", "."), value)
    return b.getOrCreate()
