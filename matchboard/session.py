"""Spark session with the settings the jobs rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Timestamps are compared with naive wall-clock bounds.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # Splits a hot key of a sort-merge join; see operators.keys.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A weekly rewrite replaces its own partition only.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(
    app: str = "matchboard", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    """Get or create a session; ``master`` stays with spark-submit unless given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
