"""Session settings that the library expects."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: UTC everywhere, reload of single partitions, and runtime re-planning of skewed joins.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def build_session(name: str = "spotlake", **settings: str) -> SparkSession:
    """A session with ``SETTINGS``, and with further ones given as keywords (``__`` for dots)."""
    builder = SparkSession.builder.appName(name)
    for key, value in (SETTINGS | {k.replace("__", "."): v for k, v in settings.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
