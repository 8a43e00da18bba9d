"""Session defaults the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Date and timestamp comparisons in validity intervals need one zone.
    "spark.sql.session.timeZone": "UTC",
    # Skewed join partitions are split and small ones merged at run time.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Also where a later grouping could reuse the partitions: a key with a third
    # of the rows costs more than one more shuffle of partial results.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The JVM leaves methods over 8000 bytes uncompiled. Wide hashes and wide
    # projections exceed that, and run faster as separate smaller methods.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app: str = "martflow", master: str | None = None, **extra: str) -> SparkSession:
    """Create or reuse a session; ``extra`` overrides or adds Spark settings."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
