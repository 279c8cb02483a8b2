"""Session settings this engine's plans run best with."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Runtime re-planning: partition coalescing, skew-join splitting, joins turned into broadcasts
    # once a side is measured to be small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Wide rule sets generate long methods, which the JVM does not compile beyond 8000 bytes of
    # byte code; from there on Spark's split-up row-wise code is the faster one.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    "spark.sql.session.timeZone": "UTC",
}


def builder(app: str = "assaymill") -> SparkSession.Builder:
    """A session builder with the settings, and without the per-call source capture of the Python
    API, which slows down the building of generated plans."""
    out = SparkSession.builder.appName(app).config(
        "spark.python.sql.dataFrameDebugging.enabled", "false")
    for key, value in SETTINGS.items():
        out = out.config(key, value)
    return out


def tune(spark: SparkSession) -> SparkSession:
    """Put the settings on a session that exists."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark
