"""SparkSession factory."""

from __future__ import annotations

from pyspark.sql import SparkSession


def spark_session(app: str = "sparvane", **conf: str) -> SparkSession:
    """A session with UTC, adaptive execution and ANSI semantics; conf overrides, e.g. ``{"spark.master": "local[8]"}``."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.ansi.enabled": "true",
    } | conf
    builder = SparkSession.builder.appName(app)
    for k, v in settings.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
