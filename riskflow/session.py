"""Session settings the operators are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "riskflow", master: str | None = None, **conf: object) -> SparkSession:
    """A session with adaptive execution on; extra settings by keyword, dots as ``__``."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
    settings.update({key.replace("__", "."): str(value) for key, value in conf.items()})
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
