"""Session settings the library is tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # splits a join partition that one hot customer or order has inflated
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(app: str = "encore", master: str | None = None, **settings: str) -> SparkSession:
    """Start (or get) a session; ``settings`` override the defaults above.

    Keyword names use ``__`` for the dots of a Spark setting, e.g.
    ``spark__sql__shuffle__partitions="4000"``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    overrides = {name.replace("__", "."): value for name, value in settings.items()}
    for name, value in {**SETTINGS, **overrides}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
