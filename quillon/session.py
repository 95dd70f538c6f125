"""A session with the settings the engine counts on."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "quillon", master: str | None = None, **conf: str) -> SparkSession:
    """UTC dates, adaptive execution, and no search for the line of each column expression, which takes longer than
    making it; everything else is the cluster's, unless given."""
    b = SparkSession.builder.appName(name).config("spark.sql.session.timeZone", "UTC").config("spark.sql.adaptive.enabled", "true")
    b = b.config("spark.python.sql.dataFrameDebugging.enabled", "false")
    if master:
        b = b.master(master)
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    return b.getOrCreate()
