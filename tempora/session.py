"""Session defaults the plans rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Later keys win when maps are merged, timestamps are read as UTC, joins and partitions adapt at run time.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build(master: str | None = None, app: str = "tempora", **conf: str) -> SparkSession:
    """A session with SETTINGS; conf keys may use ``__`` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in (SETTINGS | {k.replace("__", "."): v for k, v in conf.items()}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
