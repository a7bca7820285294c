"""Event-time windows; each works on a batch and, with a watermark, on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _timed(events: DataFrame, time: str, late: str | None) -> DataFrame:
    # event-time operators want timestamps with a zone; the session's zone is UTC
    timed = events.withColumn(time, F.col(time).cast("timestamp"))
    return timed.withWatermark(time, late) if late else timed


def tumbling(events: DataFrame, time: str, width: str, *keys: str, late: str | None = None) -> DataFrame:
    """Events per window and key: keys, since, n. late: how long a stream waits for late events."""
    counted = _timed(events, time, late).groupBy(F.window(time, width).alias("__w"), *keys).agg(F.count("*").alias("n"))
    return counted.select(*keys, F.col("__w.start").alias("since"), "n")


def sessions(events: DataFrame, time: str, gap: str, *keys: str, late: str | None = None) -> DataFrame:
    """Events per session (no gap so long between neighbours) and key."""
    counted = _timed(events, time, late).groupBy(F.session_window(time, gap).alias("__w"), *keys).agg(F.count("*").alias("n"))
    return counted.select(*keys, F.col("__w.start").alias("since"), "n")


def watch_snapshots(spark, folder: str, schema, checkpoint: str, handle):
    """Run handle(batch, number) on each set of new JSON files of a folder, once each, then stop."""
    stream = spark.readStream.schema(schema).json(folder)
    return stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
