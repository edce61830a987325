"""Windowed counts over event streams, the same plan for a table and for a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def event_counts(events: DataFrame, size: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events by type in tumbling windows: count and sum. On a stream, windows close once the watermark passes them."""
    timed = events.withColumn("ts", F.col("ts").cast("timestamp"))  # watermarks need an instant
    timed = timed.withWatermark("ts", late) if events.isStreaming else timed
    counts = timed.groupBy(F.window("ts", size).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return counts.select(F.col("w.start").alias("window_start"), "event_type", "n", "total")
