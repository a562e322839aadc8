"""Windowed counts over an event stream: an extension, the batch engine has no streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def event_rates(events: DataFrame, window: str = "1 hour", late: str = "1 day", ts: str = "ts") -> DataFrame:
    """Events and their mean value per type and window; rows later than the watermark allows are dropped."""
    rows = events.withColumn("_ts", F.col(ts).cast("timestamp")).withWatermark("_ts", late)
    out = rows.groupBy(F.window("_ts", window), "event_type").agg(F.count("*").alias("n"), F.avg("value").alias("mean"))
    return out.select(F.col("window.start").alias("start"), "event_type", "n", "mean")
