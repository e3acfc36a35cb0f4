"""Job results as a stream: an extension, the same counts as the batch report by window of time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.tracking import GOOD


def status_windows(jobs: DataFrame, time: str = "ts", length: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Jobs by window and task: all, good and bad; results later than `late` are left out."""
    good = F.col("status").isin(*GOOD)
    grouped = jobs.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late).groupBy(F.window(time, length), "task_type")
    return grouped.agg(F.count("*").alias("jobs"), F.count_if(good).alias("good"), F.count_if(~good).alias("bad")).select("window.start", "window.end", "task_type", "jobs", "good", "bad")
