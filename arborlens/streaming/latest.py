"""The census as a stream of device records, and resource logs by time window."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_records(stream: DataFrame, key: str = "uuid", date: str = "date", seq: str = "seq") -> DataFrame:
    """The latest row of each key so far; a state row a key, kept on the JVM side. Write it in update or complete mode."""
    last = F.max_by(F.struct(*stream.columns), F.struct(F.col(date), -F.col(seq))).alias("_last")
    return stream.groupBy(F.col(key).alias("_key")).agg(last).select("_last.*")


def usage_by_window(stream: DataFrame, time: str = "Time", window: str = "1 minute", late: str = "5 minutes") -> DataFrame:
    """Mean and largest use in each window; rows later than ``late`` are left out."""
    return stream.withWatermark(time, late).groupBy(F.window(time, window)).agg(F.avg("Percent").alias("mean_percent"), F.max("RAM").alias("max_ram")).select(F.col("window.start").alias("start"), "mean_percent", "max_ram")
