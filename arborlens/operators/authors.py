"""Who made a record: unsigned records take the first signature of the day, then of the ISO week, then a default. Only signed records have signatures to give."""

from __future__ import annotations

from arborlens.functions.text import normal_name
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNKNOWN = "unknown_mapper"


def infer_authors(df: DataFrame, crew: str = "crew", date: str = "date", seq: str = "seq", default: str = UNKNOWN, by_year: bool = False, normalise: bool = True) -> DataFrame:
    """df with the crew column filled. Weeks of different years are one week unless ``by_year``.

    First signatures are small aggregates (a row per day, a row per week) that are joined back; the date
    itself stays as it is. Records filled by day sign for no one: the week's first is the first signed one.
    """
    day, week = F.to_date(date), F.weekofyear(date)
    week = F.struct(F.extract(F.lit("YEAROFWEEK"), F.col(date)).alias("y"), week.alias("w")) if by_year else week
    signed = df.withColumn(crew, normal_name(F.col(crew))) if normalise else df
    signed = signed.withColumn("_day", day).withColumn("_week", week)
    by_day = signed.where(F.col(crew).isNotNull() & F.col("_day").isNotNull()).groupBy("_day").agg(F.min_by(crew, seq).alias("_by_day"))
    by_week = signed.where(F.col(crew).isNotNull() & F.col("_week").isNotNull()).groupBy("_week").agg(F.min_by(crew, seq).alias("_by_week"))
    done = signed.join(by_day, "_day", "left").join(by_week, "_week", "left").withColumn("_crew", F.coalesce(crew, "_by_day", "_by_week", F.lit(default)))
    return done.select(*[F.col("_crew").alias(c) if c == crew else F.col(c) for c in df.columns])
