"""Generated dimension sources."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def minutes_of_day(spark: SparkSession) -> DataFrame:
    """1440 rows: minute number 0..1439."""
    return spark.range(1440).select(F.col("id").cast("int").alias("minute_of_day"))


def days_between(spark: SparkSession, start: date, end: date) -> DataFrame:
    """One row per day, both ends included."""
    return spark.range(1).select(
        F.explode(F.sequence(F.lit(start), F.lit(end), F.expr("interval 1 day"))).alias("day")
    )
