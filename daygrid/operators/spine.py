"""Calendar spine: one row per day, whether or not there is data."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrid.schemas import DAY


def explode_days(bounds: DataFrame, start: str = "start_day", end: str = "end_day") -> DataFrame:
    """Every day of each (start, end) row; a reversed pair gives no day."""
    days = F.sequence(F.col(start), F.col(end), F.expr("INTERVAL 1 DAY"))
    return bounds.select(F.explode(F.when(F.col(start) <= F.col(end), days)).alias(DAY))


def calendar(spark: SparkSession, start: date, end: date) -> DataFrame:
    """The days from ``start`` to ``end``, inclusive; none when ``start`` is after ``end``."""
    bounds = spark.range(1).select(F.lit(start).alias("start_day"), F.lit(end).alias("end_day"))
    return explode_days(bounds)


def calendar_of(df: DataFrame, end: date, start: date | None = None) -> DataFrame:
    """The days from the first day of ``df`` (or ``start``) to ``end``; empty data starts at ``end``."""
    if start is not None:
        return calendar(df.sparkSession, start, end)
    bounds = df.agg(F.coalesce(F.min(DAY), F.lit(end)).alias("start_day")).select(
        "start_day", F.lit(end).alias("end_day")
    )
    return explode_days(bounds)


def missing_days(spine: DataFrame, present: DataFrame) -> DataFrame:
    """Days of the spine on which ``present`` has no row."""
    return spine.join(present.select(DAY).distinct(), DAY, "left_anti")
