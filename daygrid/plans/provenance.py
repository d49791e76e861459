"""Audit of when each landed file was really fetched.

``files`` has ``snapshot_date`` (the label), ``api_timestamp_ms`` and ``fetched_at_utc``; the
last two are NULL for files written before they were recorded. Such files are counted as
unauditable, never as clean.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrid.functions.dates import hours_after_day_start
from daygrid.schemas import API_TIMESTAMP, DAY, FETCHED_AT

MAX_LAG_HOURS = 36


def with_fetch_lag(files: DataFrame) -> DataFrame:
    return files.withColumn("lag_hours", hours_after_day_start(F.col(FETCHED_AT), F.col(DAY)))


def is_late(max_lag_hours: int = MAX_LAG_HOURS):
    """Fetched before the labelled day began or too long after; NULL when unknown."""
    return (F.col("lag_hours") < 0) | (F.col("lag_hours") > max_lag_hours)


def mislabelled(files: DataFrame, max_lag_hours: int = MAX_LAG_HOURS) -> DataFrame:
    """Files whose fetch time does not belong to their label, with the lag and ``early`` or ``late``."""
    late = with_fetch_lag(files).where(is_late(max_lag_hours))
    reason = F.when(F.col("lag_hours") < 0, F.lit("early")).otherwise(F.lit("late"))
    return late.withColumn("reason", reason)


def duplicate_fetches(files: DataFrame) -> DataFrame:
    """Responses stored under several days: response time and the sorted days.

    (response, day) pairs are made distinct first, so a response copied any number of times
    weighs one row per day, and its list is bounded by the calendar.
    """
    pairs = files.where(F.col(API_TIMESTAMP).isNotNull()).select(API_TIMESTAMP, DAY).distinct()
    dates = pairs.groupBy(API_TIMESTAMP).agg(F.sort_array(F.collect_set(DAY)).alias("dates"))
    return dates.where(F.size("dates") > 1)


def provenance_coverage(files: DataFrame) -> DataFrame:
    """One row: files that can be audited, files that cannot, first auditable day."""
    known = F.col(FETCHED_AT).isNotNull() | F.col(API_TIMESTAMP).isNotNull()
    return files.agg(
        F.count_if(known).alias("known_count"),
        F.count(F.lit(1)).alias("total_count"),
        F.count_if(~known).alias("unknown_count"),
        F.min(F.when(known, F.col(DAY))).alias("earliest_auditable_date"),
    )


def audit_clean(files: DataFrame, max_lag_hours: int = MAX_LAG_HOURS) -> bool:
    """Whether nothing is mislabelled or duplicated."""
    return mislabelled(files, max_lag_hours).isEmpty() and duplicate_fetches(files).isEmpty()
