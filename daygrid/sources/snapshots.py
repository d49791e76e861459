"""Landed snapshot and history files."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrid.functions.dates import Span, in_span
from daygrid.schemas import API_TIMESTAMP, DAY, FETCHED_AT, SNAPSHOT_FILE


def dated_folder(day: date) -> str:
    """Folder of one day, relative to the root of the landed files."""
    return f"year={day.year}/month={day.month:02d}/day={day.day:02d}"


def read_snapshots(spark: SparkSession, root: str, span: Span | None = None) -> DataFrame:
    """Landed snapshot files as declared strings, with ``snapshot_date`` from the folder.

    One scan for the whole range: the predicate uses partition columns only, so other days
    are never listed into tasks. Columns a file lacks are NULL, columns it adds are ignored.
    """
    files = spark.read.schema(SNAPSHOT_FILE).parquet(root)
    dated = files.withColumn(DAY, F.make_date("year", "month", "day"))
    return in_span(dated, DAY, span).drop("year", "month", "day")


def history_folder(anchor: date, days: int, dataset: str) -> str:
    """Place of one dataset of one backfill, relative to the root of the landed files."""
    return f"anchor_date={anchor.isoformat()}/window_days={days}/{dataset}.parquet"


def read_history(spark: SparkSession, root: str, anchor: date, days: int, dataset: str) -> DataFrame:
    """One history dataset of one backfill; files of several vintages are merged by name."""
    path = f"{root}/{history_folder(anchor, days, dataset)}"
    return spark.read.option("basePath", root).option("mergeSchema", "true").parquet(path)


def provenance(snapshots: DataFrame, *keys: str) -> DataFrame:
    """When each day (or each of ``keys``) was fetched; NULL for files without these columns."""
    keys = keys or (DAY,)
    return snapshots.groupBy(*keys).agg(
        F.min(API_TIMESTAMP).alias(API_TIMESTAMP), F.min(FETCHED_AT).alias(FETCHED_AT)
    )
