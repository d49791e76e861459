"""Which days are there: inventories from paths, what to load next, freshness."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrid.functions.text import date_from_path
from daygrid.schemas import DAY

MAX_AGE_DAYS = 2


def list_files(spark: SparkSession, root: str) -> DataFrame:
    """Paths, sizes and modification times below ``root``; file contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    return files.select("path", "length", "modificationTime")


def dates_from_paths(files: DataFrame, path: str = "path") -> DataFrame:
    """Distinct days of paths in the dated layout; other paths are ignored."""
    days = files.select(date_from_path(F.col(path)).alias(DAY))
    return days.where(F.col(DAY).isNotNull()).distinct()


def sync_plan(
    captured: DataFrame,
    local: DataFrame,
    start: date | None = None,
    end: date | None = None,
    overwrite: bool = False,
) -> DataFrame:
    """Days to load: captured and not yet local (all captured ones with ``overwrite``).

    Either bound may be given alone.
    """
    days = captured.select(DAY).distinct()
    if start is not None:
        days = days.where(F.col(DAY) >= F.lit(start))
    if end is not None:
        days = days.where(F.col(DAY) <= F.lit(end))
    return days if overwrite else days.join(local.select(DAY).distinct(), DAY, "left_anti")


def within_cap(plan: DataFrame, max_days: int) -> DataFrame:
    """Return the plan, or raise when it holds more days than one run may load."""
    if plan.limit(max_days + 1).count() > max_days:
        raise ValueError(f"the plan has more than {max_days} days; narrow it with start or end")
    return plan


def freshness(captured: DataFrame, as_of: date, max_age_days: int = MAX_AGE_DAYS) -> DataFrame:
    """One row: newest day, its age, and disabled / empty / stale / fresh."""
    newest = captured.agg(F.max(DAY).alias("newest_date"))
    age = F.datediff(F.lit(as_of), F.col("newest_date"))
    status = (
        F.when(F.lit(max_age_days <= 0), F.lit("disabled"))
        .when(F.col("newest_date").isNull(), F.lit("empty"))
        .when(age > max_age_days, F.lit("stale"))
        .otherwise(F.lit("fresh"))
    )
    return newest.select("newest_date", age.alias("age_days"), status.alias("status"))


def require_fresh(captured: DataFrame, as_of: date, max_age_days: int = MAX_AGE_DAYS) -> None:
    """Raise when files have stopped arriving: nothing new and nothing at all look alike otherwise."""
    row = freshness(captured, as_of, max_age_days).first()
    if row.status in ("empty", "stale"):
        raise RuntimeError(f"captures are {row.status}: newest day {row.newest_date}, age {row.age_days}")
