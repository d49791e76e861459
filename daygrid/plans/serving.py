"""Serving tables over the analytical ones: the latest day and coverage per calendar day."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrid.functions.numeric import share_pct
from daygrid.operators.spine import calendar_of
from daygrid.schemas import DAY

EXPECTED_ASSETS = 20


def latest_snapshot(daily: DataFrame) -> DataFrame:
    """Rows of the newest day."""
    newest = daily.agg(F.max(DAY).alias(DAY))
    return daily.join(F.broadcast(newest), DAY, "left_semi")  # one row


def day_counts(panel: DataFrame, daily: DataFrame, rank: DataFrame, rolling: DataFrame) -> DataFrame:
    """Rows per day of the four tables, and panel rows that carry volume and vwap.

    One aggregation over the four inputs: each contributes a single narrow column, so one
    map-side combined shuffle by day replaces four and their joins.
    """
    one = F.lit(1)
    parts = panel.select(
        DAY,
        one.alias("silver"),
        F.when(F.col("volume_usd_24hr").isNotNull(), one).alias("volume"),
        F.when(F.col("vwap_24hr").isNotNull(), one).alias("vwap"),
    )
    for name, table in (("daily", daily), ("rank", rank), ("weekly", rolling)):
        parts = parts.unionByName(table.select(DAY, one.alias(name)), allowMissingColumns=True)
    names = {
        "silver": "silver_row_count",
        "volume": "volume_row_count",
        "vwap": "vwap_row_count",
        "daily": "daily_snapshot_row_count",
        "rank": "rank_change_row_count",
        "weekly": "weekly_average_row_count",
    }
    return parts.groupBy(DAY).agg(*(F.count(c).cast("int").alias(alias) for c, alias in names.items()))


def availability(
    panel: DataFrame,
    daily: DataFrame,
    rank: DataFrame,
    rolling: DataFrame,
    end: date,
    start: date | None = None,
    expected: int = EXPECTED_ASSETS,
) -> DataFrame:
    """One row per calendar day from the first panel day (or ``start``) to ``end``.

    The spine comes from the calendar, so a day without any row is reported as missing.
    """
    counts = day_counts(panel, daily, rank, rolling)
    numbers = [c for c in counts.columns if c != DAY]
    covered = (
        calendar_of(panel, end, start)
        .join(counts, DAY, "left")
        .select(
            DAY,
            F.lit(expected).alias("expected_asset_count"),
            *(F.coalesce(c, F.lit(0)).alias(c) for c in numbers),
        )
    )
    silver, wanted = F.col("silver_row_count"), F.col("expected_asset_count")
    served = {
        "daily_snapshot": F.col("daily_snapshot_row_count"),
        "rank_change": F.col("rank_change_row_count"),
        "weekly_average": F.col("weekly_average_row_count"),
    }
    status = F.when(silver == 0, "missing").when(silver < wanted, "partial")
    reason = F.when(silver == 0, "silver_missing").when(silver < wanted, "silver_below_expected_count")
    for name, rows in served.items():
        status = status.when(rows != silver, "partial")
        reason = reason.when(rows == 0, f"{name}_missing").when(
            rows != silver, f"{name}_row_count_mismatch"
        )
    return covered.select(
        *covered.columns,
        share_pct(silver, wanted).alias("source_coverage_pct"),
        share_pct(served["daily_snapshot"], silver).alias("daily_snapshot_coverage_pct"),
        share_pct(F.col("volume_row_count"), silver).alias("volume_coverage_pct"),
        share_pct(F.col("vwap_row_count"), silver).alias("vwap_coverage_pct"),
        status.otherwise("available").alias("availability_status"),
        reason.alias("availability_reason"),
    )
