"""Dashboard reports and key figures. ``as_of`` stands for the current date."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daygrid.functions.dates import Span, in_span
from daygrid.operators.bounded import bounded
from daygrid.schemas import DAY


def filtered_market(
    daily: DataFrame,
    span: Span | None = None,
    symbols: Sequence[str] | None = None,
    ranks: tuple[int, int] | None = None,
) -> DataFrame:
    """The three dashboard filters: date range, symbols, rank range."""
    df = in_span(daily, DAY, span)
    if symbols is not None:
        df = df.where(F.col("symbol").isin(list(symbols)))
    if ranks is not None:
        df = df.where(F.col("coin_rank").between(*ranks))
    return df


def last_days(df: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    """The ``days`` completed days before ``as_of``."""
    return in_span(df, DAY, (as_of - timedelta(days=days), as_of - timedelta(days=1)))


def latest_market(latest: DataFrame, n: int = 100) -> DataFrame:
    """The newest day by rank: the first ``n`` rows, and ``truncated``, whether there are more."""
    top = bounded(latest, [F.asc_nulls_last("coin_rank"), "coin_id"], n, ceiling=None)
    return top.select(
        DAY, "coin_rank", "symbol", "name", "price_usd", "price_change_pct",
        "market_cap_usd", "volume_usd_24hr", "truncated",
    )


def movers(latest: DataFrame, n: int = 25) -> DataFrame:
    """Largest change per symbol: the first ``n`` symbols, and ``truncated``."""
    by_symbol = latest.groupBy("symbol").agg(F.max("price_change_pct").alias("price_change_pct"))
    return bounded(by_symbol, [F.desc_nulls_last("price_change_pct"), "symbol"], n, ceiling=None)


def largest_symbols(df: DataFrame, n: int) -> DataFrame:
    """The ``n`` symbols with the greatest mean market cap."""
    caps = df.groupBy("symbol").agg(F.avg("market_cap_usd").alias("_cap"))
    return caps.orderBy(F.desc_nulls_last("_cap"), "symbol").limit(n).select("symbol")


def _of_largest(df: DataFrame, n: int) -> DataFrame:
    chosen = F.broadcast(largest_symbols(df, n).withColumnRenamed("symbol", "_symbol"))  # n rows
    return df.join(chosen, F.col("symbol").eqNullSafe(F.col("_symbol")), "left_semi")


def cumulative_change(daily: DataFrame, as_of: date, days: int = 30, n: int = 8) -> DataFrame:
    """Running sum of the daily change of the ``n`` largest symbols over the last ``days`` days.

    A day without a known change leaves the line flat.
    """
    recent = _of_largest(last_days(daily, as_of, days), n)
    per_day = recent.groupBy("symbol", DAY).agg(F.avg("price_change_pct").alias("price_change_pct"))
    so_far = Window.partitionBy("symbol").orderBy(DAY).rowsBetween(Window.unboundedPreceding, 0)
    return per_day.select(
        "symbol", DAY, F.round(F.sum("price_change_pct").over(so_far), 6).alias("cumulative_change_pct")
    )


def rank_table(rank_change: DataFrame, n: int = 25) -> DataFrame:
    """Current standings: newest day first, then by rank; the first ``n`` rows, and ``truncated``."""
    top = bounded(rank_change, [F.desc(DAY), F.asc_nulls_last("mc_rank"), "coin_id"], n, ceiling=None)
    return top.select(
        DAY, "mc_rank", "symbol", "name", "mc_rank_diff_14d", "mc_rank_diff_30d",
        "price_diff_14d_pct", "price_diff_30d_pct", "truncated",
    )


def price_vs_rolling(rolling: DataFrame, as_of: date, days: int = 30, n: int = 1) -> DataFrame:
    """Price and its rolling mean per day for the ``n`` largest symbols."""
    recent = _of_largest(last_days(rolling, as_of, days), n)
    return recent.groupBy("symbol", DAY).agg(
        F.avg("price_usd").alias("price_usd"),
        F.avg("wkly_roll_avg_price").alias("wkly_roll_avg_price"),
    )


def freshness_days(availability: DataFrame, as_of: date) -> DataFrame:
    """Days since the last day that is not missing."""
    last = F.max(F.when(F.col("availability_status") != "missing", F.col(DAY)))
    return availability.agg(F.datediff(F.lit(as_of), last).alias("days_since_last_snapshot"))


def coverage_30d(availability: DataFrame, as_of: date) -> DataFrame:
    """Share of the last 30 completed days that are available."""
    completed = F.col(DAY).between(
        F.lit(as_of - timedelta(days=30)), F.lit(as_of - timedelta(days=1))
    )
    good = F.count_if((F.col("availability_status") == "available") & completed)
    return availability.agg(
        F.round(F.lit(100.0) * good.cast("double") / F.lit(30.0), 1).alias("coverage_last_30_days_pct")
    )


def available_streak(availability: DataFrame, as_of: date) -> DataFrame:
    """Length of the run of available days that ends on the last completed day; NULL without a completed day.

    The table has one row per calendar day, so its days fit one array: they are walked in order, and each day
    lengthens the run or ends it.
    """
    past = availability.where(F.col(DAY) < F.lit(as_of)).select(
        F.struct(DAY, (F.col("availability_status") == "available").alias("ok")).alias("day")
    )
    walked = F.aggregate(
        F.array_sort(F.collect_list("day")), F.lit(0), lambda run, day: F.when(day["ok"], run + 1).otherwise(F.lit(0))
    )
    return past.agg(F.when(F.count("day") > 0, walked).alias("consecutive_available_days"))


def coverage_timeline(availability: DataFrame) -> DataFrame:
    return availability.groupBy(DAY, "availability_status").agg(F.count(F.lit(1)).alias("days"))


def monthly_coverage_mix(availability: DataFrame) -> DataFrame:
    """Share of each status among the days of a month."""
    month = F.trunc(DAY, "month").alias("month")
    counts = availability.groupBy(month, "availability_status").agg(F.count(F.lit(1)).alias("days"))
    total = F.sum("days").over(Window.partitionBy("month"))
    return counts.select("month", "availability_status", "days", (F.col("days") / total).alias("share"))


def field_completeness(availability: DataFrame) -> DataFrame:
    return availability.groupBy(DAY).agg(
        F.avg("volume_coverage_pct").alias("volume_coverage_pct"),
        F.avg("vwap_coverage_pct").alias("vwap_coverage_pct"),
    )


def availability_detail(availability: DataFrame, n: int = 1000) -> DataFrame:
    """Newest days first: ``n`` of them, and ``truncated``."""
    return bounded(availability, [F.desc(DAY)], n, ceiling=None).select(
        DAY, "availability_status", "availability_reason", "silver_row_count",
        "daily_snapshot_row_count", "rank_change_row_count", "weekly_average_row_count",
        "source_coverage_pct", "volume_coverage_pct", "vwap_coverage_pct", "truncated",
    )
