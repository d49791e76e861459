"""Per-entity windows over days.

A panel has at most one row per entity and day (``dedup.duplicated_keys`` checks it), so a
window over one entity never holds more rows than there are calendar days - some ten thousand
for a century - however many entities or rows the panel has. That bound is why these windows
may partition by entity without salting. All of them share one shuffle and one sort by entity.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window, WindowSpec

from daygrid.functions.dates import day_number
from daygrid.functions.numeric import pct_change
from daygrid.schemas import DAY, ENTITY


def by_day() -> WindowSpec:
    return Window.partitionBy(ENTITY).orderBy(DAY)


def by_day_number() -> WindowSpec:
    return Window.partitionBy(ENTITY).orderBy(day_number(F.col(DAY)))


def days_ago(column: str, days: int) -> Column:
    """Value of ``column`` exactly ``days`` calendar days earlier, NULL when that day is absent.

    The frame holds the one day ``t - days``; there is no nearest match and no join.
    """
    return F.max(column).over(by_day_number().rangeBetween(-days, -days))


def with_lookbacks(df: DataFrame, columns: Iterable[str], offsets: Iterable[int]) -> DataFrame:
    """Add ``<column>_t_<offset>`` for every column and offset."""
    columns, offsets = list(columns), list(offsets)
    return df.select(
        "*", *(days_ago(c, k).alias(f"{c}_t_{k}") for k in offsets for c in columns)
    )


def with_day_over_day(df: DataFrame) -> DataFrame:
    """Add ``prev_price_usd`` and ``price_change_pct``.

    A row whose previous observation is not the day before keeps NULL in both.
    """
    seen = df.select(
        "*",
        F.lag(DAY).over(by_day()).alias("_prev_day"),
        F.lag("price_usd").over(by_day()).alias("_prev_price"),
    )
    adjacent = F.col("_prev_day") == F.date_sub(DAY, 1)
    previous = F.when(adjacent, F.col("_prev_price"))
    return (
        seen.withColumn("prev_price_usd", previous)
        .withColumn("price_change_pct", pct_change(F.col("price_usd"), F.col("prev_price_usd")))
        .drop("_prev_day", "_prev_price")
    )


def rolling_frame(frame: str, size: int) -> WindowSpec:
    """``rows``: the last ``size`` observations. ``calendar``: the last ``size`` calendar days."""
    if frame == "rows":
        return by_day().rowsBetween(-(size - 1), Window.currentRow)
    if frame == "calendar":
        return by_day_number().rangeBetween(-(size - 1), Window.currentRow)
    raise ValueError(f"frame must be 'rows' or 'calendar', not {frame!r}")


def with_rolling_mean(df: DataFrame, means: dict[str, str], frame: str, size: int) -> DataFrame:
    """Add ``{name: column}`` means over the frame; NULLs are skipped, short frames are kept."""
    window = rolling_frame(frame, size)
    return df.select("*", *(F.avg(c).over(window).alias(name) for name, c in means.items()))
