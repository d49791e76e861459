"""Bounded results: previews, samples and capped results with an exact truncation flag.

The limit is the point of these operators. Each orders by the given columns first, so the
plan keeps the top rows per task and never sorts the whole frame.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

MAX_SAMPLE_ROWS = 20
MAX_RESULT_ROWS = 500


def preview(df: DataFrame, order: Sequence[str | Column], n: int = 20) -> DataFrame:
    return df.orderBy(*order).limit(n)


def require_size(n: int, name: str, ceiling: int | None) -> None:
    """Raise unless ``n`` is a whole number from 1 to ``ceiling``; None stands for no ceiling."""
    if isinstance(n, bool) or not isinstance(n, int) or n < 1 or (ceiling is not None and n > ceiling):
        raise ValueError(f"{name} must be {'at least 1' if ceiling is None else f'1 to {ceiling}'}")


def sample(
    df: DataFrame, order: Sequence[str | Column], n: int = MAX_SAMPLE_ROWS, ceiling: int | None = MAX_SAMPLE_ROWS
) -> DataFrame:
    require_size(n, "n", ceiling)
    return df.orderBy(*order).limit(n)


def bounded(
    df: DataFrame, order: Sequence[str | Column], max_rows: int = MAX_RESULT_ROWS, ceiling: int | None = MAX_RESULT_ROWS
) -> DataFrame:
    """The first ``max_rows`` rows and ``truncated``: whether the frame holds more.

    One row more than asked is fetched, which decides the flag without counting the frame.
    """
    require_size(max_rows, "max_rows", ceiling)
    head = df.orderBy(*order).limit(max_rows + 1)
    everything = Window.partitionBy(F.lit(0))  # over the head only, at most max_rows + 1 rows
    numbered = head.select(
        "*",
        F.row_number().over(everything.orderBy(*order)).alias("_position"),
        (F.count(F.lit(1)).over(everything) > max_rows).alias("truncated"),
    )
    return numbered.where(F.col("_position") <= max_rows).drop("_position")


def checked_result(df: DataFrame, expected_columns: Sequence[str], expect_rows: bool) -> DataFrame:
    """Return ``df``, or raise when its columns differ from the promise or promised rows are absent."""
    if [c.lower() for c in df.columns] != [c.lower() for c in expected_columns]:
        raise ValueError(f"columns {df.columns} are not the expected {list(expected_columns)}")
    if expect_rows and df.isEmpty():
        raise ValueError("the result was expected to have rows")
    return df


def distinct_values(df: DataFrame, column: str, n: int = 50) -> DataFrame:
    """The first ``n`` distinct values in ascending order."""
    return df.select(column).distinct().orderBy(column).limit(n)
