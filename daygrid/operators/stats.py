"""Summaries of a frame: counts, date range, NULL counts, per-day and per-entity coverage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrid.functions.dates import Span, in_span
from daygrid.schemas import DAY, ENTITY


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def count_rows_between(df: DataFrame, span: Span, day: str = DAY) -> DataFrame:
    return count_rows(in_span(df, day, span))


def date_range(df: DataFrame, day: str = DAY) -> DataFrame:
    return df.agg(
        F.min(day).alias("min_date"), F.max(day).alias("max_date"), F.count(F.lit(1)).alias("row_count")
    )


def entity_coverage(df: DataFrame) -> DataFrame:
    return df.groupBy(ENTITY).agg(
        F.min(DAY).alias("min_date"), F.max(DAY).alias("max_date"), F.count(F.lit(1)).alias("row_count")
    )


def rows_per_date(df: DataFrame) -> DataFrame:
    return df.groupBy(DAY).agg(F.count(F.lit(1)).alias("row_count"))


def field_completeness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per day and how many of them carry each column."""
    return df.groupBy(DAY).agg(
        F.count(F.lit(1)).alias("row_count"), *(F.count(c).alias(f"{c}_count") for c in columns)
    )


def null_counts(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row with ``<column>_nulls`` per column; all columns in one pass."""
    return df.agg(*(F.count_if(F.col(c).isNull()).alias(f"{c}_nulls") for c in columns or df.columns))


def null_counts_long(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The same counts as (column_name, null_count) rows."""
    wide = null_counts(df, columns)
    pairs = F.array(
        *(F.struct(F.lit(c).alias("column_name"), F.col(f"{c}_nulls").alias("null_count")) for c in columns)
    )
    return wide.select(F.inline(pairs))
