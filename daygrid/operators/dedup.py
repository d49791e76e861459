"""One row per key, and the check that a frame already has one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_by_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Keep the row with the greatest ``order`` columns (NULL lowest), then the greatest values.

    An aggregate, not a ``row_number``: copies of a hot key are reduced in the map tasks and
    never meet in one sort. The order is total over the kept columns, so the result does not
    depend on the arrival of rows.
    """
    rest = [c for c in df.columns if c not in keys and c not in order]
    best = F.max(F.struct(*order, *rest)).alias("_best")
    kept = df.groupBy(*keys).agg(best)
    return kept.select(
        *(F.col(c) if c in keys else F.col(f"_best.{c}").alias(c) for c in df.columns)
    )


def duplicated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows. Empty means unique."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).where(F.col("row_count") > 1)


def unique_or_fail(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Return ``df`` unchanged, or raise when a key occurs twice (an ambiguous merge)."""
    offender = duplicated_keys(df, keys).first()
    if offender is not None:
        raise ValueError(f"more than one source row for key {offender.asDict()}")
    return df


def count_null(column: Column) -> Column:
    return F.count_if(column.isNull())
