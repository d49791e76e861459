"""Which days of a panel differ, from one fingerprint per day that does not depend on the order of rows or columns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daygrid.schemas import DAY


def _row_hash(columns: list[str], seed: int) -> Column:
    # A NULL leaves a hash as it is, so each column also says whether it is NULL; decimals add up without overflow.
    parts = [part for c in columns for part in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`"))]
    return F.xxhash64(F.lit(seed), *parts).cast("decimal(20,0)")


def day_fingerprints(panel: DataFrame, by: str = DAY) -> DataFrame:
    """(day, row_count, low, high) per day: the number of rows and the sums of two hashes of each row.

    Equal days have equal fingerprints, whatever the order of rows and columns; repeated rows count as often as they
    occur, and a NULL differs from every value. The sums are formed in the map tasks, so a day of any size crosses the
    shuffle as one row a task. Columns of maps have no hash and must be left out.
    """
    columns = sorted(c for c in panel.columns if c != by)
    hashed = panel.select(by, _row_hash(columns, 1).alias("low"), _row_hash(columns, 2).alias("high"))
    return hashed.groupBy(by).agg(F.count(F.lit(1)).alias("row_count"), F.sum("low").alias("low"), F.sum("high").alias("high"))


def changed_days(before: DataFrame, after: DataFrame, by: str = DAY) -> DataFrame:
    """(day, change) of days whose fingerprints differ: ``added``, ``removed`` or ``changed``. A NULL day is a day too."""
    old, new = (df.select(F.col(by).alias(f"{side}_day"), F.struct("row_count", "low", "high").alias(side))
                for side, df in (("old", before), ("new", after)))
    both = old.join(new, F.col("old_day").eqNullSafe(F.col("new_day")), "full")
    change = F.when(F.col("old").isNull(), "added").when(F.col("new").isNull(), "removed").otherwise("changed")
    return both.where(~F.col("old").eqNullSafe(F.col("new"))).select(F.coalesce("new_day", "old_day").alias(by), change.alias("change"))
