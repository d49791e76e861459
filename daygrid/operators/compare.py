"""Differences between two frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def frames_diff(left: DataFrame, right: DataFrame, digits: int | None = None) -> DataFrame:
    """Rows that one frame has more often than the other: columns, ``side``, ``copies``.

    Columns are matched by position and row order does not matter. ``digits`` rounds doubles
    before comparing. One aggregation with map-side combine; copies are counted, never emitted.
    """
    if len(left.columns) != len(right.columns):
        raise ValueError("the frames have different numbers of columns")
    names = left.columns

    def prepared(df: DataFrame, sign: int) -> DataFrame:
        df = df.toDF(*names)
        columns = []
        for field in df.schema.fields:
            c = F.col(field.name)
            if digits is not None and isinstance(field.dataType, (T.DoubleType, T.FloatType)):
                c = F.round(c, digits)
            columns.append(c.alias(field.name))
        return df.select(*columns, F.lit(sign).alias("_sign"))

    balance = (
        prepared(left, 1)
        .unionByName(prepared(right, -1))
        .groupBy(*names)
        .agg(F.sum("_sign").alias("_balance"))
        .where(F.col("_balance") != 0)
    )
    return balance.select(
        *names,
        F.when(F.col("_balance") > 0, "left").otherwise("right").alias("side"),
        F.abs("_balance").alias("copies"),
    )
