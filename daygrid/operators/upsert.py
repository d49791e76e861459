"""Keyed upsert: the source row replaces the target row, NULLs included."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def upsert(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows without a source row, plus every source row (in the target's columns).

    The source must hold one row per key (``dedup.unique_or_fail``).
    """
    keys = list(keys)
    kept = target.join(source.select(*keys), keys, "left_anti")
    aligned = [
        (F.col(c) if c in source.columns else F.lit(None)).cast(target.schema[c].dataType).alias(c)
        for c in target.columns
    ]
    return kept.select(*target.columns).unionByName(source.select(*aligned))
