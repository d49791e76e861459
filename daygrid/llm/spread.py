"""An equi-join whose large side may hold hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A key is hot when more than one in so many of all rows hold it; there are fewer hot keys than this.
HOT_PARTS = 2_000


def join_spread(rows: DataFrame, found: DataFrame, on: list[str], count: str) -> DataFrame:
    """``rows`` joined with ``found``, one row per key with the number of ``rows`` that hold it in ``count``.

    The fewer than ``HOT_PARTS`` keys that hold more than their share are broadcast, so their rows stay where they
    are; all others meet by a shuffle in which no key is large. Both frames are read more than once.
    """
    total = found.agg(F.sum(count)).first()[0] or 0
    hot = F.col(count) * HOT_PARTS > total
    keys = F.broadcast(found.where(hot).select(*on))
    rest = rows.join(keys, on, "left_anti").join(found.where(~hot), on)
    return rest.unionByName(rows.join(F.broadcast(found.where(hot)), on))
