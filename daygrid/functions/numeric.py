"""Number parsing and percent change."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_double(text: Column) -> Column:
    """Text to double; anything that is not a number becomes NULL (ANSI ``cast`` would raise)."""
    number = text.try_cast("double")
    return F.when(~F.isnan(number), number)


def pct_change(current: Column, past: Column) -> Column:
    """Percent change; NULL when either side is NULL or the past value is zero."""
    return (current - past) / F.nullif(past, F.lit(0.0)) * F.lit(100.0)


def share_pct(part: Column, whole: Column, digits: int = 2) -> Column:
    """``part`` as a rounded percentage of ``whole``; NULL when ``whole`` is zero."""
    whole = F.nullif(whole.cast("double"), F.lit(0.0))
    return F.round(F.lit(100.0) * part.cast("double") / whole, digits)
