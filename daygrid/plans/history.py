"""Repair of missing days from history endpoints."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrid.functions.dates import event_date
from daygrid.functions.numeric import to_double
from daygrid.functions.text import first_present, optional_column
from daygrid.operators.dedup import latest_by_key
from daygrid.schemas import DAY, ENTITY, KEY, MARKET_CAP_ALIASES, TOTAL_MARKET_CAP_ALIASES


def _clean(raw: DataFrame, keys: Sequence[str], measures: dict[str, Sequence[str]]) -> DataFrame:
    """Typed measures, one row per key: the point with the latest source time."""
    time = optional_column(raw, "time", "long")
    points = raw.select(
        *(k for k in keys if k != DAY),
        event_date(optional_column(raw, "date"), time).alias(DAY),
        time.alias("_time"),
        *(to_double(first_present(raw, names)).alias(m) for m, names in measures.items()),
    ).where(F.col(DAY).isNotNull())
    return latest_by_key(points, keys, ["_time"]).select(*keys, *measures)


def clean_asset_history(raw: DataFrame) -> DataFrame:
    return _clean(raw, KEY, {"price_usd": ["priceUsd"], "volume_usd_24hr": ["volumeUsd24Hr"]})


def clean_asset_market_cap_history(raw: DataFrame) -> DataFrame:
    return _clean(raw, KEY, {"market_cap_usd": MARKET_CAP_ALIASES})


def clean_total_market_cap_history(raw: DataFrame) -> DataFrame:
    return _clean(raw, (DAY,), {"total_market_cap_usd": TOTAL_MARKET_CAP_ALIASES})


def history_price_rows(prices: DataFrame, market_caps: DataFrame) -> DataFrame:
    """Panel rows of repaired days: the history has no change and no vwap."""
    return prices.join(market_caps, list(KEY), "left").select(
        *KEY,
        "price_usd",
        "market_cap_usd",
        "volume_usd_24hr",
        F.lit(None).cast("double").alias("change_percent_24hr"),
        F.lit(None).cast("double").alias("vwap_24hr"),
    )


def backfill_plan(coins: DataFrame, panel: DataFrame, days: int, anchor: date | None = None) -> DataFrame:
    """One row per entity to fetch, with the anchor day and its window.

    Without ``anchor`` the newest day of the panel is taken; running the plan on an empty
    panel fails. The plan stays distributed: the ids are never gathered into one list.
    """
    if days < 1:
        raise ValueError("days must be at least 1")
    ids = coins.select(F.col("id").alias(ENTITY)).distinct()
    if ids.isEmpty():
        raise ValueError("the entity table is empty; there is nothing to plan")
    if anchor is not None:
        day = F.lit(anchor)
    else:
        newest = F.coalesce(F.max(DAY), F.raise_error(F.lit("the panel is empty; there is no anchor day")))
        day = panel.agg(newest.cast("date")).scalar()  # one value, computed once
    return ids.withColumn("anchor_snapshot_date", day).select(
        ENTITY,
        "anchor_snapshot_date",
        F.lit(days).alias("backfill_days"),
        F.date_sub("anchor_snapshot_date", days).alias("window_start_date"),
        F.date_sub("anchor_snapshot_date", 1).alias("window_end_date"),
    )
