"""Typed tables from landed snapshot files."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrid.functions.numeric import to_double
from daygrid.operators.dedup import latest_by_key
from daygrid.operators.stats import null_counts
from daygrid.schemas import DAY, ENTITY

REQUIRED = ("id", "symbol", "name", "price_usd")
COIN_COLUMNS = ("id", "symbol", "name", "supply", "max_supply")
MEASURES = ("price_usd", "market_cap_usd", "volume_usd_24hr", "change_percent_24hr", "vwap_24hr")


def clean_snapshots(raw: DataFrame) -> DataFrame:
    """Typed columns from the string fields; bad numbers become NULL. The day, if any, is kept."""
    return raw.select(
        *([DAY] if DAY in raw.columns else []),
        "id",
        "symbol",
        "name",
        to_double(F.col("supply")).alias("supply"),
        to_double(F.col("maxSupply")).alias("max_supply"),
        to_double(F.col("priceUsd")).alias("price_usd"),
        to_double(F.col("marketCapUsd")).alias("market_cap_usd"),
        to_double(F.col("volumeUsd24Hr")).alias("volume_usd_24hr"),
        to_double(F.col("changePercent24Hr")).alias("change_percent_24hr"),
        to_double(F.col("vwap24Hr")).alias("vwap_24hr"),
    )


def required_field_nulls(cleaned: DataFrame, required: tuple[str, ...] = REQUIRED) -> DataFrame:
    """One row of ``<field>_nulls``, computed in one pass."""
    return null_counts(cleaned, required)


def require_fields(cleaned: DataFrame, required: tuple[str, ...] = REQUIRED) -> None:
    """Raise when a required field is NULL anywhere."""
    counts = required_field_nulls(cleaned, required).first().asDict()
    broken = {name: n for name, n in counts.items() if n}
    if broken:
        raise ValueError(f"NULL in required fields: {broken}")


def coin_rows(cleaned: DataFrame) -> DataFrame:
    """Dimension rows. Over a range of days the newest day of an entity wins."""
    if DAY not in cleaned.columns:
        return cleaned.select(*COIN_COLUMNS)
    return latest_by_key(cleaned.select(*COIN_COLUMNS, DAY), ["id"], [DAY]).drop(DAY)


def price_rows(cleaned: DataFrame) -> DataFrame:
    """Panel rows of the days in the frame."""
    return cleaned.select(F.col("id").alias(ENTITY), DAY, *MEASURES)
