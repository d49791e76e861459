"""Declared schemas and the column documentation of every table.

A *panel* is a DataFrame with one row per (``coin_id``, ``snapshot_date``) and measures.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

ENTITY = "coin_id"
DAY = "snapshot_date"
KEY = (ENTITY, DAY)

# The source field names, all of them strings at rest.
REQUIRED_ASSET_FIELDS = (
    "id", "rank", "symbol", "name", "supply",
    "marketCapUsd", "volumeUsd24Hr", "priceUsd", "changePercent24Hr",
)
OPTIONAL_ASSET_FIELDS = ("maxSupply", "vwap24Hr", "explorer")
ASSET_FIELDS = (
    "id", "rank", "symbol", "name", "supply", "maxSupply", "marketCapUsd",
    "volumeUsd24Hr", "priceUsd", "changePercent24Hr", "vwap24Hr", "explorer",
)
API_TIMESTAMP = "api_timestamp_ms"
FETCHED_AT = "fetched_at_utc"

SNAPSHOT_FILE = T.StructType(
    [T.StructField(name, T.StringType()) for name in ASSET_FIELDS]
    + [
        T.StructField(API_TIMESTAMP, T.LongType()),
        T.StructField(FETCHED_AT, T.TimestampType()),
    ]
)

# Accepted spellings of the history measures, in order of preference.
MARKET_CAP_ALIASES = ("marketCapUsd", "marketcapUsd", "marketCap", "marketcap")
TOTAL_MARKET_CAP_ALIASES = (
    "totalMarketCapUsd", "total_market_cap_usd",
    "marketCapUsd", "marketcapUsd", "marketCap", "marketcap",
)

COINS = T.StructType(
    [
        T.StructField("id", T.StringType(), False),
        T.StructField("symbol", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("supply", T.DoubleType()),
        T.StructField("max_supply", T.DoubleType()),
    ]
)

PRICE_SNAPSHOTS = T.StructType(
    [
        T.StructField(ENTITY, T.StringType(), False),
        T.StructField(DAY, T.DateType(), False),
        T.StructField("price_usd", T.DoubleType()),
        T.StructField("market_cap_usd", T.DoubleType()),
        T.StructField("volume_usd_24hr", T.DoubleType()),
        T.StructField("change_percent_24hr", T.DoubleType()),
        T.StructField("vwap_24hr", T.DoubleType()),
    ]
)

ASSET_MARKET_CAP = T.StructType(
    [
        T.StructField(ENTITY, T.StringType(), False),
        T.StructField(DAY, T.DateType(), False),
        T.StructField("market_cap_usd", T.DoubleType()),
    ]
)

TOTAL_MARKET_CAP = T.StructType(
    [
        T.StructField(DAY, T.DateType(), False),
        T.StructField("total_market_cap_usd", T.DoubleType()),
    ]
)

DAILY_COLUMNS = (
    DAY, ENTITY, "symbol", "name", "coin_rank", "price_usd", "prev_price_usd",
    "price_change_pct", "price_change_rank", "market_cap_usd", "volume_usd_24hr", "vwap_24hr",
)
RANK_CHANGE_HEAD = (DAY, ENTITY, "symbol", "name", "price_usd", "market_cap_usd", "mc_rank")
ROLLING_COLUMNS = (
    DAY, ENTITY, "symbol", "name", "price_usd", "market_cap_usd", "volume_usd_24hr", "vwap_24hr",
    "wkly_roll_avg_price", "wkly_roll_avg_volume",
)


def _gold(names: tuple[str, ...], ranks: tuple[str, ...] = ()) -> T.StructType:
    """Keys are required; ranks are ints, labels strings, everything else is a double."""
    types = {DAY: T.DateType(), ENTITY: T.StringType(), "symbol": T.StringType(), "name": T.StringType()}
    types |= dict.fromkeys(ranks, T.IntegerType())
    return T.StructType([T.StructField(c, types.get(c, T.DoubleType()), c not in KEY) for c in names])


RANK_MOVES = ("mc_rank_diff_14d", "mc_rank_diff_30d")
DAILY_SNAPSHOT = _gold(DAILY_COLUMNS, ("coin_rank", "price_change_rank"))
RANK_CHANGE = _gold((*RANK_CHANGE_HEAD, *RANK_MOVES, "price_diff_14d_pct", "price_diff_30d_pct"), ("mc_rank", *RANK_MOVES))
ROLLING_AVERAGE = _gold(ROLLING_COLUMNS)
AVAILABILITY_STATUSES = ("available", "partial", "missing")

# What a reader of the tables has to know. Attached to columns by ``document``.
COLUMN_DOCS = {
    DAY: "Calendar day in UTC. The tables are sparse: a day nobody recorded has no row.",
    ENTITY: "Key of the panel, together with the day.",
    "symbol": "Short label from the dimension; several entities may share one.",
    "name": "Label from the dimension; empty where the entity has no dimension row.",
    "coin_rank": "1 + number of entities with a larger cap on that day; no cap sorts last.",
    "mc_rank": "Same as coin_rank.",
    "price_usd": "Price of the row itself.",
    "prev_price_usd": "price_usd of the entity's row on day - 1, looked up by date.",
    "price_change_pct": "100 * (price_usd / prev_price_usd - 1); empty without a row on day - 1 or after a price of 0.",
    "price_change_rank": "1 + number of entities with a larger price_change_pct; empty where that is empty.",
    "market_cap_usd": "Cap of the row itself.",
    "volume_usd_24hr": "Volume of the row itself; merges from history may leave it empty.",
    "change_percent_24hr": "Taken over from landed files; merges from history leave it empty.",
    "vwap_24hr": "Taken over from landed files; merges from history leave it empty.",
    "mc_rank_diff_14d": "mc_rank on day - 14 minus mc_rank, so climbing is positive.",
    "mc_rank_diff_30d": "mc_rank on day - 30 minus mc_rank, so climbing is positive.",
    "price_diff_14d_pct": "Like price_change_pct, against the row on day - 14.",
    "price_diff_30d_pct": "Like price_change_pct, against the row on day - 30.",
    "wkly_roll_avg_price": "avg(price_usd) over the chosen frame that ends on the row.",
    "wkly_roll_avg_volume": "avg(volume_usd_24hr) over the same frame, empty volumes left out.",
    "total_market_cap_usd": "One value per day for the whole panel.",
    "availability_status": "Outcome of the coverage rules for the day.",
    "availability_reason": "The first coverage rule that fires; empty when none does.",
}


def document(df: DataFrame) -> DataFrame:
    """Attach the documentation as column comments."""
    known = {
        name: F.col(name).alias(name, metadata={"comment": COLUMN_DOCS[name]})
        for name in df.columns
        if name in COLUMN_DOCS
    }
    return df.withColumns(known) if known else df
