"""The analytical tables. ``span`` is an inclusive day range, ``None`` is all history.

With a span only the days a result can depend on are read, and the rows before the span are
dropped after the windows have used them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrid.functions.dates import Span, between_days, in_span, shifted
from daygrid.functions.numeric import pct_change
from daygrid.operators.lookback import with_day_over_day, with_lookbacks, with_rolling_mean
from daygrid.operators.ranking import rank_within_day
from daygrid.schemas import DAILY_COLUMNS, DAY, ENTITY, RANK_CHANGE_HEAD, ROLLING_COLUMNS

# Days after a changed day on which each table can change.
DAILY_REACH = (0, 1)
RANK_REACH = (0, 14, 30)
ROLLING_REACH = tuple(range(7))


def with_cap_rank(df: DataFrame, name: str = "coin_rank", **ranking) -> DataFrame:
    """``ranking`` goes to ``rank_within_day``: method, staging, cell_rows."""
    return rank_within_day(df, {name: "market_cap_usd"}, **ranking)


def with_change_rank(df: DataFrame, **ranking) -> DataFrame:
    """Rank by percent change; NULL exactly when the change is NULL."""
    return rank_within_day(
        df,
        {"price_change_rank": "price_change_pct"},
        unranked_nulls={"price_change_rank"},
        **ranking,
    )


def with_dimension(df: DataFrame, dim: DataFrame) -> DataFrame:
    """Add ``symbol`` and ``name``; an unknown entity keeps its row with NULLs.

    No broadcast hint: Spark broadcasts the dimension while it is below
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffles, with skew splitting, beyond.
    """
    names = dim.select(F.col("id").alias(ENTITY), "symbol", "name")
    return df.join(names, ENTITY, "left")


def daily_snapshot(panel: DataFrame, dim: DataFrame, span: Span | None = None, **ranking) -> DataFrame:
    """Price, change from the day before, cap rank and change rank."""
    rows = panel.select(ENTITY, DAY, "price_usd", "market_cap_usd", "volume_usd_24hr", "vwap_24hr")
    if span is not None:
        rows = rows.where(between_days(F.col(DAY), (shifted(span, -1)[0], span[1])))
    changed = in_span(with_day_over_day(rows), DAY, span)
    ranked = rank_within_day(
        changed,
        {"coin_rank": "market_cap_usd", "price_change_rank": "price_change_pct"},
        unranked_nulls={"price_change_rank"},
        **ranking,
    )
    return with_dimension(ranked, dim).select(*DAILY_COLUMNS)


def rank_change(
    panel: DataFrame,
    dim: DataFrame,
    span: Span | None = None,
    offsets: Sequence[int] = (14, 30),
    days: DataFrame | None = None,
    **ranking,
) -> DataFrame:
    """Cap rank and its movement against exact days in the past; positive means moved up.

    ``days`` (one row per calendar day) limits the reading to these days and the days they look back to.
    """
    rows = panel.select(ENTITY, DAY, "price_usd", "market_cap_usd")
    if days is not None:
        back = F.explode(F.array(*(F.lit(-k) for k in (0, *offsets))))
        wanted = days.select(DAY, back.alias("_k")).select(F.date_add(DAY, F.col("_k")).alias(DAY)).distinct()
        rows = rows.join(F.broadcast(wanted), DAY, "left_semi")
    if span is not None:
        wanted = between_days(F.col(DAY), span)
        for k in offsets:
            wanted = wanted | between_days(F.col(DAY), shifted(span, -k))
        rows = rows.where(wanted)
    ranked = with_cap_rank(rows, "mc_rank", **ranking)
    past = in_span(with_lookbacks(ranked, ["mc_rank", "price_usd"], offsets), DAY, span)
    moves = [(F.col(f"mc_rank_t_{k}") - F.col("mc_rank")).alias(f"mc_rank_diff_{k}d") for k in offsets]
    changes = [
        pct_change(F.col("price_usd"), F.col(f"price_usd_t_{k}")).alias(f"price_diff_{k}d_pct")
        for k in offsets
    ]
    return with_dimension(past, dim).select(*RANK_CHANGE_HEAD, *moves, *changes)


def rolling_average(
    panel: DataFrame, dim: DataFrame, span: Span | None = None, frame: str = "rows", size: int = 7
) -> DataFrame:
    """Mean price and volume over the last ``size`` observations or calendar days.

    The calendar frame needs ``size - 1`` days before the span; the row frame reaches back
    over gaps of any length and therefore reads all days up to the end of the span.
    """
    rows = panel.select(ENTITY, DAY, "price_usd", "market_cap_usd", "volume_usd_24hr", "vwap_24hr")
    if span is not None and frame == "calendar":
        rows = rows.where(between_days(F.col(DAY), (shifted(span, 1 - size)[0], span[1])))
    elif span is not None:
        rows = rows.where(F.col(DAY) <= F.lit(span[1]))
    means = {"wkly_roll_avg_price": "price_usd", "wkly_roll_avg_volume": "volume_usd_24hr"}
    averaged = in_span(with_rolling_mean(rows, means, frame, size), DAY, span)
    return with_dimension(averaged, dim).select(*ROLLING_COLUMNS)


def affected_dates(
    changed: DataFrame, panel: DataFrame, reach: Sequence[int] = (*ROLLING_REACH, 14, 30)
) -> DataFrame:
    """Days whose tables must be rebuilt after ``changed`` days, kept to days the panel has."""
    offsets = F.array(*(F.lit(k) for k in sorted(set(reach))))
    days = changed.select(DAY).distinct().select(F.explode(offsets).alias("_k"), DAY)
    days = days.select(F.date_add(DAY, F.col("_k")).alias(DAY)).distinct()
    return days.join(panel.select(DAY).distinct(), DAY, "left_semi")
