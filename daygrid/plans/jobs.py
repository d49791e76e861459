"""Whole loads: one Spark job per table for any range of days, never one run per day."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrid.functions.dates import Span, backfill_window, days_of, shifted, span_of
from daygrid.operators.fingerprint import changed_days, day_fingerprints
from daygrid.operators.spine import calendar
from daygrid.plans import checks, gold, history, rolling_state, serving, silver
from daygrid.schemas import (
    ASSET_MARKET_CAP,
    DAILY_SNAPSHOT,
    DAY,
    KEY,
    PRICE_SNAPSHOTS,
    RANK_CHANGE,
    ROLLING_AVERAGE,
    TOTAL_MARKET_CAP,
    document,
)
from daygrid.sinks.contract import write_checked
from daygrid.sinks.partitions import merge_partitions, read_version, replace_table, staged, upsert_version
from daygrid.sources.listing import day_frame, folder_days, missing_stored_days, newest_stored_day, require_stored
from daygrid.sources.snapshots import read_history, read_snapshots

GOLD = {"daily_snapshot": DAILY_SNAPSHOT, "rank_change": RANK_CHANGE, "rolling_average": ROLLING_AVERAGE}


def load_snapshots(spark: SparkSession, landed: str, silver_root: str, span: Span | None = None) -> None:
    """Landed files of a range into the typed dimension and panel. The files are read once."""
    span = span_of(*span) if span is not None else None
    cleaned = staged(silver.clean_snapshots(read_snapshots(spark, landed, span)), "cleaned-snapshots")
    if span is not None:
        absent = checks.missing_input_dates(cleaned, span)
        if not absent.isEmpty():
            raise ValueError(f"no landed files for {absent.first()[DAY]} and maybe other days")
    silver.require_fields(cleaned)
    upsert_version(f"{silver_root}/coins", silver.coin_rows(cleaned), ["id"])
    write_checked(document(silver.price_rows(cleaned)), f"{silver_root}/price_snapshots", PRICE_SNAPSHOTS)
    days = _days(cleaned) if span is None else days_of(span)
    require_stored(spark, {"price_snapshots": f"{silver_root}/price_snapshots"}, days)


def load_history(spark: SparkSession, landed: str, silver_root: str, anchor: date, days: int) -> None:
    """History files of one backfill merged into the panel and the two cap tables.

    Every day a source holds must be in its table afterwards; a source without any row is refused.
    """
    backfill_window(anchor, days)

    def cleaned(dataset: str, clean) -> DataFrame:
        rows = staged(clean(read_history(spark, landed, anchor, days, dataset)), dataset)
        if rows.isEmpty():
            raise ValueError(f"no usable history points in {dataset}")
        return rows

    prices = cleaned("asset_history", history.clean_asset_history)
    caps = cleaned("asset_market_cap_history", history.clean_asset_market_cap_history)
    totals = cleaned("total_market_cap_history", history.clean_total_market_cap_history)
    merges = {
        "price_snapshots": (history.history_price_rows(prices, caps), KEY, prices, PRICE_SNAPSHOTS),
        "asset_market_cap_history": (caps, KEY, caps, ASSET_MARKET_CAP),
        "total_market_cap_history": (totals, (DAY,), totals, TOTAL_MARKET_CAP),
    }
    for name, (rows, keys, source, schema) in merges.items():
        merge_partitions(f"{silver_root}/{name}", rows, keys, schema=schema)
        require_stored(spark, {name: f"{silver_root}/{name}"}, _days(source))


def build_gold(
    spark: SparkSession,
    silver_root: str,
    gold_root: str,
    span: Span | None = None,
    frame: str = "calendar",
    cascade: bool = True,
    **ranking,
) -> None:
    """Rebuild the three tables for the days of ``span`` in one plan each.

    With ``cascade`` the later days that depend on the span are rebuilt too (the next day, 14
    and 30 days on, the following six days), so that a late day never leaves stale results.
    With the row frame the rolling table depends on days at any distance, so it is rebuilt to
    the end of the panel, from the observations that the state of an earlier build holds. ``ranking`` goes to ``rank_within_day``.

    Days come from the folders of the panel, not from a scan. Days of the span that the panel lacks are found before the
    first write; all three tables are built for the others, and then every absent (table, day) is raised.
    """
    span = span_of(*span) if span is not None else None
    silver_path = f"{silver_root}/price_snapshots"
    held = folder_days(spark, silver_path)
    wanted = held if span is None else days_of(span)
    absent = missing_stored_days(spark, {"price_snapshots": silver_path}, wanted).collect()
    lacking = {row[DAY] for row in absent}
    if held and lacking >= set(wanted):
        raise ValueError(f"the panel has no rows from {wanted[0]} to {wanted[-1]}")
    panel = spark.read.parquet(silver_path)
    dim = read_version(spark, f"{silver_root}/coins")

    def reached(reach: tuple[int, ...]) -> tuple[Span | None, DataFrame | None]:
        if span is None:
            return None, None
        if not cascade:
            return span, None
        wide = (span[0], shifted(span, max(reach))[1])
        return wide, gold.affected_dates(calendar(spark, *span), day_frame(spark, held), reach)

    built: dict[str, set[date]] = {}

    def store(name: str, table: DataFrame, days: DataFrame | None) -> None:
        kept = table if days is None else table.join(F.broadcast(days), DAY, "left_semi")  # calendar days
        write_checked(document(kept), f"{gold_root}/{name}", GOLD[name])
        built[name] = set(wanted) | (set() if days is None else set(_days(days)))

    wide, days = reached(gold.DAILY_REACH)
    store("daily_snapshot", gold.daily_snapshot(panel, dim, wide, **ranking), days)
    wide, days = reached(gold.RANK_REACH)
    # Only the affected days and the days they look back to are read, not all days between.
    store("rank_change", gold.rank_change(panel, dim, wide, days=days, **ranking), days)
    if frame == "rows" and cascade:
        put = lambda table: store("rolling_average", table, None)
        rolling_state.advance(spark, panel, dim, f"{gold_root}/rolling_state", held, span, put)
    else:
        wide, days = reached(gold.ROLLING_REACH)
        store("rolling_average", gold.rolling_average(panel, dim, wide, frame), days)

    for name, days in built.items():
        absent += missing_stored_days(spark, {name: f"{gold_root}/{name}"}, days).collect()
    if absent:
        named = sorted((row[DAY], row.table_name) for row in absent)
        raise ValueError("no rows: " + ", ".join(f"{name} on {day}" for day, name in named))


def refresh_gold(
    spark: SparkSession, silver_root: str, gold_root: str, span: Span | None = None, **options
) -> list[date]:
    """Rebuild Gold for the days whose panel rows differ from those it was built from, and return these days.

    Beside the Gold tables lies one fingerprint per day of the panel they were built from. Files of the span's days only
    are read to compare, and days that were loaded again unchanged rebuild nothing. Neighbouring changed days are built
    together, in ascending order; ``options`` go to ``build_gold``, whose cascade also rebuilds later days that depend on
    them. Fingerprints are kept after the builds: a refresh that fails finds the same days again. They cover
    the panel; a change of the dimension alone calls for ``build_gold``. Days that left the panel are refused, as Gold
    would keep their rows.
    """
    span = span_of(*span) if span is not None else None
    silver_path, kept = f"{silver_root}/price_snapshots", f"{gold_root}/built_from"
    inside = lambda day: span is None or span[0] <= day <= span[1]
    held = [day for day in folder_days(spark, silver_path) if inside(day)]
    known = read_version(spark, kept)
    if known is None:
        known = spark.createDataFrame([], FINGERPRINT)
    if span is not None:
        known = known.where(F.col(DAY).between(*span))
    if held:
        panel = spark.read.parquet(silver_path).where(F.col(DAY).isin(held))
        prints = staged(day_fingerprints(panel), "day-fingerprints")
    else:
        prints = known.limit(0)
    found = {row[DAY]: row.change for row in changed_days(known, prints).collect()}  # calendar days
    gone = sorted(day for day, change in found.items() if change == "removed")
    if gone:
        raise ValueError(f"days left the panel after Gold was built: {', '.join(map(str, gone))}")
    days = sorted(found)
    if days and span is None and days == held:
        build_gold(spark, silver_root, gold_root, None, **options)
    else:
        ends = [day for day in days if day + timedelta(1) not in found]
        starts = [day for day in days if day - timedelta(1) not in found]
        for run in zip(starts, ends, strict=True):
            build_gold(spark, silver_root, gold_root, run, **options)
    if days:
        upsert_version(kept, prints, [DAY])
    return days


#: What ``day_fingerprints`` returns.
FINGERPRINT = f"{DAY} date, row_count long, low decimal(30,0), high decimal(30,0)"


def _days(df: DataFrame) -> list[date]:
    """Distinct days of a frame; as many as the calendar has."""
    return [row[DAY] for row in df.select(DAY).distinct().collect()]


def build_serving(
    spark: SparkSession,
    silver_root: str,
    gold_root: str,
    end: date,
    start: date | None = None,
    expected: int = serving.EXPECTED_ASSETS,
) -> None:
    """Full refresh of the latest-day and availability tables."""
    panel = spark.read.parquet(f"{silver_root}/price_snapshots")
    daily, rank, rolling = (
        spark.read.parquet(f"{gold_root}/{n}") for n in ("daily_snapshot", "rank_change", "rolling_average")
    )
    newest = newest_stored_day(spark, f"{gold_root}/daily_snapshot")
    replace_table(daily.where(F.col(DAY) == F.lit(newest)), f"{gold_root}/latest_snapshot")
    replace_table(
        serving.availability(panel, daily, rank, rolling, end, start, expected), f"{gold_root}/availability"
    )
