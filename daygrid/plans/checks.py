"""Data checks. Each returns the violating rows; an empty result means the check passes.

Per-day comparisons are single aggregations over the tables with map-side combine, so they
cost one narrow shuffle by day whatever the size of the tables.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from daygrid.functions.dates import Span, in_span
from daygrid.operators.dedup import duplicated_keys
from daygrid.operators.spine import calendar, missing_days
from daygrid.operators.stats import null_counts_long
from daygrid.schemas import AVAILABILITY_STATUSES, DAY, ENTITY

MIN_ENTITIES_FOR_DUPLICATE = 5


def rows_by_day(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows per day of several tables side by side; NULL where a table lacks the day."""
    labelled = [df.select(DAY, F.lit(1).alias(name)) for name, df in tables.items()]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), labelled)
    counts = [F.nullif(F.count(name), F.lit(0)).alias(f"{name}_row_count") for name in tables]
    return stacked.groupBy(DAY).agg(*counts)


def not_null(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """Columns that must not be NULL but are, with the number of NULLs; one pass per table."""
    found = [
        null_counts_long(df, columns).select(F.lit(name).alias("model_name"), "column_name", "null_count")
        for name, (df, columns) in tables.items()
    ]
    return reduce(DataFrame.unionByName, found).where(F.col("null_count") > 0)


def unique_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return duplicated_keys(df, keys)


def relationships(child: DataFrame, parent: DataFrame, key: str = ENTITY, parent_key: str = "id") -> DataFrame:
    """Child keys without a parent and how many rows carry them.

    Child rows are counted per key first, so a hot key reaches the join as one row.
    """
    used = child.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("row_count"))
    return used.join(parent.select(F.col(parent_key).alias(key)), key, "left_anti")


def accepted_values(
    df: DataFrame, column: str = "availability_status", values: Sequence[str] = AVAILABILITY_STATUSES
) -> DataFrame:
    bad = df.where(F.col(column).isNotNull() & ~F.col(column).isin(*values))
    return bad.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("row_count"))


def gap_dates_retained(panel: DataFrame, daily: DataFrame) -> DataFrame:
    """Days without a predecessor that lost rows or carry an invented change.

    Every panel row also marks the day after its own, so one aggregation by day over narrow columns tells the rows of
    both tables, the rows that carry a change, and whether the day before is there.
    """
    one = F.lit(1)
    changed = F.coalesce("prev_price_usd", "price_change_pct", F.col("price_change_rank").cast("double")).isNotNull()
    stacked = (
        panel.select(DAY, one.alias("silver"))
        .unionByName(panel.select(F.date_add(DAY, 1).alias(DAY), one.alias("follows")), allowMissingColumns=True)
        .unionByName(daily.select(DAY, one.alias("gold"), F.when(changed, one).alias("changed")), allowMissingColumns=True)
    )
    names = {"silver": "silver_row_count", "gold": "gold_row_count", "changed": "populated_change_row_count", "follows": "_before"}
    days = stacked.groupBy(DAY).agg(*(F.count(c).alias(name) for c, name in names.items()))
    wrong = (F.col("gold_row_count") != F.col("silver_row_count")) | (F.col("populated_change_row_count") > 0)
    return days.where((F.col("silver_row_count") > 0) & (F.col("_before") == 0) & wrong).drop("_before")


def gap_values_null(daily: DataFrame) -> DataFrame:
    """Rows without a previous price that still carry a change."""
    return daily.where(
        F.col("prev_price_usd").isNull()
        & (F.col("price_change_pct").isNotNull() | F.col("price_change_rank").isNotNull())
    )


def unchanged_days(daily: DataFrame, min_entities: int = 1, compared_only: bool = False) -> DataFrame:
    """Days on which every entity kept its price: one response stored under two labels.

    ``compared_only`` ignores rows without a previous price.
    """
    rows = daily.where(F.col("prev_price_usd").isNotNull()) if compared_only else daily
    per_day = rows.groupBy(DAY).agg(
        F.count(F.lit(1)).alias("coin_count"),
        F.count_if(F.col("price_usd") == F.col("prev_price_usd")).alias("unchanged_coin_count"),
    )
    return per_day.where(
        (F.col("coin_count") >= min_entities) & (F.col("unchanged_coin_count") == F.col("coin_count"))
    )


def duplicate_fetch_dates(daily: DataFrame, min_entities: int = MIN_ENTITIES_FOR_DUPLICATE) -> DataFrame:
    return unchanged_days(daily, min_entities, compared_only=True)


def no_stale_null_change(daily: DataFrame, panel: DataFrame) -> DataFrame:
    """Rows with a NULL change although the panel holds the entity's previous day."""
    day_before = panel.select(ENTITY, F.date_add(DAY, 1).alias(DAY))
    stale = daily.where(F.col("price_change_pct").isNull()).select(DAY, ENTITY, "price_usd")
    return stale.join(day_before, [ENTITY, DAY], "left_semi").select(DAY, ENTITY, "price_usd")


def calendar_contiguous(availability: DataFrame) -> DataFrame:
    """Days of the spine that do not follow the day before, with the day they do follow.

    The window has no partition key, and needs none: after ``distinct`` the spine has one row
    per calendar day.
    """
    days = availability.select(DAY).distinct()
    previous = F.lag(DAY).over(Window.orderBy(DAY)).alias("previous_date")
    pairs = days.select(DAY, previous)
    return pairs.where(F.datediff(DAY, "previous_date") != 1)


def counts_nonnegative(availability: DataFrame) -> DataFrame:
    counts = (
        "expected_asset_count", "silver_row_count", "daily_snapshot_row_count",
        "rank_change_row_count", "weekly_average_row_count",
    )
    return availability.where(reduce(lambda a, b: a | b, (F.col(c) < 0 for c in counts)))


def status_consistent(availability: DataFrame) -> DataFrame:
    """Days whose status contradicts their counts or their reason."""
    status, reason, silver = F.col("availability_status"), F.col("availability_reason"), F.col("silver_row_count")
    short = (
        (silver < F.col("expected_asset_count"))
        | (F.col("daily_snapshot_row_count") != silver)
        | (F.col("rank_change_row_count") != silver)
        | (F.col("weekly_average_row_count") != silver)
    )
    return availability.where(
        ((status == "missing") & (silver != 0))
        | ((status == "available") & short)
        | ((status == "available") & reason.isNotNull())
        | ((status != "available") & reason.isNull())
    )


def gold_covers_silver(panel: DataFrame, first: DataFrame, second: DataFrame) -> DataFrame:
    """Panel days that one of two builds lacks."""
    days = rows_by_day({"silver": panel, "first": first, "second": second})
    return days.where(F.col("silver_row_count").isNotNull()).select(
        DAY,
        F.col("first_row_count").isNotNull().alias("in_first_build"),
        F.col("second_row_count").isNotNull().alias("in_second_build"),
    ).where(~(F.col("in_first_build") & F.col("in_second_build")))


def implementations_agree(first: DataFrame, second: DataFrame) -> DataFrame:
    """Days on which two builds of one table differ in rows."""
    days = rows_by_day({"first": first, "second": second})
    return days.where(~F.col("first_row_count").eqNullSafe(F.col("second_row_count")))


def serving_models_agree(daily: DataFrame, rank: DataFrame, rolling: DataFrame) -> DataFrame:
    """Days on which the three tables differ in rows; days of any of them line up."""
    days = rows_by_day({"daily_snapshot": daily, "rank_change": rank, "weekly_average": rolling})
    base = F.col("daily_snapshot_row_count")
    return days.where(
        ~base.eqNullSafe(F.col("rank_change_row_count")) | ~base.eqNullSafe(F.col("weekly_average_row_count"))
    )


def price_positive(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Non-positive prices with the name of their table."""
    found = [
        df.where(F.col("price_usd") <= 0).select(F.lit(name).alias("model_name"), ENTITY, DAY, "price_usd")
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, found)


def post_write_counts(tables: Mapping[str, DataFrame], span: Span | None = None) -> DataFrame:
    """Rows per table and day after a load, all tables in one job."""
    labelled = [
        in_span(df.select(DAY), DAY, span).select(F.lit(name).alias("table_name"), DAY)
        for name, df in tables.items()
    ]
    stacked = reduce(DataFrame.unionByName, labelled)
    return stacked.groupBy("table_name", DAY).agg(F.count(F.lit(1)).alias("row_count"))


def missing_after_write(tables: Mapping[str, DataFrame], days: DataFrame) -> DataFrame:
    """(table, day) of every requested day for which a table holds no row; other days are not counted.

    For tables on storage ``sources.listing`` answers from file footers.
    """
    names = F.explode(F.array(*(F.lit(name) for name in tables))).alias("table_name")
    asked = days.select(DAY).distinct()
    wanted = asked.select(names, DAY)
    some = {name: df.join(F.broadcast(asked), DAY, "left_semi") for name, df in tables.items()}  # calendar days
    return wanted.join(post_write_counts(some), ["table_name", DAY], "left_anti")


def require_rows(tables: Mapping[str, DataFrame], days: DataFrame) -> None:
    """Raise when a table lacks rows on one of ``days``; the message names the first of them."""
    absent = missing_after_write(tables, days).orderBy(DAY, "table_name").limit(5).collect()
    if absent:
        raise ValueError("no rows: " + ", ".join(f"{row.table_name} on {row[DAY]}" for row in absent))


def missing_input_dates(present: DataFrame, span: Span) -> DataFrame:
    """Days of the span without input; a range load waits until there is none."""
    return missing_days(calendar(present.sparkSession, *span), present)
