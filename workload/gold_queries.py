"""Analytical tables, their windows and the serving tables."""

from __future__ import annotations

from datetime import date
from itertools import pairwise

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrid.functions.numeric import pct_change
from daygrid.operators.lookback import with_day_over_day
from daygrid.operators.spine import calendar_of
from daygrid.plans import gold, rolling_state, serving
from daygrid.schemas import DAY, ENTITY
from daygrid.session import scratch_dir
from daygrid.sinks.partitions import staged, write_partitions
from daygrid.sources.listing import folder_days
from workload import panels, sql
from workload.registry import query

SOURCES = {
    "n": (panels.nation_panel, panels.nation_dim),
    "e": (panels.user_panel, panels.user_dim),
    "s": (panels.supplier_panel, panels.supplier_dim),
}
SUFFIX = {"n": "", "e": "_users", "s": "_suppliers"}
AS_OF = {"n": date(1998, 3, 6), "e": date(2024, 1, 15), "s": date(1998, 3, 6)}
# A day holds one row per nation: small enough for one sort task. Days of users and suppliers grow with the data.
SMALL_DAYS = {"method": "window"}
DAYS_OF = {"n": panels.order_days, "e": panels.event_days}


def inputs(spark: SparkSession, root: str, p: str) -> tuple[DataFrame, DataFrame]:
    panel, dim = SOURCES[p]
    return panel(spark, root), dim(spark, root)


def as_of_span(spark: SparkSession, root: str, p: str) -> tuple[date, date]:
    day = panels.latest_day(DAYS_OF[p](spark, root), AS_OF[p])
    return day, day


def _register_tables(p: str) -> None:
    suffix = SUFFIX[p]
    ranking = SMALL_DAYS if p == "n" else {}
    day = sql.day_of(p, AS_OF[p].isoformat())

    @query(f"gold_daily_snapshot_full{suffix}", sql.ctes(p, sql.daily(p)) + f"SELECT * FROM {p}_daily")
    def daily_full(spark, root):
        return gold.daily_snapshot(*inputs(spark, root, p), **ranking)

    @query(f"gold_rank_change_full{suffix}", sql.ctes(p, sql.rank_change(p)) + f"SELECT * FROM {p}_rank")
    def rank_full(spark, root):
        return gold.rank_change(*inputs(spark, root, p), **ranking)

    for frame in ("rows", "calendar"):

        @query(
            f"gold_rolling_average_{frame}{suffix}",
            sql.ctes(p, sql.rolling(p, frame)) + f"SELECT * FROM {p}_roll",
        )
        def rolling_full(spark, root, frame=frame):
            return gold.rolling_average(*inputs(spark, root, p), frame=frame)

    # The same ranks with days cut into cells, as days of many million rows are.
    @query(
        f"rank_of_large_days{suffix}",
        sql.ctes(p, sql.daily(p))
        + f"SELECT coin_id, snapshot_date, coin_rank, price_change_rank FROM {p}_daily",
    )
    def large_days(spark, root):
        daily = gold.daily_snapshot(*inputs(spark, root, p), cell_rows=5)
        return daily.select(ENTITY, DAY, "coin_rank", "price_change_rank")

    if p == "s":
        return

    @query(
        f"gold_daily_snapshot_asof{suffix}",
        sql.ctes(p, sql.daily(p)) + f"SELECT * FROM {p}_daily WHERE snapshot_date = {day}",
    )
    def daily_asof(spark, root):
        return gold.daily_snapshot(*inputs(spark, root, p), as_of_span(spark, root, p), **ranking)

    @query(
        f"gold_rank_change_asof{suffix}",
        sql.ctes(p, sql.rank_change(p)) + f"SELECT * FROM {p}_rank WHERE snapshot_date = {day}",
    )
    def rank_asof(spark, root):
        return gold.rank_change(*inputs(spark, root, p), as_of_span(spark, root, p), **ranking)

    @query(
        f"gold_rolling_average_asof{suffix}",
        sql.ctes(p, sql.rolling(p, "calendar")) + f"SELECT * FROM {p}_roll WHERE snapshot_date = {day}",
    )
    def rolling_asof(spark, root):
        return gold.rolling_average(*inputs(spark, root, p), as_of_span(spark, root, p), frame="calendar")

    @query(
        f"day_over_day_change{suffix}",
        sql.ctes(p, sql.daily(p))
        + f"SELECT coin_id, snapshot_date, price_usd, prev_price_usd, price_change_pct FROM {p}_pct",
    )
    def day_over_day(spark, root):
        panel, _ = inputs(spark, root, p)
        return with_day_over_day(panel.select(ENTITY, DAY, "price_usd"))

    @query(
        f"cap_rank{suffix}",
        sql.ctes(p)
        + f"""SELECT coin_id, snapshot_date, market_cap_usd, CAST(rank() OVER (
              PARTITION BY snapshot_date ORDER BY market_cap_usd DESC) AS INTEGER) AS coin_rank FROM {p}""",
    )
    def cap_rank(spark, root):
        panel, _ = inputs(spark, root, p)
        return gold.with_cap_rank(panel.select(ENTITY, DAY, "market_cap_usd"))

    @query(
        f"change_rank{suffix}",
        sql.ctes(p, sql.daily(p))
        + f"SELECT coin_id, snapshot_date, price_change_pct, price_change_rank FROM {p}_daily",
    )
    def change_rank(spark, root):
        panel, _ = inputs(spark, root, p)
        changed = with_day_over_day(panel.select(ENTITY, DAY, "price_usd"))
        return gold.with_change_rank(changed.select(ENTITY, DAY, "price_change_pct"))

    @query(
        f"enrich_with_dimension{suffix}",
        sql.ctes(p) + f"SELECT coin_id, snapshot_date, price_usd, symbol, name FROM {p} LEFT JOIN {p}_dim ON coin_id = id",
    )
    def enrich(spark, root):
        panel, dim = inputs(spark, root, p)
        return gold.with_dimension(panel.select(ENTITY, DAY, "price_usd"), dim)

    @query(
        f"latest_snapshot{suffix}",
        sql.ctes(p, sql.daily(p))
        + f"SELECT * FROM {p}_daily WHERE snapshot_date = (SELECT max(snapshot_date) FROM {p}_daily)",
    )
    def latest(spark, root):
        return serving.latest_snapshot(gold.daily_snapshot(*inputs(spark, root, p), **ranking))


for _p in ("n", "e", "s"):
    _register_tables(_p)


def nation_tables(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Panel, daily, rank change and rolling average of the nations, built once, stored and read back.

    A day holds one row per nation at most.
    """
    panel, dim = inputs(spark, root, "n")
    panel = staged(panel, "nation-panel")
    return (
        panel,
        staged(gold.daily_snapshot(panel, dim, **SMALL_DAYS), "nation-daily"),
        staged(gold.rank_change(panel, dim, **SMALL_DAYS), "nation-rank"),
        staged(gold.rolling_average(panel, dim), "nation-rolling"),
    )


EXPECTED = 5
AVAILABILITY_SQL = sql.ctes("n", sql.availability("n", EXPECTED))


def nation_availability(spark: SparkSession, root: str) -> DataFrame:
    return serving.availability(
        *nation_tables(spark, root), end=panels.nation_end(spark, root), expected=EXPECTED
    )


@query("availability_daily", AVAILABILITY_SQL + "SELECT * FROM avail")
def availability_daily(spark, root):
    return nation_availability(spark, root)


@query(
    "calendar_spine",
    """SELECT CAST(unnest(generate_series(min(CAST(o_orderdate AS DATE)), max(CAST(o_orderdate AS DATE)) + 3,
       INTERVAL 1 DAY)) AS DATE) AS snapshot_date FROM orders""",
)
def calendar_spine(spark, root):
    return calendar_of(panels.order_days(spark, root), panels.nation_end(spark, root))


@query(
    "pct_change",
    """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate, l_extendedprice,
              (l_extendedprice - l_tax) / nullif(l_tax, 0) * 100.0 AS change_pct FROM lineitem""",
)
def pct_change_query(spark, root):
    rows = panels.table(spark, root, "lineitem")
    return rows.select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_shipdate", "l_extendedprice",
        pct_change(F.col("l_extendedprice"), F.col("l_tax")).alias("change_pct"),
    )


@query(
    "affected_gold_dates",
    sql.ctes("n")
    + """, changed AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders
           WHERE o_orderstatus = 'P' AND o_totalprice > 490000)
       SELECT DISTINCT d + k AS snapshot_date FROM changed, (VALUES (0),(1),(2),(3),(4),(5),(6),(14),(30)) AS o(k)
       WHERE d + k IN (SELECT snapshot_date FROM n)""",
)
def affected_gold_dates(spark, root):
    orders = panels.table(spark, root, "orders")
    changed = orders.where("o_orderstatus = 'P' AND o_totalprice > 490000").select(
        F.to_date("o_orderdate").alias(DAY)
    )
    return gold.affected_dates(changed, panels.nation_panel(spark, root))


@query("rolling_average_from_state_users", sql.ctes("e", sql.rolling("e", "rows")) + "SELECT * FROM e_roll")
def rolling_from_state(spark, root):
    """The row frame of the user panel in three builds, the later ones from the state the earlier one left."""
    panel, dim = inputs(spark, root, "e")
    stored, states, built = (scratch_dir(spark, name) for name in ("state-panel", "states", "state-built"))
    write_partitions(panel, stored)
    panel, held = spark.read.parquet(stored), folder_days(spark, stored)
    bounds = sorted({0, len(held) // 2, len(held) - 1 if len(held) > 1 else 0, len(held)})
    for first, last in pairwise(bounds):
        days = held[first:last]
        until = panel.where(F.col(DAY) <= F.lit(days[-1]))
        rolling_state.advance(spark, until, dim, states, held[:last], (days[0], days[-1]), lambda t: write_partitions(t, built))
    return spark.read.parquet(built)
