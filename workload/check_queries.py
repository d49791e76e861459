"""Data checks on sound tables and on tables broken on purpose."""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daygrid import schemas
from daygrid.functions.dates import days_of
from daygrid.functions.numeric import pct_change
from daygrid.operators import closeness, fingerprint
from daygrid.plans import checks, gold, serving
from daygrid.schemas import DAY, ENTITY, KEY
from daygrid.session import scratch_dir
from daygrid.sinks import contract
from daygrid.sinks.partitions import write_partitions
from daygrid.sources import listing
from workload import panels, sql
from workload.gold_queries import AVAILABILITY_SQL, EXPECTED, inputs, nation_availability, nation_tables
from workload.registry import query

N_ALL = sql.ctes("n", sql.daily("n"), sql.rank_change("n"), sql.rolling("n", "rows"))
N_DAILY = sql.ctes("n", sql.daily("n"))
LOST = "coin_id = 'nation_7' AND day(snapshot_date) = 1"
HOLES = (date(1996, 2, 10), date(1996, 2, 11), date(1997, 7, 1))
HOLES_SQL = "DATE '1996-02-10', DATE '1996-02-11', DATE '1997-07-01'"


def nation_daily(spark, root):
    return gold.daily_snapshot(*inputs(spark, root, "n"), method="window")


def lossy_daily(spark, root):
    """The daily table without one nation on first days of months."""
    return nation_daily(spark, root).where(f"NOT ({LOST})")


# ---------------------------------------------------------------- keys, NULLs, references

REQUIRED = (*KEY, "price_usd")


def _not_null_sql(*models: tuple[str, str]) -> str:
    parts = [
        f"SELECT '{label}' AS model_name, '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS null_count FROM {table}"
        for label, table in models
        for c in REQUIRED
    ]
    return "SELECT * FROM (" + " UNION ALL ".join(parts) + ") WHERE null_count > 0"


@query(
    "chk_not_null",
    N_ALL + _not_null_sql(("daily_snapshot", "n_daily"), ("rank_change", "n_rank"), ("rolling_average", "n_roll")),
)
def chk_not_null(spark, root):
    _, daily, rank, rolling = nation_tables(spark, root)
    return checks.not_null(
        {
            "daily_snapshot": (daily, REQUIRED),
            "rank_change": (rank, REQUIRED),
            "rolling_average": (rolling, REQUIRED),
        }
    )


HOLED_DAILY = """holed AS (SELECT CASE WHEN day(snapshot_date) <> 15 THEN coin_id END AS coin_id, snapshot_date,
   CASE WHEN coin_rank <> 3 THEN price_usd END AS price_usd FROM n_daily)"""


@query("chk_not_null_broken", sql.ctes("n", sql.daily("n"), HOLED_DAILY) + _not_null_sql(("daily_snapshot", "holed")))
def chk_not_null_broken(spark, root):
    holed = nation_daily(spark, root).select(
        F.when(F.dayofmonth(DAY) != 15, F.col(ENTITY)).alias(ENTITY),
        DAY,
        F.when(F.col("coin_rank") != 3, F.col("price_usd")).alias("price_usd"),
    )
    return checks.not_null({"daily_snapshot": (holed, REQUIRED)})


@query("chk_unique_key", N_DAILY + "SELECT snapshot_date, coin_id, count(*) AS row_count FROM n_daily GROUP BY 1, 2 HAVING count(*) > 1")
def chk_unique_key(spark, root):
    return checks.unique_key(nation_daily(spark, root), [DAY, ENTITY])


@query(
    "chk_unique_key_broken",
    N_DAILY
    + """SELECT snapshot_date, coin_id, count(*) AS row_count FROM
         (SELECT snapshot_date, coin_id FROM n_daily UNION ALL
          SELECT snapshot_date, coin_id FROM n_daily WHERE price_usd > 450000) GROUP BY 1, 2 HAVING count(*) > 1""",
)
def chk_unique_key_broken(spark, root):
    rows = panels.nation_panel(spark, root)
    return checks.unique_key(rows.unionByName(rows.where("price_usd > 450000")), [DAY, ENTITY])


@query(
    "chk_relationships",
    sql.ctes("n") + "SELECT coin_id, count(*) AS row_count FROM n WHERE coin_id NOT IN (SELECT id FROM n_dim) GROUP BY 1",
)
def chk_relationships(spark, root):
    return checks.relationships(*inputs(spark, root, "n"))


@query(
    "chk_relationships_broken",
    sql.ctes("e") + "SELECT coin_id, count(*) AS row_count FROM e WHERE coin_id NOT IN (SELECT id FROM e_dim) GROUP BY 1",
)
def chk_relationships_broken(spark, root):
    return checks.relationships(*inputs(spark, root, "e"))


# ---------------------------------------------------------------- changes over gaps

# A day follows a gap when the distinct day before it lies more than a day back, or there is none.
GAPS_SQL = """, days AS (
    SELECT snapshot_date, sum(from_silver) AS silver_row_count, sum(1 - from_silver) AS gold_row_count,
           sum(changed) AS populated_change_row_count
    FROM (SELECT snapshot_date, 1 AS from_silver, 0 AS changed FROM n
          UNION ALL
          SELECT snapshot_date, 0, CASE WHEN coalesce(prev_price_usd, price_change_pct, price_change_rank) IS NULL THEN 0 ELSE 1 END
          FROM {table}) GROUP BY 1),
  stepped AS (SELECT *, date_diff('day', lag(snapshot_date) OVER (ORDER BY snapshot_date), snapshot_date) AS step
              FROM days WHERE silver_row_count > 0)
  SELECT snapshot_date, CAST(silver_row_count AS BIGINT) AS silver_row_count, CAST(gold_row_count AS BIGINT) AS gold_row_count,
         CAST(populated_change_row_count AS BIGINT) AS populated_change_row_count
  FROM stepped
  WHERE step IS DISTINCT FROM 1 AND (silver_row_count - gold_row_count, populated_change_row_count) <> (0, 0)"""

INVENTED = """invented AS (SELECT snapshot_date, coin_id,
   CASE WHEN coin_rank = 1 AND price_usd > 300000 THEN price_usd ELSE prev_price_usd END AS prev_price_usd,
   CASE WHEN coin_rank = 2 THEN 1.5::DOUBLE ELSE price_change_pct END AS price_change_pct, price_change_rank
   FROM n_daily WHERE NOT (coin_rank = 3 AND price_usd > 300000))"""


def invented_daily(spark, root):
    """Changes on rows that cannot have one, and some rows lost."""
    first = (F.col("coin_rank") == 1) & (F.col("price_usd") > 300000)
    return (
        nation_daily(spark, root)
        .where("NOT (coin_rank = 3 AND price_usd > 300000)")
        .select(
            DAY,
            ENTITY,
            F.when(first, F.col("price_usd")).otherwise(F.col("prev_price_usd")).alias("prev_price_usd"),
            F.when(F.col("coin_rank") == 2, F.lit(1.5)).otherwise(F.col("price_change_pct")).alias("price_change_pct"),
            "price_change_rank",
        )
    )


@query("chk_gap_dates_retained", N_DAILY + GAPS_SQL.format(table="n_daily"))
def chk_gap_dates_retained(spark, root):
    return checks.gap_dates_retained(panels.nation_panel(spark, root), nation_daily(spark, root))


@query(
    "chk_gap_dates_retained_broken",
    sql.ctes("n", sql.daily("n"), INVENTED) + GAPS_SQL.format(table="invented"),
)
def chk_gap_dates_retained_broken(spark, root):
    return checks.gap_dates_retained(panels.nation_panel(spark, root), invented_daily(spark, root))


GAP_NULLS = "WHERE prev_price_usd IS NULL AND (price_change_pct IS NOT NULL OR price_change_rank IS NOT NULL)"


@query("chk_gap_values_null", N_DAILY + f"SELECT * FROM n_daily {GAP_NULLS}")
def chk_gap_values_null(spark, root):
    return checks.gap_values_null(nation_daily(spark, root))


@query("chk_gap_values_null_broken", sql.ctes("n", sql.daily("n"), INVENTED) + f"SELECT * FROM invented {GAP_NULLS}")
def chk_gap_values_null_broken(spark, root):
    return checks.gap_values_null(invented_daily(spark, root))


UNCHANGED_SQL = """SELECT snapshot_date, count(*) AS coin_count,
   count(*) FILTER (WHERE price_usd = prev_price_usd) AS unchanged_coin_count FROM {table} {where}
   GROUP BY 1 HAVING count(*) >= {least} AND count(*) FILTER (WHERE price_usd = prev_price_usd) = count(*)"""
# The user panel with the prices of 11 January repeated under 12 January.
COPIED = """e_copied AS (SELECT * FROM e WHERE snapshot_date <> DATE '2024-01-12' UNION ALL
   SELECT coin_id, DATE '2024-01-12', price_usd, market_cap_usd, volume_usd_24hr, change_percent_24hr, vwap_24hr
   FROM e WHERE snapshot_date = DATE '2024-01-11')"""
COPIED_DAILY = sql.ctes(
    sql.E, COPIED, sql.DIMS["e"].replace("e_dim", "e_copied_dim"), sql.daily("e_copied")
)


def copied_daily(spark, root):
    panel, dim = inputs(spark, root, "e")
    copy = panel.where(F.col(DAY) == F.lit(date(2024, 1, 11))).withColumn(DAY, F.lit(date(2024, 1, 12)))
    return gold.daily_snapshot(panel.where(F.col(DAY) != F.lit(date(2024, 1, 12))).unionByName(copy), dim)


@query(
    "chk_duplicate_fetch_dates",
    sql.ctes("e", sql.daily("e"))
    + UNCHANGED_SQL.format(table="e_daily", where="WHERE prev_price_usd IS NOT NULL", least=5),
)
def chk_duplicate_fetch_dates(spark, root):
    return checks.duplicate_fetch_dates(gold.daily_snapshot(*inputs(spark, root, "e")))


@query(
    "chk_duplicate_fetch_dates_broken",
    COPIED_DAILY + UNCHANGED_SQL.format(table="e_copied_daily", where="WHERE prev_price_usd IS NOT NULL", least=5),
)
def chk_duplicate_fetch_dates_broken(spark, root):
    return checks.duplicate_fetch_dates(copied_daily(spark, root))


@query("unchanged_days", COPIED_DAILY + UNCHANGED_SQL.format(table="e_copied_daily", where="", least=1))
def unchanged_days(spark, root):
    return checks.unchanged_days(copied_daily(spark, root))


STALE_SQL = """SELECT g.snapshot_date, g.coin_id, g.price_usd FROM {table} g
   JOIN n p ON p.coin_id = g.coin_id AND p.snapshot_date = g.snapshot_date - 1 WHERE g.price_change_pct IS NULL"""


@query("chk_no_stale_null_change", N_DAILY + STALE_SQL.format(table="n_daily"))
def chk_no_stale_null_change(spark, root):
    return checks.no_stale_null_change(nation_daily(spark, root), panels.nation_panel(spark, root))


@query(
    "chk_no_stale_null_change_broken",
    sql.ctes(
        "n", sql.daily("n"),
        """stale AS (SELECT snapshot_date, coin_id, price_usd,
             CASE WHEN coin_id <> 'nation_3' THEN price_change_pct END AS price_change_pct FROM n_daily)""",
    )
    + STALE_SQL.format(table="stale"),
)
def chk_no_stale_null_change_broken(spark, root):
    stale = F.when(F.col(ENTITY) != "nation_3", F.col("price_change_pct"))
    daily = nation_daily(spark, root).withColumn("price_change_pct", stale)
    return checks.no_stale_null_change(daily, panels.nation_panel(spark, root))


# ---------------------------------------------------------------- availability


def lossy_availability(spark, root):
    panel, _, rank, rolling = nation_tables(spark, root)
    end = panels.nation_end(spark, root)
    return serving.availability(panel, lossy_daily(spark, root), rank, rolling, end, expected=EXPECTED)


@query("availability_daily_broken", sql.ctes("n", sql.availability("n", EXPECTED, LOST)) + "SELECT * FROM avail")
def availability_daily_broken(spark, root):
    return lossy_availability(spark, root)


BAD_STATUS = """bad AS (SELECT * REPLACE (
   CASE WHEN day(snapshot_date) = 3 THEN 'late' ELSE availability_status END AS availability_status,
   CASE WHEN day(snapshot_date) = 5 AND availability_status = 'available' THEN 'silver_missing'
        WHEN day(snapshot_date) = 7 THEN NULL ELSE availability_reason END AS availability_reason,
   CASE WHEN day(snapshot_date) = 9 THEN -1 ELSE rank_change_row_count END AS rank_change_row_count)
   FROM avail)"""
BAD_SQL = sql.ctes("n", sql.availability("n", EXPECTED), BAD_STATUS)


def bad_availability(spark, root):
    """Unknown statuses, contradicting reasons and negative counts on some days of each month."""
    day = F.dayofmonth(DAY)
    status, reason = F.col("availability_status"), F.col("availability_reason")
    return nation_availability(spark, root).withColumns(
        {
            "availability_status": F.when(day == 3, F.lit("late")).otherwise(status),
            "availability_reason": F.when((day == 5) & (status == "available"), F.lit("silver_missing"))
            .when(day == 7, F.lit(None))
            .otherwise(reason),
            "rank_change_row_count": F.when(day == 9, F.lit(-1)).otherwise(F.col("rank_change_row_count")),
        }
    )


ACCEPTED_SQL = """SELECT availability_status AS value, count(*) AS row_count FROM {table}
   WHERE availability_status NOT IN ('available', 'partial', 'missing') GROUP BY 1"""
CONSISTENT_SQL = """SELECT * FROM {table} WHERE (availability_status = 'missing' AND silver_row_count <> 0)
   OR (availability_status = 'available' AND (silver_row_count < expected_asset_count
       OR daily_snapshot_row_count <> silver_row_count OR rank_change_row_count <> silver_row_count
       OR weekly_average_row_count <> silver_row_count OR availability_reason IS NOT NULL))
   OR (availability_status <> 'available' AND availability_reason IS NULL)"""
NEGATIVE_SQL = """SELECT * FROM {table} WHERE least(expected_asset_count, silver_row_count, daily_snapshot_row_count,
   rank_change_row_count, weekly_average_row_count) < 0"""
CONTIGUOUS_SQL = """SELECT * FROM (SELECT snapshot_date, lag(snapshot_date) OVER (ORDER BY snapshot_date) AS previous_date
   FROM avail {where}) WHERE snapshot_date - previous_date <> 1"""

for _name, _check, _sql in (
    ("chk_accepted_values", checks.accepted_values, ACCEPTED_SQL),
    ("chk_status_consistent", checks.status_consistent, CONSISTENT_SQL),
    ("chk_counts_nonnegative", checks.counts_nonnegative, NEGATIVE_SQL),
):

    @query(_name, AVAILABILITY_SQL + _sql.format(table="avail"))
    def sound(spark, root, check=_check):
        return check(nation_availability(spark, root))

    @query(f"{_name}_broken", BAD_SQL + _sql.format(table="bad"))
    def broken(spark, root, check=_check):
        return check(bad_availability(spark, root))


@query("chk_calendar_contiguous", AVAILABILITY_SQL + CONTIGUOUS_SQL.format(where=""))
def chk_calendar_contiguous(spark, root):
    return checks.calendar_contiguous(nation_availability(spark, root))


@query(
    "chk_calendar_contiguous_broken",
    AVAILABILITY_SQL + CONTIGUOUS_SQL.format(where=f"WHERE snapshot_date NOT IN ({HOLES_SQL})"),
)
def chk_calendar_contiguous_broken(spark, root):
    table = nation_availability(spark, root)
    return checks.calendar_contiguous(table.where(~F.col(DAY).isin(*HOLES)))


# ---------------------------------------------------------------- coverage and agreement

COVERS_SQL = """SELECT s.snapshot_date, f.snapshot_date IS NOT NULL AS in_first_build,
   g.snapshot_date IS NOT NULL AS in_second_build
   FROM (SELECT DISTINCT snapshot_date FROM n) s
   LEFT JOIN (SELECT DISTINCT snapshot_date FROM n_daily WHERE {first}) f USING (snapshot_date)
   LEFT JOIN (SELECT DISTINCT snapshot_date FROM n_daily WHERE {second}) g USING (snapshot_date)
   WHERE f.snapshot_date IS NULL OR g.snapshot_date IS NULL"""
LATE_BUILD = "snapshot_date < DATE '2001-01-01'"
SMALL_LOST = "NOT (coin_rank = 1 AND price_usd < 100000)"


def joined_daily(spark, root):
    """The daily table built a second way: by a self-join on the previous day instead of a window."""
    panel, dim = inputs(spark, root, "n")
    before = panel.select(ENTITY, F.date_add(DAY, 1).alias(DAY), F.col("price_usd").alias("prev_price_usd"))
    joined = panel.join(before, [ENTITY, DAY], "left")
    changed = joined.withColumn("price_change_pct", pct_change(F.col("price_usd"), F.col("prev_price_usd")))
    return gold.with_dimension(gold.with_change_rank(gold.with_cap_rank(changed, method="window"), method="window"), dim)


@query("chk_gold_covers_silver", N_DAILY + COVERS_SQL.format(first="TRUE", second="TRUE"))
def chk_gold_covers_silver(spark, root):
    return checks.gold_covers_silver(
        panels.nation_panel(spark, root), nation_daily(spark, root), joined_daily(spark, root)
    )


@query("chk_gold_covers_silver_broken", N_DAILY + COVERS_SQL.format(first=LATE_BUILD, second=SMALL_LOST))
def chk_gold_covers_silver_broken(spark, root):
    daily = nation_daily(spark, root)
    return checks.gold_covers_silver(
        panels.nation_panel(spark, root), daily.where(LATE_BUILD), daily.where(SMALL_LOST)
    )


AGREE_SQL = """SELECT snapshot_date, f.n AS first_row_count, g.n AS second_row_count
   FROM (SELECT snapshot_date, count(*) AS n FROM n_daily WHERE {first} GROUP BY 1) f
   FULL JOIN (SELECT snapshot_date, count(*) AS n FROM n_daily WHERE {second} GROUP BY 1) g USING (snapshot_date)
   WHERE f.n IS DISTINCT FROM g.n"""


@query("chk_implementations_agree", N_DAILY + AGREE_SQL.format(first="TRUE", second="TRUE"))
def chk_implementations_agree(spark, root):
    return checks.implementations_agree(nation_daily(spark, root), joined_daily(spark, root))


@query("chk_implementations_agree_broken", N_DAILY + AGREE_SQL.format(first=LATE_BUILD, second=f"NOT ({LOST})"))
def chk_implementations_agree_broken(spark, root):
    return checks.implementations_agree(nation_daily(spark, root).where(LATE_BUILD), lossy_daily(spark, root))


SERVING_SQL = """SELECT snapshot_date, d.n AS daily_snapshot_row_count, r.n AS rank_change_row_count,
   w.n AS weekly_average_row_count
   FROM (SELECT snapshot_date, count(*) AS n FROM n_daily WHERE {daily} GROUP BY 1) d
   FULL JOIN (SELECT snapshot_date, count(*) AS n FROM n_rank WHERE {rank} GROUP BY 1) r USING (snapshot_date)
   FULL JOIN (SELECT snapshot_date, count(*) AS n FROM n_roll GROUP BY 1) w USING (snapshot_date)
   WHERE d.n IS DISTINCT FROM r.n OR d.n IS DISTINCT FROM w.n"""


@query("chk_serving_models_agree", N_ALL + SERVING_SQL.format(daily="TRUE", rank="TRUE"))
def chk_serving_models_agree(spark, root):
    _, daily, rank, rolling = nation_tables(spark, root)
    return checks.serving_models_agree(daily, rank, rolling)


@query("chk_serving_models_agree_broken", N_ALL + SERVING_SQL.format(daily=f"NOT ({LOST})", rank=LATE_BUILD))
def chk_serving_models_agree_broken(spark, root):
    _, _, rank, rolling = nation_tables(spark, root)
    return checks.serving_models_agree(lossy_daily(spark, root), rank.where(LATE_BUILD), rolling)


def _positive_sql(price: str) -> str:
    models = (("daily_snapshot", "n_daily"), ("rank_change", "n_rank"), ("rolling_average", "n_roll"))
    parts = [
        f"SELECT '{label}' AS model_name, coin_id, snapshot_date, {price} AS price_usd FROM {table}"
        for label, table in models
    ]
    return "SELECT * FROM (" + " UNION ALL ".join(parts) + ") WHERE price_usd <= 0"


@query("chk_price_positive", N_ALL + _positive_sql("price_usd"))
def chk_price_positive(spark, root):
    _, daily, rank, rolling = nation_tables(spark, root)
    return checks.price_positive({"daily_snapshot": daily, "rank_change": rank, "rolling_average": rolling})


@query(
    "chk_price_positive_broken",
    N_ALL + _positive_sql("CASE WHEN coin_id = 'nation_5' THEN -price_usd ELSE price_usd END"),
)
def chk_price_positive_broken(spark, root):
    _, *tables = nation_tables(spark, root)
    price = F.when(F.col(ENTITY) == "nation_5", -F.col("price_usd")).otherwise(F.col("price_usd"))
    names = ("daily_snapshot", "rank_change", "rolling_average")
    return checks.price_positive({n: t.withColumn("price_usd", price) for n, t in zip(names, tables)})


@query(
    "post_write_counts",
    N_ALL
    + """SELECT table_name, snapshot_date, count(*) AS row_count FROM (
           SELECT 'daily_snapshot' AS table_name, snapshot_date FROM n_daily UNION ALL
           SELECT 'rank_change', snapshot_date FROM n_rank UNION ALL
           SELECT 'rolling_average', snapshot_date FROM n_roll)
         WHERE snapshot_date BETWEEN DATE '1997-01-01' AND DATE '1997-12-31' GROUP BY 1, 2""",
)
def post_write_counts(spark, root):
    _, *tables = nation_tables(spark, root)
    names = ("daily_snapshot", "rank_change", "rolling_average")
    return checks.post_write_counts(dict(zip(names, tables)), (date(1997, 1, 1), date(1997, 12, 31)))


@query(
    "missing_input_dates",
    """SELECT d AS snapshot_date FROM (SELECT CAST(unnest(generate_series(DATE '1995-01-01', DATE '2001-12-31',
         INTERVAL 1 DAY)) AS DATE) AS d) WHERE d NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders)""",
)
def missing_input_dates(spark, root):
    return checks.missing_input_dates(panels.order_days(spark, root), (date(1995, 1, 1), date(2001, 12, 31)))


@query(
    "missing_after_write",
    """WITH d AS (SELECT CAST(o_orderdate AS DATE) AS snapshot_date FROM orders UNION SELECT CAST(l_shipdate AS DATE) FROM lineitem)
       SELECT 'ordered' AS table_name, snapshot_date FROM d WHERE snapshot_date NOT IN (SELECT CAST(o_orderdate AS DATE) FROM orders)
       UNION ALL
       SELECT 'shipped', snapshot_date FROM d WHERE snapshot_date NOT IN (SELECT CAST(l_shipdate AS DATE) FROM lineitem)""",
)
def missing_after_write(spark, root):
    ordered = panels.order_days(spark, root)
    shipped = panels.table(spark, root, "lineitem").select(F.to_date("l_shipdate").alias(DAY))
    return checks.missing_after_write({"ordered": ordered, "shipped": shipped}, ordered.union(shipped))


def stored_user_panel(spark, root, where=None):
    """The user panel as a table partitioned by day; its path."""
    panel = inputs(spark, root, "e")[0]
    path = scratch_dir(spark, "user-days")
    write_partitions(panel if where is None else panel.where(where), path)
    return path


@query("stored_day_rows", sql.ctes("e") + "SELECT snapshot_date, count(*) AS row_count FROM e GROUP BY 1")
def stored_day_rows(spark, root):
    return listing.stored_rows(spark, stored_user_panel(spark, root))


@query("newest_stored_day", sql.ctes("e") + "SELECT max(snapshot_date) AS snapshot_date FROM e")
def newest_stored_day(spark, root):
    return listing.day_frame(spark, [listing.newest_stored_day(spark, stored_user_panel(spark, root))])


@query(
    "missing_stored_days",
    sql.ctes("e")
    + """, d AS (SELECT CAST(unnest(generate_series(min(snapshot_date), max(snapshot_date) + 3, INTERVAL 1 DAY)) AS DATE) AS day FROM e)
       SELECT 'all' AS table_name, day AS snapshot_date FROM d WHERE day NOT IN (SELECT snapshot_date FROM e)
       UNION ALL
       SELECT 'lossy', day FROM d WHERE day NOT IN (SELECT snapshot_date FROM e WHERE day(snapshot_date) <> 13)""",
)
def missing_stored_days(spark, root):
    tables = {"all": stored_user_panel(spark, root), "lossy": stored_user_panel(spark, root, "day(snapshot_date) <> 13")}
    held = listing.folder_days(spark, tables["all"])
    return listing.missing_stored_days(spark, tables, days_of((held[0], held[-1] + timedelta(3))))


def _violations_sql(table: str, column: str, where: str, source: str) -> str:
    return f"""SELECT '{table}' AS table_name, '{column}' AS column_name, 'NULL in a required column' AS problem, count(*) AS row_count
               FROM {source} WHERE {where} HAVING count(*) > 0"""


@query(
    "contract_violations",
    sql.ctes("n", "e")
    + " UNION ALL ".join([
        _violations_sql("price_snapshots", "coin_id", "coin_id = 'nation_7'", "n"),
        _violations_sql("price_snapshots", "snapshot_date", "day(snapshot_date) = 1", "n"),
        _violations_sql("coins", "id", "symbol = 'U5'", "e_dim"),
        _violations_sql("asset_market_cap_history", "coin_id", "coin_id = 'user_3'", "e"),
        _violations_sql("total_market_cap_history", "snapshot_date", "day(snapshot_date) < 4", "(SELECT DISTINCT snapshot_date FROM e)"),
        """SELECT 'total_market_cap_history', 'total_market_cap_usd', 'type bigint, declared double', NULL""",
        """SELECT 'asset_market_cap_history', 'vwap_24hr', 'column not declared', NULL""",
        _violations_sql("daily_snapshot", "coin_id", "market_cap_usd > 400000", "n"),
    ]),
)
def contract_violations(spark, root):
    """Frames broken on purpose, one for each kind of declared schema; what a checked write of them refuses."""
    nations, users = (inputs(spark, root, p)[0] for p in ("n", "e"))
    dim = inputs(spark, root, "e")[1].withColumns({c: F.lit(1.0) for c in ("supply", "max_supply")})
    gone = lambda column, where: F.when(~F.expr(where), F.col(column))
    daily = gold.daily_snapshot(*inputs(spark, root, "n"), method="window")
    frames = {
        "price_snapshots": (
            nations.withColumns({ENTITY: gone(ENTITY, "coin_id = 'nation_7'"), DAY: gone(DAY, "day(snapshot_date) = 1")}),
            schemas.PRICE_SNAPSHOTS,
        ),
        "coins": (dim.withColumn("id", gone("id", "symbol = 'U5'")), schemas.COINS),
        "asset_market_cap_history": (
            users.select(gone(ENTITY, "coin_id = 'user_3'").alias(ENTITY), DAY, "market_cap_usd", "vwap_24hr"),
            schemas.ASSET_MARKET_CAP,
        ),
        "total_market_cap_history": (
            users.groupBy(gone(DAY, "day(snapshot_date) < 4").alias(DAY), F.col(DAY).alias("_day")).count()
            .select(DAY, F.col("count").alias("total_market_cap_usd")),
            schemas.TOTAL_MARKET_CAP,
        ),
        "daily_snapshot": (daily.withColumn(ENTITY, gone(ENTITY, "market_cap_usd > 400000")), schemas.DAILY_SNAPSHOT),
    }
    found = [contract.violations(df, schema).withColumn("table_name", F.lit(name)) for name, (df, schema) in frames.items()]
    return reduce(DataFrame.unionByName, found)


@query(
    "frames_apart",
    """WITH l AS (SELECT l_orderkey, l_linenumber, l_extendedprice / 3 AS x, l_discount AS y FROM lineitem WHERE l_partkey % 50 <> 7),
       r AS (SELECT l_orderkey, l_linenumber, y, x + CASE WHEN l_suppkey % 20 = 3 THEN 0.01 WHEN l_linenumber % 2 = 0 THEN 4e-7
               ELSE -4e-7 END AS x
             FROM (SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, l_extendedprice / 3 AS x, l_discount AS y FROM lineitem)
             WHERE l_partkey % 50 <> 8),
       lines AS (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY 1, 2 HAVING count(*) = 1),
       apart AS (SELECT l_orderkey, l_linenumber, l.x AS lx, l.y AS ly, r.x AS rx, r.y AS ry
                 FROM l FULL JOIN r USING (l_orderkey, l_linenumber) JOIN lines USING (l_orderkey, l_linenumber)
                 WHERE l.x IS NULL OR r.x IS NULL OR abs(l.x - r.x) > 1e-6)
       SELECT l_orderkey, l_linenumber, round(lx, 3) AS x, ly AS y, 'left' AS side, 1 AS copies FROM apart WHERE lx IS NOT NULL
       UNION ALL
       SELECT l_orderkey, l_linenumber, round(rx, 3), ry, 'right', 1 FROM apart WHERE rx IS NOT NULL""",
)
def frames_apart(spark, root):
    """Prices of lines against the same moved by less than the tolerance, some by more, some rows missing on either side."""
    lines = panels.table(spark, root, "lineitem")
    key = ["l_orderkey", "l_linenumber"]
    x = F.col("l_extendedprice") / 3
    move = F.when(F.col("l_suppkey") % 20 == 3, 0.01).when(F.col("l_linenumber") % 2 == 0, 4e-7).otherwise(-4e-7)
    used = lines.dropna(subset=key).select(*key, "l_partkey", "l_suppkey", "l_extendedprice", "l_discount")
    rows = used.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy(*key))).where("_n = 1")
    left = rows.where("l_partkey % 50 <> 7").select("l_orderkey", "l_linenumber", x.alias("x"), F.col("l_discount").alias("y"))
    right = rows.where("l_partkey % 50 <> 8").select("l_orderkey", "l_linenumber", (x + move).alias("x"), F.col("l_discount").alias("y"))
    return closeness.frames_apart(left, right, 1e-6).withColumn("x", F.round("x", 3))


@query(
    "changed_days",
    """
    WITH marked AS (
        SELECT DISTINCT CAST(l_shipdate AS DATE) AS snapshot_date FROM lineitem
    )
    SELECT snapshot_date, CASE WHEN day(snapshot_date) = 13 THEN 'removed' WHEN day(snapshot_date) = 17 THEN 'added' ELSE 'changed' END AS change
    FROM marked WHERE day(snapshot_date) IN (7, 13, 17, 21)
    """,
)
def changed_days(spark, root):
    """Days of all line items against the same rows in another order: some dearer, dropped, new, or one column's value NULL."""
    lines = spark.read.parquet(f"{root}/lineitem.parquet").withColumn(DAY, F.to_date("l_shipdate"))
    day = F.dayofmonth(DAY)
    before = lines.where(day != 17)
    price = F.when(day == 7, F.col("l_extendedprice") + 1).when(day != 21, F.col("l_extendedprice"))
    after = lines.where(day != 13).withColumn("l_extendedprice", price).select(*reversed(lines.columns)).repartition("l_partkey")
    return fingerprint.changed_days(*(fingerprint.day_fingerprints(df) for df in (before, after)))
