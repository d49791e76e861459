"""Dashboards, key figures, summaries, bounded results and comparisons."""

from __future__ import annotations

from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daygrid.operators import bounded, compare, stats
from daygrid.plans import dashboards, gold, serving
from daygrid.schemas import DAY, ENTITY, document
from daygrid.session import scratch_dir
from daygrid.sources import browse
from workload import panels, sql
from workload.gold_queries import AVAILABILITY_SQL, inputs, nation_availability
from workload.registry import query

# ---------------------------------------------------------------- market dashboards (users)

USER_AS_OF = date(2024, 1, 30)
LAST_30 = "snapshot_date BETWEEN DATE '2024-01-30' - 30 AND DATE '2024-01-30' - 1"
DAILY_SQL = sql.ctes("e", sql.daily("e"))
LATEST = "(SELECT * FROM e_daily WHERE snapshot_date = (SELECT max(snapshot_date) FROM e_daily))"


def user_daily(spark, root):
    return gold.daily_snapshot(*inputs(spark, root, "e"))


@query(
    "dash_latest_market",
    DAILY_SQL
    + f"""SELECT snapshot_date, coin_rank, symbol, name, price_usd, price_change_pct, market_cap_usd, volume_usd_24hr,
                 (SELECT count(*) > 100 FROM {LATEST}) AS truncated
          FROM {LATEST} ORDER BY coin_rank, coin_id LIMIT 100""",
)
def dash_latest_market(spark, root):
    return dashboards.latest_market(serving.latest_snapshot(user_daily(spark, root)))


@query(
    "dash_movers",
    DAILY_SQL
    + f"""SELECT symbol, max(price_change_pct) AS price_change_pct, count(*) OVER () > 25 AS truncated FROM {LATEST} GROUP BY symbol
          ORDER BY price_change_pct DESC NULLS LAST, symbol NULLS FIRST LIMIT 25""",
)
def dash_movers(spark, root):
    return dashboards.movers(serving.latest_snapshot(user_daily(spark, root)))


@query(
    "dash_cumulative_change_30d",
    DAILY_SQL
    + f""", recent AS (SELECT * FROM e_daily WHERE {LAST_30}),
          top AS (SELECT symbol FROM recent GROUP BY symbol ORDER BY avg(market_cap_usd) DESC NULLS LAST, symbol LIMIT 8),
          per_day AS (SELECT symbol, snapshot_date, avg(price_change_pct) AS pct FROM recent
            WHERE EXISTS (SELECT 1 FROM top WHERE top.symbol IS NOT DISTINCT FROM recent.symbol) GROUP BY 1, 2)
          SELECT symbol, snapshot_date,
                 round(sum(pct) OVER (PARTITION BY symbol ORDER BY snapshot_date ROWS UNBOUNDED PRECEDING), 6)
                   AS cumulative_change_pct FROM per_day""",
)
def dash_cumulative_change_30d(spark, root):
    return dashboards.cumulative_change(user_daily(spark, root), USER_AS_OF)


@query(
    "dash_price_vs_rolling",
    sql.ctes("e", sql.rolling("e", "rows"))
    + f""", recent AS (SELECT * FROM e_roll WHERE {LAST_30}),
          top AS (SELECT symbol FROM recent GROUP BY symbol ORDER BY avg(market_cap_usd) DESC NULLS LAST, symbol NULLS FIRST LIMIT 1)
          SELECT symbol, snapshot_date, avg(price_usd) AS price_usd, avg(wkly_roll_avg_price) AS wkly_roll_avg_price
          FROM recent WHERE EXISTS (SELECT 1 FROM top WHERE top.symbol IS NOT DISTINCT FROM recent.symbol) GROUP BY 1, 2""",
)
def dash_price_vs_rolling(spark, root):
    rolling = gold.rolling_average(*inputs(spark, root, "e"))
    return dashboards.price_vs_rolling(rolling, USER_AS_OF)


@query(
    "dash_rank_table",
    sql.ctes("n", sql.rank_change("n"))
    + """SELECT snapshot_date, mc_rank, symbol, name, mc_rank_diff_14d, mc_rank_diff_30d, price_diff_14d_pct,
                price_diff_30d_pct, (SELECT count(*) > 25 FROM n_rank) AS truncated FROM n_rank ORDER BY snapshot_date DESC, mc_rank, coin_id LIMIT 25""",
)
def dash_rank_table(spark, root):
    return dashboards.rank_table(gold.rank_change(*inputs(spark, root, "n"), method="window"))


@query(
    "dash_filtered_market",
    DAILY_SQL
    + """SELECT * FROM e_daily WHERE snapshot_date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'
         AND symbol IN ('U1', 'U3', 'U8') AND coin_rank BETWEEN 1 AND 60""",
)
def dash_filtered_market(spark, root):
    return dashboards.filtered_market(
        user_daily(spark, root), (date(2024, 1, 10), date(2024, 1, 20)), ["U1", "U3", "U8"], (1, 60)
    )


# ---------------------------------------------------------------- availability (nations)

END = "(SELECT max(snapshot_date) FROM avail)"


@query(
    "kpi_freshness_days",
    AVAILABILITY_SQL
    + f"""SELECT CAST({END} - max(CASE WHEN availability_status <> 'missing' THEN snapshot_date END) AS INTEGER)
          AS days_since_last_snapshot FROM avail""",
)
def kpi_freshness_days(spark, root):
    return dashboards.freshness_days(nation_availability(spark, root), panels.nation_end(spark, root))


@query(
    "kpi_coverage_30d",
    AVAILABILITY_SQL
    + f"""SELECT round(100.0::DOUBLE * count(*) FILTER (WHERE availability_status = 'available'
            AND snapshot_date BETWEEN {END} - 30 AND {END} - 1) / 30.0::DOUBLE, 1) AS coverage_last_30_days_pct FROM avail""",
)
def kpi_coverage_30d(spark, root):
    return dashboards.coverage_30d(nation_availability(spark, root), panels.nation_end(spark, root))


# Runs of available days: within a run the day minus its number among available days is constant.
STREAK = """, runs AS (
    SELECT snapshot_date - CAST(row_number() OVER (ORDER BY snapshot_date) AS INTEGER) AS run, snapshot_date
    FROM avail WHERE availability_status = 'available' AND snapshot_date < {at})
  SELECT CASE WHEN {at} IS NOT NULL THEN CAST(count(*) AS INTEGER) END AS consecutive_available_days FROM runs
  WHERE run = (SELECT run FROM runs WHERE snapshot_date = (SELECT max(snapshot_date) FROM avail WHERE snapshot_date < {at}))"""


@query("kpi_available_streak", AVAILABILITY_SQL + STREAK.format(at=END))
def kpi_available_streak(spark, root):
    return dashboards.available_streak(nation_availability(spark, root), panels.nation_end(spark, root))


STREAK_DAY = "(SELECT max(snapshot_date) + 1 FROM avail WHERE availability_status = 'available')"


@query("kpi_available_streak_before", AVAILABILITY_SQL + STREAK.format(at=STREAK_DAY))
def kpi_available_streak_before(spark, root):
    """The streak as it stood right after the last available day, where it is not zero."""
    table = nation_availability(spark, root)
    as_of = table.where("availability_status = 'available'").agg(F.date_add(F.max(DAY), 1)).first()[0]
    return dashboards.available_streak(table, as_of)


@query(
    "dash_coverage_timeline",
    AVAILABILITY_SQL + "SELECT snapshot_date, availability_status, count(*) AS days FROM avail GROUP BY 1, 2",
)
def dash_coverage_timeline(spark, root):
    return dashboards.coverage_timeline(nation_availability(spark, root))


@query(
    "dash_monthly_coverage_mix",
    AVAILABILITY_SQL
    + """, counts AS (SELECT CAST(date_trunc('month', snapshot_date) AS DATE) AS month, availability_status,
                             count(*) AS days FROM avail GROUP BY 1, 2)
         SELECT month, availability_status, days,
                CAST(days AS DOUBLE) / CAST(sum(days) OVER (PARTITION BY month) AS DOUBLE) AS share FROM counts""",
)
def dash_monthly_coverage_mix(spark, root):
    return dashboards.monthly_coverage_mix(nation_availability(spark, root))


@query(
    "dash_field_completeness",
    AVAILABILITY_SQL
    + """SELECT snapshot_date, avg(volume_coverage_pct) AS volume_coverage_pct,
                avg(vwap_coverage_pct) AS vwap_coverage_pct FROM avail GROUP BY 1""",
)
def dash_field_completeness(spark, root):
    return dashboards.field_completeness(nation_availability(spark, root))


@query(
    "dash_availability_detail",
    AVAILABILITY_SQL
    + """SELECT snapshot_date, availability_status, availability_reason, silver_row_count, daily_snapshot_row_count,
                rank_change_row_count, weekly_average_row_count, source_coverage_pct, volume_coverage_pct,
                vwap_coverage_pct, (SELECT count(*) > 1000 FROM avail) AS truncated
         FROM avail ORDER BY snapshot_date DESC LIMIT 1000""",
)
def dash_availability_detail(spark, root):
    return dashboards.availability_detail(nation_availability(spark, root))


# ---------------------------------------------------------------- summaries


@query("rows_per_date", sql.ctes("n") + "SELECT snapshot_date, count(*) AS row_count FROM n GROUP BY 1")
def rows_per_date(spark, root):
    return stats.rows_per_date(panels.nation_panel(spark, root))


@query(
    "field_completeness_by_date",
    sql.ctes("n")
    + """SELECT snapshot_date, count(*) AS row_count, count(volume_usd_24hr) AS volume_usd_24hr_count,
                count(vwap_24hr) AS vwap_24hr_count FROM n GROUP BY 1""",
)
def field_completeness_by_date(spark, root):
    return stats.field_completeness(panels.nation_panel(spark, root), ["volume_usd_24hr", "vwap_24hr"])


@query(
    "date_range_summary",
    sql.ctes("n")
    + "SELECT min(snapshot_date) AS min_date, max(snapshot_date) AS max_date, count(*) AS row_count FROM n",
)
def date_range_summary(spark, root):
    return stats.date_range(panels.nation_panel(spark, root))


@query(
    "entity_coverage",
    sql.ctes("n")
    + """SELECT coin_id, min(snapshot_date) AS min_date, max(snapshot_date) AS max_date, count(*) AS row_count
         FROM n GROUP BY 1""",
)
def entity_coverage(spark, root):
    return stats.entity_coverage(panels.nation_panel(spark, root))


@query(
    "null_summary",
    sql.ctes("n")
    + "SELECT "
    + ", ".join(
        f"count(*) FILTER (WHERE {c} IS NULL) AS {c}_nulls"
        for c in (
            "coin_id", "snapshot_date", "price_usd", "market_cap_usd", "volume_usd_24hr",
            "change_percent_24hr", "vwap_24hr",
        )
    )
    + " FROM n",
)
def null_summary(spark, root):
    return stats.null_counts(panels.nation_panel(spark, root))


@query(
    "count_rows_between",
    sql.ctes("n")
    + "SELECT count(*) AS row_count FROM n WHERE snapshot_date BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'",
)
def count_rows_between(spark, root):
    return stats.count_rows_between(panels.nation_panel(spark, root), (date(1997, 1, 1), date(1997, 12, 31)))


@query(
    "describe_panel",
    sql.ctes("n")
    + "SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, '{kind}' AS data_type, count({name}) AS value_count FROM n"
        for name, kind in (
            ("coin_id", "string"), ("snapshot_date", "date"), ("price_usd", "double"), ("market_cap_usd", "double"),
            ("volume_usd_24hr", "double"), ("change_percent_24hr", "double"), ("vwap_24hr", "double"),
        )
    )
    + ")",
)
def describe_panel(spark, root):
    return browse.describe_panel(document(panels.nation_panel(spark, root))).drop("comment")


@query("table_stats")
def table_stats(spark, root):
    return browse.table_stats(panels.table(spark, root, "lineitem"))


@query("newest_files")
def newest_files(spark, root):
    return browse.newest_files(panels.table(spark, root, "lineitem"))


@query(
    "table_stats_rows",
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count, true AS has_bytes FROM {name}"
        for name in ("lineitem", "orders", "events", "nation")
    ),
)
def table_stats_rows(spark, root):
    """Row counts of the statistics; file sizes and times have no SQL counterpart."""
    found = [
        browse.table_stats(panels.table(spark, root, name)).select(
            F.lit(name).alias("table_name"), "row_count", (F.col("size_bytes") > 0).alias("has_bytes")
        )
        for name in ("lineitem", "orders", "events", "nation")
    ]
    return reduce(DataFrame.unionByName, found)


@query(
    "newest_files_days",
    """SELECT CAST(ts AS DATE) AS snapshot_date, count(*) AS row_count FROM events WHERE day(CAST(ts AS DATE)) % 3 = 0 GROUP BY 1""",
)
def newest_files_days(spark, root):
    """Every third day is written after the others, one file a day: the newest files are those of these days."""
    path = scratch_dir(spark, "two-waves")
    events = panels.table(spark, root, "events").select("event_id", F.to_date("ts").alias(DAY))
    third = F.dayofmonth(DAY) % 3 == 0
    for wave in (~third, third):
        events.where(wave).repartition(DAY).write.mode("append").partitionBy(DAY).parquet(path)
    stored = spark.read.parquet(path)
    days = events.where(third).select(DAY).distinct().count()
    newest = browse.newest_files(stored, days, ceiling=None).select("file_path")
    rows = stored.select(F.col("_metadata.file_path").alias("file_path"), DAY)
    return rows.join(newest, "file_path", "left_semi").groupBy(DAY).agg(F.count("*").alias("row_count"))


@query(
    "catalog_table_profile",
    sql.ctes("n")
    + """SELECT count(*) AS row_count, min(snapshot_date) AS min_date, max(snapshot_date) AS max_date,
                count(*) FILTER (WHERE vwap_24hr IS NULL) AS vwap_24hr_nulls, count(DISTINCT coin_id) AS coins,
                CAST(7 AS BIGINT) AS columns FROM n""",
)
def catalog_table_profile(spark, root):
    """A stored table read by its catalog name: counted, its days and NULLs, and its columns as the catalog describes them."""
    path = scratch_dir(spark, "catalog")
    name = "panel_" + path.rsplit("-", 1)[-1]
    panels.nation_panel(spark, root).write.option("path", path).saveAsTable(name)
    described = browse.describe_table(spark, name).where("col_name <> '' AND NOT startswith(col_name, '#')")
    counted = [
        browse.count_table(spark, name).select("row_count"),
        browse.table_date_range(spark, name).select("min_date", "max_date"),
        browse.table_null_summary(spark, name, ["vwap_24hr"]).select("vwap_24hr_nulls"),
        browse.query_sql(spark, f"SELECT count(DISTINCT coin_id) AS coins FROM {name}"),
        described.agg(F.count_distinct("col_name").alias("columns")),
    ]
    # One row each.
    return reduce(lambda a, b: a.join(b, "_one"), [f.withColumn("_one", F.lit(1)) for f in counted]).drop("_one")


@query(
    "sql_over_views",
    sql.ctes("n") + """SELECT snapshot_date, count(*) AS coins, max(price_usd) AS top_price,
                              count(*) FILTER (WHERE volume_usd_24hr IS NULL) AS without_volume
                       FROM n GROUP BY 1 HAVING count(*) > 1""",
)
def sql_over_views(spark, root):
    """SQL text over a frame registered as a view."""
    browse.register(panels.nation_panel(spark, root), "nation_prices")
    return browse.query_sql(
        spark,
        """SELECT snapshot_date, count(*) AS coins, max(price_usd) AS top_price, count_if(volume_usd_24hr IS NULL) AS without_volume
           FROM nation_prices GROUP BY snapshot_date HAVING count(*) > 1""",
    )


# ---------------------------------------------------------------- bounded results


@query("distinct_values", "SELECT DISTINCT o_orderdate FROM orders ORDER BY o_orderdate LIMIT 50")
def distinct_values(spark, root):
    return bounded.distinct_values(panels.table(spark, root, "orders"), "o_orderdate", 50)


@query(
    "preview_table",
    "SELECT * FROM lineitem ORDER BY l_shipdate, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice LIMIT 20",
)
def preview_table(spark, root):
    order = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    return bounded.preview(panels.table(spark, root, "lineitem"), order)


@query("sample_rows", sql.ctes("s") + "SELECT * FROM s ORDER BY snapshot_date DESC, coin_id LIMIT 20")
def sample_rows(spark, root):
    return bounded.sample(panels.supplier_panel(spark, root), [F.desc(DAY), ENTITY])


@query(
    "bounded_result",
    """SELECT user_id, count(*) AS event_count, count(*) OVER () > 100 AS truncated FROM events GROUP BY user_id
       ORDER BY event_count DESC, user_id LIMIT 100""",
)
def bounded_result(spark, root):
    per_user = panels.table(spark, root, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("event_count"))
    return bounded.bounded(per_user, [F.desc("event_count"), "user_id"], 100)


@query(
    "bounded_result_complete",
    """SELECT event_type, count(*) AS event_count, FALSE AS truncated FROM events GROUP BY event_type""",
)
def bounded_result_complete(spark, root):
    per_type = panels.table(spark, root, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("event_count"))
    return bounded.checked_result(
        bounded.bounded(per_type, ["event_type"], 100), ["event_type", "event_count", "truncated"], True
    )


# ---------------------------------------------------------------- comparisons


@query(
    "frames_diff",
    sql.ctes("n", sql.N_OTHER)
    + """, a AS (SELECT coin_id, snapshot_date, price_usd, market_cap_usd FROM n),
           b AS (SELECT coin_id, snapshot_date, price_usd, market_cap_usd FROM n_other)
         SELECT *, 'left' AS side, CAST(1 AS BIGINT) AS copies FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)
         UNION ALL SELECT *, 'right' AS side, CAST(1 AS BIGINT) AS copies FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""",
)
def frames_diff(spark, root):
    columns = (ENTITY, DAY, "price_usd", "market_cap_usd")
    return compare.frames_diff(
        panels.nation_panel(spark, root).select(*columns), panels.urgent_panel(spark, root, False).select(*columns)
    )


@query(
    "frames_diff_copies",
    """WITH a AS (SELECT l_suppkey, l_returnflag FROM lineitem WHERE l_linestatus = 'F'),
            b AS (SELECT l_suppkey, l_returnflag FROM lineitem WHERE l_linestatus = 'O')
       SELECT l_suppkey, l_returnflag, 'left' AS side, count(*) AS copies FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) GROUP BY 1, 2
       UNION ALL
       SELECT l_suppkey, l_returnflag, 'right' AS side, count(*) AS copies FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a) GROUP BY 1, 2""",
)
def frames_diff_copies(spark, root):
    lines = panels.table(spark, root, "lineitem")
    sides = [lines.where(F.col("l_linestatus") == s).select("l_suppkey", "l_returnflag") for s in ("F", "O")]
    return compare.frames_diff(*sides)
