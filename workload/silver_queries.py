"""Landed files, contracts, typed tables, history repair, merges and writes."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrid.functions import dates, text
from daygrid.operators.dedup import duplicated_keys, latest_by_key
from daygrid.operators.upsert import upsert
from daygrid.plans import history, silver
from daygrid.schemas import DAY, ENTITY, KEY, MARKET_CAP_ALIASES
from daygrid.session import scratch_dir
from daygrid.sinks.filecopy import sync_files
from daygrid.sinks.partitions import (
    append_partitions,
    copy_days,
    drop_stored_column,
    merge_partitions,
    read_version,
    upsert_version,
    write_history,
    write_partitions,
    write_snapshots,
)
from daygrid.sources import inventory, payloads, snapshots
from workload import panels, sql
from workload.registry import query

# ---------------------------------------------------------------- landed files

LANDED = (date(2024, 1, 5), date(2024, 1, 24))

RAW_SQL = sql.ctes("e") + """, raw AS (
  SELECT coin_id AS id, snapshot_date,
         coalesce(symbol, upper(coin_id)) AS symbol, coalesce(name, coin_id) AS name,
         CAST(day(snapshot_date) AS DOUBLE) AS supply,
         CASE WHEN day(snapshot_date) > 15 THEN 31.0::DOUBLE END AS max_supply,
         CASE WHEN price_usd >= 10 THEN price_usd END AS price_usd,
         market_cap_usd, volume_usd_24hr, 0.1::DOUBLE AS change_percent_24hr, vwap_24hr
  FROM e LEFT JOIN e_dim ON coin_id = e_dim.id)
"""


@query(
    "bronze_scan",
    RAW_SQL
    + """SELECT id, symbol, name, supply, price_usd, snapshot_date,
                epoch_ms(CAST(snapshot_date AS TIMESTAMP)) AS api_timestamp_ms FROM raw
         WHERE snapshot_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-24'""",
)
def bronze_scan(spark: SparkSession, root: str) -> DataFrame:
    landed = scratch_dir(spark, "landed")
    write_snapshots(panels.raw_snapshots(spark, root), landed)
    files = snapshots.read_snapshots(spark, landed, LANDED)
    return files.select(
        "id", "symbol", "name", F.col("supply").try_cast("double").alias("supply"),
        F.col("priceUsd").try_cast("double").alias("price_usd"), DAY, "api_timestamp_ms",
    )


@query(
    "window_scan",
    sql.ctes("n")
    + "SELECT * FROM n WHERE snapshot_date BETWEEN DATE '1997-01-01' AND DATE '1998-12-31'",
)
def window_scan(spark, root):
    return dates.in_span(panels.nation_panel(spark, root), DAY, (date(1997, 1, 1), date(1998, 12, 31)))


@query(
    "optional_column_scan",
    """SELECT event_id, CAST(value AS DOUBLE) AS price_usd,
              CASE WHEN event_type = 'purchase' THEN value END AS volume_usd_24hr,
              CAST(NULL AS DOUBLE) AS vwap_24hr FROM events""",
)
def optional_column_scan(spark, root):
    """Two vintages of one table: purchases carry a volume column, the other rows never had it."""
    events = panels.table(spark, root, "events")
    old = events.where("event_type <> 'purchase'").select("event_id", F.col("value").alias("priceUsd"))
    new = events.where("event_type = 'purchase'").select(
        "event_id", F.col("value").alias("priceUsd"), F.col("value").alias("volumeUsd24Hr")
    )
    both = old.unionByName(new, allowMissingColumns=True)
    return both.select(
        "event_id",
        text.optional_column(both, "priceUsd", "double").alias("price_usd"),
        text.optional_column(both, "volumeUsd24Hr", "double").alias("volume_usd_24hr"),
        text.optional_column(both, "vwap24Hr", "double").alias("vwap_24hr"),
    )


@query(
    "dates_from_paths",
    "SELECT DISTINCT CAST(o_orderdate AS DATE) AS snapshot_date FROM orders WHERE o_orderstatus <> 'P'",
)
def dates_from_paths(spark, root):
    day = F.col("o_orderdate")
    folder = F.concat(
        F.lit("landed/assets/year="), F.date_format(day, "yyyy"), F.lit("/month="), F.date_format(day, "MM"),
        F.lit("/day="), F.date_format(day, "dd"), F.lit("/part-"), F.col("o_orderkey"), F.lit(".parquet"),
    )
    other = F.concat(F.lit("diagnostics/year="), F.date_format(day, "yyyy"), F.lit("/run.log"))
    orders = panels.table(spark, root, "orders")
    paths = orders.select(F.when(F.col("o_orderstatus") == "P", other).otherwise(folder).alias("path"))
    return inventory.dates_from_paths(paths)


@query(
    "sync_plan",
    """SELECT DISTINCT CAST(o_orderdate AS DATE) AS snapshot_date FROM orders
       WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '2000-12-31'
         AND CAST(o_orderdate AS DATE) NOT IN
             (SELECT CAST(o_orderdate AS DATE) FROM orders WHERE o_orderpriority = '1-URGENT')""",
)
def sync_plan(spark, root):
    orders = panels.table(spark, root, "orders")
    day = F.to_date("o_orderdate").alias(DAY)
    local = orders.where("o_orderpriority = '1-URGENT'").select(day)
    return inventory.sync_plan(orders.select(day), local, date(1996, 1, 1), date(2000, 12, 31))


@query(
    "capture_freshness",
    """SELECT max(CAST(ts AS DATE)) AS newest_date,
              CAST(DATE '2024-02-03' - max(CAST(ts AS DATE)) AS INTEGER) AS age_days,
              CASE WHEN DATE '2024-02-03' - max(CAST(ts AS DATE)) > 2 THEN 'stale' ELSE 'fresh' END AS status
       FROM events""",
)
def capture_freshness(spark, root):
    return inventory.freshness(panels.event_days(spark, root), date(2024, 2, 3))


# ---------------------------------------------------------------- JSON payloads


def _quoted(column: Column) -> Column:
    return F.concat(F.lit('"'), column, F.lit('"'))


def asset_payloads(spark: SparkSession, root: str) -> DataFrame:
    """One response per order, holding an asset record; some break the contract.

    Status O: the price is a JSON number. Low priority: the symbol is absent. Urgent: no
    timestamp. Not specified: cut-off JSON. The rest is sound.
    """
    orders = panels.table(spark, root, "orders")
    price = F.col("o_totalprice").cast("decimal(18,2)").cast("string")
    level = F.col("o_orderpriority")
    record = F.concat(
        F.lit('{"id":'), _quoted(F.concat(F.lit("c"), F.col("o_custkey"))),
        F.lit(',"rank":"1",'),
        F.when(level == "5-LOW", F.lit("")).otherwise(F.lit('"symbol":"SYM",')),
        F.lit('"name":"Name","supply":"10","maxSupply":null,"marketCapUsd":"7","volumeUsd24Hr":"8",'),
        F.lit('"changePercent24Hr":"0.5","priceUsd":'),
        F.when(F.col("o_orderstatus") == "O", price).otherwise(_quoted(price)),
        F.lit("}"),
    )
    stamp = F.when(level == "1-URGENT", F.lit("")).otherwise(F.concat(F.lit(',"timestamp":'), F.col("o_orderkey")))
    whole = F.concat(F.lit('{"data":['), record, F.lit("]"), stamp, F.lit("}"))
    payload = F.when(level == "4-NOT SPECIFIED", F.concat(F.lit('{"data":['), record)).otherwise(whole)
    return orders.select("o_orderkey", F.to_date("o_orderdate").alias(DAY), payload.alias("payload"))


QUARANTINE_CASE = """CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'not JSON'
   WHEN o_orderpriority = '1-URGENT' THEN 'no integer timestamp'
   WHEN o_orderpriority = '5-LOW' THEN 'missing symbol'
   WHEN o_orderstatus = 'O' THEN 'not a string: priceUsd' END"""


@query(
    "contract_quarantine",
    f"""SELECT o_orderkey, snapshot_date, reason FROM (
        SELECT o_orderkey, CAST(o_orderdate AS DATE) AS snapshot_date, {QUARANTINE_CASE} AS reason FROM orders)
        WHERE reason IS NOT NULL""",
)
def contract_quarantine(spark, root):
    return payloads.quarantined(asset_payloads(spark, root), "payload", payloads.ASSETS).drop("payload")


ACCEPTED_SQL = f"""SELECT o_orderkey, CAST(o_orderdate AS DATE) AS snapshot_date,
        'c' || o_custkey AS id, 'SYM' AS symbol, CAST(o_totalprice AS DOUBLE) AS price_usd,
        CAST(NULL AS VARCHAR) AS "maxSupply", o_orderkey AS api_timestamp_ms
        FROM orders WHERE {QUARANTINE_CASE} IS NULL"""


@query("contract_accepted", ACCEPTED_SQL)
def contract_accepted(spark, root):
    rows = payloads.accepted(asset_payloads(spark, root), "payload", payloads.ASSETS)
    return rows.select(
        "o_orderkey", DAY, "id", "symbol", F.col("priceUsd").try_cast("double").alias("price_usd"),
        "maxSupply", "api_timestamp_ms",
    )


@query(
    "bronze_contract_write",
    f"SELECT id, snapshot_date, price_usd, api_timestamp_ms FROM ({ACCEPTED_SQL})",
)
def bronze_contract_write(spark, root):
    """Accepted records written to the dated layout and read back."""
    landed = scratch_dir(spark, "contract")
    rows = payloads.accepted(asset_payloads(spark, root), "payload", payloads.ASSETS)
    write_snapshots(rows.drop("o_orderkey"), landed)
    return snapshots.read_snapshots(spark, landed).select(
        "id", DAY, F.col("priceUsd").try_cast("double").alias("price_usd"), "api_timestamp_ms"
    )


def history_payloads(spark: SparkSession, root: str) -> DataFrame:
    """One history response per event: an envelope of two points, or a bare list for clicks."""
    events = panels.table(spark, root, "events")
    value = F.col("value").cast("decimal(18,2)").cast("string")
    point = F.concat(F.lit('{"time":'), F.col("event_id"), F.lit(',"priceUsd":'), value, F.lit(',"extra":1}'))
    later = F.concat(
        F.lit('{"time":"'), F.col("event_id") + 1, F.lit('","priceUsd":'), _quoted(value),
        F.lit(',"volumeUsd24Hr":'), F.col("user_id"), F.lit("}"),
    )
    both = F.concat(F.lit("["), point, F.lit(","), later, F.lit("]"))
    bare = F.col("event_type") == "click"
    envelope = F.concat(F.lit('{"data":'), both, F.lit(',"timestamp":'), F.col("event_id"), F.lit("}"))
    return events.select("event_id", F.when(bare, both).otherwise(envelope).alias("payload"))


@query(
    "json_payload_explode",
    """SELECT event_id, event_id + k AS "time", value AS price_usd,
              CASE WHEN k = 1 THEN CAST(user_id AS DOUBLE) END AS volume_usd_24hr,
              CASE WHEN event_type <> 'click' THEN event_id END AS api_timestamp_ms
       FROM events, (VALUES (0), (1)) AS p(k)""",
)
def json_payload_explode(spark, root):
    rows = payloads.accepted(history_payloads(spark, root), "payload", payloads.ASSET_HISTORY)
    return rows.select(
        "event_id",
        F.col("time").cast("long").alias("time"),
        F.col("priceUsd").try_cast("double").alias("price_usd"),
        F.col("volumeUsd24Hr").try_cast("double").alias("volume_usd_24hr"),
        "api_timestamp_ms",
    )


@query(
    "alias_coalesce",
    """SELECT 'nation_' || c_nationkey AS coin_id, CAST(o_orderdate AS DATE) AS snapshot_date,
              o_totalprice AS market_cap_usd FROM orders JOIN customer ON o_custkey = c_custkey""",
)
def alias_coalesce(spark, root):
    raw = panels.raw_nation_caps(spark, root)
    value = text.first_present(raw, MARKET_CAP_ALIASES)
    return raw.select(
        ENTITY, dates.date_of_text(F.col("date")).alias(DAY), value.try_cast("double").alias("market_cap_usd")
    )


@query(
    "parse_id_list",
    """SELECT p_partkey, CASE WHEN p_size > 25 THEN p_brand || '|' || p_type
                              ELSE p_name || '|' || p_brand || '|' || p_type END AS ids,
              CASE WHEN p_size > 25 THEN 2 ELSE 3 END AS id_count FROM part""",
)
def parse_id_list(spark, root):
    part = panels.table(spark, root, "part")
    as_json = F.concat(
        F.lit('[" '), F.col("p_brand"), F.lit('", "'), F.col("p_type"), F.lit('  ", "", null]')
    )
    as_csv = F.concat(F.lit(" "), "p_name", F.lit(" ,,"), "p_brand", F.lit(" , "), "p_type", F.lit(",  "))
    ids = text.id_list(F.when(F.col("p_size") > 25, as_json).otherwise(as_csv))
    return part.select("p_partkey", F.array_join(ids, "|").alias("ids"), F.size(ids).alias("id_count"))


# ---------------------------------------------------------------- typed tables


@query(
    "silver_clean",
    RAW_SQL
    + """SELECT id, snapshot_date, symbol, name, supply, max_supply, price_usd, market_cap_usd,
                volume_usd_24hr, change_percent_24hr, vwap_24hr FROM raw""",
)
def silver_clean(spark, root):
    return silver.clean_snapshots(panels.raw_snapshots(spark, root))


@query(
    "required_field_nulls",
    RAW_SQL
    + """SELECT count(*) FILTER (WHERE id IS NULL) AS id_nulls, count(*) FILTER (WHERE symbol IS NULL) AS symbol_nulls,
                count(*) FILTER (WHERE name IS NULL) AS name_nulls,
                count(*) FILTER (WHERE price_usd IS NULL) AS price_usd_nulls FROM raw""",
)
def required_field_nulls(spark, root):
    return silver.required_field_nulls(silver.clean_snapshots(panels.raw_snapshots(spark, root)))


@query(
    "silver_price_snapshots",
    RAW_SQL
    + """SELECT id AS coin_id, snapshot_date, price_usd, market_cap_usd, volume_usd_24hr, change_percent_24hr,
                vwap_24hr FROM raw""",
)
def silver_price_snapshots(spark, root):
    """Typed panel rows written to a table partitioned by day and read back."""
    cleaned = silver.clean_snapshots(panels.raw_snapshots(spark, root))
    path = scratch_dir(spark, "price_snapshots")
    write_partitions(silver.price_rows(cleaned), path)
    return spark.read.parquet(path)


@query(
    "silver_coins",
    RAW_SQL
    + """SELECT id, symbol, name, supply, max_supply FROM raw
         QUALIFY row_number() OVER (PARTITION BY id ORDER BY snapshot_date DESC) = 1""",
)
def silver_coins(spark, root):
    return silver.coin_rows(silver.clean_snapshots(panels.raw_snapshots(spark, root)))


# ---------------------------------------------------------------- history repair

POINTS_SQL = """WITH points AS (
  SELECT 'user_' || user_id AS coin_id, CAST(ts AS DATE) AS snapshot_date, epoch_ms(ts) AS ms, value AS price_usd,
         CASE WHEN event_type = 'purchase' THEN value END AS volume_usd_24hr FROM events)
"""


@query(
    "history_event_date",
    """SELECT event_id, CAST(ts AS DATE) AS by_text_or_time, CAST(ts AS DATE) AS by_time,
              CASE WHEN event_type <> 'view' THEN CAST(ts AS DATE) END AS by_text FROM events""",
)
def history_event_date(spark, root):
    events = panels.table(spark, root, "events")
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    iso = F.when(F.col("event_type") != "view", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"))
    return events.select(
        "event_id",
        dates.event_date(iso, ms).alias("by_text_or_time"),
        dates.date_of_epoch_ms(ms).alias("by_time"),
        dates.date_of_text(iso).alias("by_text"),
    )


@query(
    "epoch_ms_day_bounds",
    """SELECT event_id, epoch_ms(CAST(CAST(ts AS DATE) AS TIMESTAMP)) AS day_start_ms,
              epoch_ms(CAST(CAST(ts AS DATE) + 1 AS TIMESTAMP)) - 1 AS day_end_ms FROM events""",
)
def epoch_ms_day_bounds(spark, root):
    day = F.to_date("ts")
    return panels.table(spark, root, "events").select(
        "event_id", dates.day_start_ms(day).alias("day_start_ms"), dates.day_end_ms(day).alias("day_end_ms")
    )


@query(
    "clean_asset_history",
    POINTS_SQL
    + """SELECT coin_id, snapshot_date, price_usd, volume_usd_24hr FROM points
         QUALIFY row_number() OVER (PARTITION BY coin_id, snapshot_date
           ORDER BY ms DESC, price_usd DESC NULLS LAST, volume_usd_24hr DESC NULLS LAST) = 1""",
)
def clean_asset_history(spark, root):
    return history.clean_asset_history(panels.raw_user_history(spark, root))


@query(
    "clean_asset_market_cap_history",
    f"""SELECT {sql.NATION_ID} AS coin_id, CAST(o_orderdate AS DATE) AS snapshot_date,
               max(o_totalprice) AS market_cap_usd FROM {sql.ORDERS} GROUP BY 1, 2""",
)
def clean_asset_market_cap_history(spark, root):
    return history.clean_asset_market_cap_history(panels.raw_nation_caps(spark, root))


@query(
    "clean_total_market_cap_history",
    """SELECT CAST(o_orderdate AS DATE) AS snapshot_date, max(o_totalprice) AS total_market_cap_usd
       FROM orders GROUP BY 1""",
)
def clean_total_market_cap_history(spark, root):
    return history.clean_total_market_cap_history(panels.raw_nation_caps(spark, root).drop(ENTITY))


@query(
    "history_price_with_cap",
    POINTS_SQL
    + """, prices AS (SELECT coin_id, snapshot_date, price_usd, volume_usd_24hr FROM points
           QUALIFY row_number() OVER (PARTITION BY coin_id, snapshot_date
             ORDER BY ms DESC, price_usd DESC NULLS LAST, volume_usd_24hr DESC NULLS LAST) = 1),
         caps AS (SELECT coin_id, snapshot_date, price_usd AS market_cap_usd FROM points
           WHERE volume_usd_24hr IS NOT NULL
           QUALIFY row_number() OVER (PARTITION BY coin_id, snapshot_date
             ORDER BY ms DESC, price_usd DESC NULLS LAST) = 1)
         SELECT p.coin_id, p.snapshot_date, price_usd, market_cap_usd, volume_usd_24hr,
                CAST(NULL AS DOUBLE) AS change_percent_24hr, CAST(NULL AS DOUBLE) AS vwap_24hr
         FROM prices p LEFT JOIN caps c ON c.coin_id = p.coin_id AND c.snapshot_date = p.snapshot_date""",
)
def history_price_with_cap(spark, root):
    raw = panels.raw_user_history(spark, root)
    purchases = raw.where("volumeUsd24Hr IS NOT NULL").select(ENTITY, "time", "date", F.col("priceUsd").alias("marketCapUsd"))
    caps = history.clean_asset_market_cap_history(purchases)
    return history.history_price_rows(history.clean_asset_history(raw), caps)


@query(
    "dedup_latest_by_key",
    """SELECT user_id, event_type, ts, event_id, value FROM events
       QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""",
)
def dedup_latest_by_key(spark, root):
    events = panels.table(spark, root, "events").select("user_id", "event_type", "ts", "event_id", "value")
    return latest_by_key(events, ["user_id", "event_type"], ["ts", "event_id"])


@query(
    "backfill_plan",
    """SELECT 'nation_' || n_nationkey AS coin_id, d AS anchor_snapshot_date, 60 AS backfill_days,
              d - 60 AS window_start_date, d - 1 AS window_end_date
       FROM nation, (SELECT max(CAST(o_orderdate AS DATE)) AS d FROM orders)""",
)
def backfill_plan(spark, root):
    return history.backfill_plan(panels.nation_dim(spark, root), panels.order_days(spark, root), 60)


# ---------------------------------------------------------------- merges and writes

MERGED_SQL = sql.ctes(sql.N_OTHER, sql.N_URGENT)


def _repair(spark: SparkSession, root: str) -> DataFrame:
    """Urgent orders as repaired days: no change and no vwap."""
    return panels.urgent_panel(spark, root, True).withColumn("vwap_24hr", F.lit(None).cast("double"))


@query(
    "merge_panel_history",
    MERGED_SQL
    + """SELECT coalesce(u.coin_id, o.coin_id) AS coin_id, coalesce(u.snapshot_date, o.snapshot_date) AS snapshot_date,
           CASE WHEN u.coin_id IS NULL THEN o.price_usd ELSE u.price_usd END AS price_usd,
           CASE WHEN u.coin_id IS NULL THEN o.market_cap_usd ELSE u.market_cap_usd END AS market_cap_usd,
           CASE WHEN u.coin_id IS NULL THEN o.volume_usd_24hr ELSE u.volume_usd_24hr END AS volume_usd_24hr,
           CAST(NULL AS DOUBLE) AS change_percent_24hr,
           CASE WHEN u.coin_id IS NULL THEN o.vwap_24hr END AS vwap_24hr
         FROM n_other o FULL JOIN n_urgent u ON o.coin_id = u.coin_id AND o.snapshot_date = u.snapshot_date""",
)
def merge_panel_history(spark, root):
    return upsert(panels.urgent_panel(spark, root, False), _repair(spark, root), KEY)


@query(
    "merge_entity_day_measure",
    MERGED_SQL
    + """SELECT coalesce(u.coin_id, o.coin_id) AS coin_id, coalesce(u.snapshot_date, o.snapshot_date) AS snapshot_date,
           coalesce(u.market_cap_usd, o.market_cap_usd) AS market_cap_usd
         FROM n_other o FULL JOIN n_urgent u ON o.coin_id = u.coin_id AND o.snapshot_date = u.snapshot_date""",
)
def merge_entity_day_measure(spark, root):
    columns = (*KEY, "market_cap_usd")
    target = panels.urgent_panel(spark, root, False).select(*columns)
    return upsert(target, _repair(spark, root).select(*columns), KEY)


@query(
    "merge_day_total",
    """WITH u AS (SELECT CAST(o_orderdate AS DATE) AS d, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS t
                  FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY 1),
            o AS (SELECT CAST(o_orderdate AS DATE) AS d, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS t
                  FROM orders WHERE o_orderpriority <> '1-URGENT' GROUP BY 1)
       SELECT coalesce(u.d, o.d) AS snapshot_date, coalesce(u.t, o.t) AS total_market_cap_usd
       FROM o FULL JOIN u ON o.d = u.d""",
)
def merge_day_total(spark, root):
    orders = panels.table(spark, root, "orders")

    def totals(rows: DataFrame) -> DataFrame:
        return rows.groupBy(F.to_date("o_orderdate").alias(DAY)).agg(
            F.sum(panels.money("o_totalprice")).cast("double").alias("total_market_cap_usd")
        )

    urgent = F.col("o_orderpriority") == "1-URGENT"
    return upsert(totals(orders.where(~urgent)), totals(orders.where(urgent)), [DAY])


@query(
    "upsert_dimension",
    """SELECT 'supplier_' || s_suppkey AS id, s_name AS name,
              CASE WHEN s_acctbal < 7000 THEN s_acctbal * 2 ELSE s_acctbal END AS supply,
              CASE WHEN s_acctbal >= 7000 THEN 21.0::DOUBLE END AS max_supply FROM supplier""",
)
def upsert_dimension(spark, root):
    """Known suppliers above 5000, updates below 7000: some rows change, some appear, some stay."""
    suppliers = panels.table(spark, root, "supplier")
    identity = (F.concat(F.lit("supplier_"), "s_suppkey").alias("id"), F.col("s_name").alias("name"))
    known = suppliers.where("s_acctbal > 5000").select(
        *identity, F.col("s_acctbal").alias("supply"), F.lit(21.0).alias("max_supply")
    )
    updates = suppliers.where("s_acctbal < 7000").select(
        *identity, (F.col("s_acctbal") * 2).alias("supply"), F.lit(None).cast("double").alias("max_supply")
    )
    return upsert(known, updates, ["id"])


WRITTEN = f"""{sql.ctes(sql.E)} SELECT coin_id, snapshot_date, market_cap_usd,
   CASE WHEN snapshot_date >= DATE '2024-01-20' THEN price_usd * 2 ELSE price_usd END AS price_usd FROM e"""


@query("overwrite_partitions", WRITTEN)
def overwrite_partitions(spark, root):
    """A table written by day, its last days replaced twice: other days stay, reruns change nothing."""
    path = scratch_dir(spark, "overwrite")
    rows = panels.user_panel(spark, root).select(*KEY, "price_usd", "market_cap_usd")
    write_partitions(rows, path)
    newer = rows.where(F.col(DAY) >= F.lit(date(2024, 1, 20))).withColumn("price_usd", F.col("price_usd") * 2)
    write_partitions(newer, path)
    write_partitions(newer, path)
    write_partitions(newer.where("price_usd < 0"), path)  # nothing to replace
    return spark.read.parquet(path)


@query(
    "merge_partitions",
    sql.ctes(sql.E)
    + """SELECT coin_id, snapshot_date, CASE WHEN volume_usd_24hr IS NULL THEN price_usd ELSE -price_usd END AS price_usd
         FROM e WHERE volume_usd_24hr IS NOT NULL OR market_cap_usd > 100""",
)
def merge_partitions_query(spark, root):
    """Keyed merge into a stored table: negated prices of rows with volume, known or new."""
    path = scratch_dir(spark, "merge")
    panel = panels.user_panel(spark, root)
    write_partitions(panel.where("market_cap_usd > 100").select(*KEY, "price_usd"), path)
    source = panel.where("volume_usd_24hr IS NOT NULL").select(*KEY, (-F.col("price_usd")).alias("price_usd"))
    merge_partitions(path, source, KEY)
    return spark.read.parquet(path)


@query("drop_legacy_column", "SELECT s_suppkey AS id, s_name, s_acctbal FROM supplier")
def drop_legacy_column(spark, root):
    """A column leaves a stored table; a second removal finds nothing to do."""
    path = scratch_dir(spark, "migrated")
    upsert_version(path, panels.table(spark, root, "supplier").withColumnRenamed("s_suppkey", "id"), ["id"])
    for _ in range(2):
        drop_stored_column(spark, path, "s_nationkey")
    return read_version(spark, path)


@query("append_partitions", "SELECT event_id, event_type, value FROM events")
def append(spark, root):
    """A table partitioned by type, written from one half of the events and extended by the other."""
    path = scratch_dir(spark, "appended")
    rows = panels.table(spark, root, "events").select("event_id", "event_type", "value")
    write_partitions(rows.where("value < 50"), path, ("event_type",))
    append_partitions(rows.where("NOT value < 50 OR value IS NULL"), path, ("event_type",))
    return spark.read.parquet(path)


@query(
    "sync_copy_days",
    """SELECT CAST(ts AS DATE) AS snapshot_date, count(*) AS row_count, count(*) FILTER (WHERE event_type = 'error') AS errors
       FROM events GROUP BY 1""",
)
def sync_copy_days(spark, root):
    """Absent days are copied, then all days again with ``overwrite``: a damaged local day is replaced."""
    local = scratch_dir(spark, "local")
    events = panels.table(spark, root, "events").select("event_id", "event_type", F.to_date("ts").alias(DAY))
    write_snapshots(events.where((F.dayofmonth(DAY) % 3 == 0) & (F.col("event_type") != "error")), local)

    def stored():
        days = spark.read.parquet(local)
        return days.withColumn(DAY, F.make_date("year", "month", "day"))

    copy_days(inventory.sync_plan(events, stored()), events, local)
    copy_days(inventory.sync_plan(events, stored(), overwrite=True), events, local)
    return stored().groupBy(DAY).agg(F.count("*").alias("row_count"), F.count_if(F.col("event_type") == "error").alias("errors"))


@query(
    "sync_copy_files",
    """SELECT CAST(ts AS DATE) AS snapshot_date, count(*) AS row_count, count(*) FILTER (WHERE event_type = 'error') AS errors,
              CASE WHEN dayofmonth(CAST(ts AS DATE)) % 3 = 0 THEN 'copied' ELSE 'kept' END AS action, true AS same_bytes
       FROM events GROUP BY 1""",
)
def sync_copy_files(spark, root):
    """Captured files arrive byte for byte: first the days up to a bound, then the rest, then all again with ``overwrite``,
    after some local days were written from other rows."""
    captured, local = scratch_dir(spark, "captured"), scratch_dir(spark, "copied")
    events = panels.table(spark, root, "events").select("event_id", "event_type", F.to_date("ts").alias(DAY))
    write_snapshots(events, captured)
    sync_files(spark, captured, local, end=date(2024, 1, 31))
    write_snapshots(events.where((F.dayofmonth(DAY) % 3 == 0) & (F.col("event_type") != "error")), local)
    sync_files(spark, captured, local)
    done = sync_files(spark, captured, local, overwrite=True).where("action <> 'removed'")

    def digests(folder, name):
        files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
        return files.select(F.regexp_extract("path", r"year=.*", 0).alias("path"), F.sha2("content", 256).alias(name))

    checked = done.join(digests(captured, "_theirs"), "path", "full_outer").join(digests(local, "_ours"), "path", "full_outer")
    same = F.col("_theirs").eqNullSafe(F.col("_ours")) & F.col("sha256").eqNullSafe(F.col("_ours"))
    days = checked.groupBy(text.date_from_path(F.col("path")).alias(DAY)).agg(
        F.array_join(F.array_sort(F.collect_set("action")), ",").alias("action"), F.bool_and(same).alias("same_bytes")
    )
    rows = spark.read.parquet(local).groupBy(F.make_date("year", "month", "day").alias(DAY))
    counts = rows.agg(F.count("*").alias("row_count"), F.count_if(F.col("event_type") == "error").alias("errors"))
    return counts.join(days, DAY, "full_outer")


@query(
    "history_landing",
    """SELECT 'user_' || user_id AS coin_id, CAST(ts AS DATE) AS snapshot_date, count(*) AS points
       FROM events GROUP BY 1, 2""",
)
def history_landing(spark, root):
    """History records landed in the layout of a backfill and read back."""
    landed = scratch_dir(spark, "history")
    raw = panels.raw_user_history(spark, root)
    write_history(raw, landed, date(2024, 2, 1), 60, "asset_history")
    back = snapshots.read_history(spark, landed, date(2024, 2, 1), 60, "asset_history")
    day = F.date_from_unix_date(F.floor(F.col("time") / 86_400_000).cast("int"))
    return back.groupBy(ENTITY, day.alias(DAY)).agg(F.count("*").alias("points"))


@query(
    "history_malformed_time",
    "SELECT DISTINCT 'user_' || user_id AS coin_id, CAST(ts AS DATE) AS snapshot_date FROM events",
)
def history_malformed_time(spark, root):
    """A time that is malformed or in nanoseconds loses no point that has a good date."""
    raw = panels.raw_user_history(spark, root)
    dated, ms = F.col("date").isNotNull(), F.col("time")
    nanos = F.when(dated & (ms % 3 == 1), ms * 1_000_000).otherwise(ms)
    time = F.when(dated & (ms % 3 == 0), F.lit("12:30")).otherwise(nanos.cast("string"))
    return history.clean_asset_history(raw.withColumn("time", time)).select(ENTITY, DAY)


@query(
    "merge_cardinality_check",
    """SELECT o_custkey, CAST(o_orderdate AS DATE) AS snapshot_date, count(*) AS row_count
       FROM orders GROUP BY 1, 2 HAVING count(*) > 1""",
)
def merge_cardinality_check(spark, root):
    source = panels.table(spark, root, "orders").select("o_custkey", F.to_date("o_orderdate").alias(DAY))
    return duplicated_keys(source, ["o_custkey", DAY])
