"""Provenance audits, quotas, lineage, documentation drift and streams."""

from __future__ import annotations

from pyspark.sql import functions as F

from daygrid.operators.reach import closure, reachable
from daygrid.plans import governance, provenance
from daygrid.schemas import DAY
from daygrid.session import scratch_dir
from daygrid.sinks.partitions import write_partitions
from daygrid.sources import snapshots
from daygrid.streaming import compaction, landing
from workload import panels
from workload.registry import query

# ---------------------------------------------------------------- provenance

CAPTURES = """WITH captures AS (
  SELECT event_id, CAST(ts AS DATE) AS snapshot_date,
         CASE WHEN event_type <> 'error' THEN event_id // 2 END AS api_timestamp_ms,
         CASE WHEN event_type <> 'error'
              THEN date_trunc('millisecond', ts) + INTERVAL 12 HOUR * CAST(event_id % 5 AS INTEGER) END AS fetched_at_utc
  FROM events),
lagged AS (
  SELECT *, (epoch_us(fetched_at_utc) - epoch_us(CAST(snapshot_date AS TIMESTAMP))) / 3.6e9::DOUBLE AS lag_hours
  FROM captures)
"""


@query(
    "provenance_by_date",
    CAPTURES
    + """SELECT snapshot_date, min(api_timestamp_ms) AS api_timestamp_ms,
                epoch_us(min(fetched_at_utc)) AS fetched_at_us FROM captures GROUP BY 1""",
)
def provenance_by_date(spark, root):
    days = snapshots.provenance(panels.captures(spark, root))
    return days.select(DAY, "api_timestamp_ms", F.unix_micros("fetched_at_utc").alias("fetched_at_us"))


@query(
    "mislabelled_snapshots",
    CAPTURES
    + """SELECT event_id, snapshot_date, lag_hours,
                CASE WHEN lag_hours < 0 THEN 'early' ELSE 'late' END AS reason
         FROM lagged WHERE lag_hours < 0 OR lag_hours > 36""",
)
def mislabelled_snapshots(spark, root):
    found = provenance.mislabelled(panels.captures(spark, root))
    return found.select("event_id", DAY, "lag_hours", "reason")


@query(
    "duplicate_fetches",
    CAPTURES
    + """SELECT api_timestamp_ms, string_agg(CAST(snapshot_date AS VARCHAR), ',' ORDER BY snapshot_date) AS dates
         FROM (SELECT DISTINCT api_timestamp_ms, snapshot_date FROM captures WHERE api_timestamp_ms IS NOT NULL)
         GROUP BY 1 HAVING count(*) > 1""",
)
def duplicate_fetches(spark, root):
    found = provenance.duplicate_fetches(panels.captures(spark, root))
    return found.select("api_timestamp_ms", F.array_join(F.col("dates").cast("array<string>"), ",").alias("dates"))


@query(
    "provenance_coverage",
    CAPTURES
    + """SELECT count(*) FILTER (WHERE known) AS known_count, count(*) AS total_count,
                count(*) FILTER (WHERE NOT known) AS unknown_count,
                min(CASE WHEN known THEN snapshot_date END) AS earliest_auditable_date
         FROM (SELECT *, fetched_at_utc IS NOT NULL OR api_timestamp_ms IS NOT NULL AS known FROM captures)""",
)
def provenance_coverage(spark, root):
    return provenance.provenance_coverage(panels.captures(spark, root))


# ---------------------------------------------------------------- quotas and audit

CALLS = """WITH calls AS (
  SELECT 'req-' || user_id AS request_id, CASE WHEN event_type = 'click' THEN 'thorough' ELSE 'fast' END AS profile,
         ts, event_id AS call_id, CASE WHEN event_type = 'view' THEN 'sample_rows' ELSE 'execute_query' END AS tool,
         CASE WHEN event_type = 'error' THEN 'error' ELSE 'success' END AS outcome,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_type, "value" FROM events),
owned AS (
  SELECT *, first_value(profile) OVER (PARTITION BY request_id ORDER BY ts, call_id) AS first_profile FROM calls),
admitted AS (
  SELECT request_id, profile, call_id, row_number() OVER (PARTITION BY request_id ORDER BY ts, call_id) AS used,
         CASE WHEN profile = 'fast' THEN 3 ELSE 10 END AS call_limit
  FROM owned WHERE profile = first_profile QUALIFY used <= call_limit)
"""


@query(
    "quota_admission",
    CALLS
    + """SELECT request_id, profile, call_id, CAST(used AS INTEGER) AS used, call_limit,
                CAST(call_limit - used AS INTEGER) AS remaining FROM admitted""",
)
def quota_admission(spark, root):
    log = panels.call_log(spark, root).select("request_id", "profile", "ts", "call_id")
    return governance.admitted_calls(log).drop("ts")


@query(
    "quota_usage",
    CALLS
    + """SELECT request_id, count(*) AS call_count, max(coalesce(n, 0)) AS admitted_count,
                count(*) - max(coalesce(n, 0)) AS refused_count
         FROM calls LEFT JOIN (SELECT request_id, count(*) AS n FROM admitted GROUP BY 1) USING (request_id) GROUP BY 1""",
)
def quota_usage(spark, root):
    return governance.quota_usage(panels.call_log(spark, root).select("request_id", "profile", "ts", "call_id"))


@query(
    "audit_rollup",
    CALLS
    + """SELECT tool, outcome, CASE WHEN event_type = 'error' THEN
                  CASE WHEN k < 50 THEN 'ENGINE_ERROR' ELSE 'PARSE_ERROR' END END AS failure_code,
                count(*) AS attempts, CAST(sum(k) AS BIGINT) AS rows_read, CAST(sum(k * 1024) AS BIGINT) AS bytes_read,
                CAST(max(floor("value" * 10)) AS BIGINT) AS max_elapsed_ms FROM calls GROUP BY 1, 2, 3""",
)
def audit_rollup(spark, root):
    return governance.audit_rollup(panels.call_log(spark, root))


# ---------------------------------------------------------------- lineage and drift

EDGES = """edges AS (
  SELECT 'region:' || n_regionkey AS parent, 'nation:' || n_nationkey AS child FROM nation
  UNION ALL SELECT 'nation:' || c_nationkey, 'customer:' || c_custkey FROM customer
  UNION ALL SELECT 'nation:' || s_nationkey, 'supplier:' || s_suppkey FROM supplier
  UNION ALL SELECT 'customer:' || o_custkey, 'order:' || o_orderkey FROM orders
  UNION ALL SELECT 'order:' || l_orderkey, 'part:' || l_partkey FROM lineitem
  UNION ALL SELECT 'supplier:' || l_suppkey, 'part:' || l_partkey FROM lineitem)"""


def _reach_sql(start: str, near: str, far: str, depth: int) -> str:
    return f"""WITH RECURSIVE {EDGES}, walk AS (
      SELECT '{start}' AS node, 0 AS distance
      UNION SELECT e.{far}, distance + 1 FROM walk JOIN edges e ON e.{near} = node WHERE distance < {depth})
    SELECT node, CAST(min(distance) AS INTEGER) AS distance FROM walk WHERE node <> '{start}' GROUP BY 1"""


@query("bounded_lineage", _reach_sql("region:1", "parent", "child", 4))
def bounded_lineage(spark, root):
    return reachable(panels.edges(spark, root), "region:1", "downstream", 4)


@query("bounded_lineage_upstream", _reach_sql("part:5", "child", "parent", 5))
def bounded_lineage_upstream(spark, root):
    return reachable(panels.edges(spark, root), "part:5", "upstream", 5)


@query(
    "schema_drift_report",
    """WITH live AS (SELECT 'k' AS field, count(*) AS n FROM events WHERE json_extract_string(props, '$.k') IS NOT NULL
         UNION ALL SELECT lower(event_type), count(*) FROM events GROUP BY 1)
       SELECT field, 'undocumented' AS finding, n AS live_count FROM live WHERE field NOT IN ('k', 'signup', 'view', 'purchase')
       UNION ALL SELECT 'refund', 'stale documentation', 0""",
)
def schema_drift_report(spark, root):
    """Fields really seen in the events (property names and event types) against a documented list."""
    events = panels.table(spark, root, "events")
    properties = F.map_keys(F.from_json("props", "map<string,string>"))
    live = events.select(F.explode(F.concat(properties, F.array("event_type"))).alias("field"))
    names = F.array(*(F.lit(n) for n in ("K", "signup", " view", "purchase", "refund")))
    documented = spark.range(1).select(F.explode(names).alias("field"))
    return governance.field_drift(live, documented)


# ---------------------------------------------------------------- streams


def _landed_events(spark, root) -> str:
    """The events as files by day, the way captures arrive."""
    path = scratch_dir(spark, "events")
    events = panels.table(spark, root, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value",
        F.to_date("ts").alias(DAY),
    )
    write_partitions(events, path)
    return path


@query(
    "stream_incremental_ingest",
    """SELECT event_id, user_id, event_type, value, CAST(ts AS DATE) AS snapshot_date FROM events""",
)
def stream_incremental_ingest(spark, root):
    """Files by day taken by a stream, run twice: the second run finds nothing new."""
    landed, sink, checkpoint = _landed_events(spark, root), scratch_dir(spark, "sink"), scratch_dir(spark, "ckpt")
    schema = spark.read.parquet(landed).schema
    for _ in range(2):
        landing.ingest(landing.read_stream(spark, landed, schema), sink, checkpoint)
    return spark.read.parquet(sink).select("event_id", "user_id", "event_type", "value", DAY)


@query(
    "stream_compacted_days",
    """SELECT CAST(ts AS DATE) AS snapshot_date, count(*) AS row_count, count(*) FILTER (WHERE event_type = 'error') AS errors,
              sum(event_id) AS id_sum, CAST(CASE WHEN day(CAST(ts AS DATE)) <= 10 THEN 2 ELSE 1 END AS BIGINT) AS batches
       FROM events GROUP BY 1""",
)
def stream_compacted_days(spark, root):
    """Three micro-batches per day are compacted; rows of ten days that arrive later are taken once and lie beside them."""
    arrived, sink, checkpoint = scratch_dir(spark, "arriving"), scratch_dir(spark, "batches"), scratch_dir(spark, "ckpt")
    events = spark.read.parquet(_landed_events(spark, root))
    third = F.pmod("event_id", F.lit(3))
    later = (third == 2) & (F.dayofmonth(DAY) <= 10)
    arrivals = [(third == 0), (third == 1), (third == 2) & ~later, later]
    for number, arrival in enumerate(arrivals):
        events.where(arrival).write.mode("append").parquet(arrived)
        landing.ingest(landing.read_stream(spark, arrived, events.schema), sink, checkpoint)
        if number == 2:
            compaction.compact(spark, sink, checkpoint, events.schema, max_batches=1)
    return spark.read.parquet(sink).groupBy(DAY).agg(
        F.count("*").alias("row_count"), F.count_if(F.col("event_type") == "error").alias("errors"),
        F.sum("event_id").alias("id_sum"), F.count_distinct(landing.BATCH).alias("batches"),
    )


@query(
    "stream_late_capture",
    CAPTURES
    + """SELECT event_id, snapshot_date, coalesce(lag_hours < 0 OR lag_hours > 36, FALSE) AS quarantined FROM lagged""",
)
def stream_late_capture(spark, root):
    landed = scratch_dir(spark, "captures")
    write_partitions(panels.captures(spark, root), landed)
    schema = spark.read.parquet(landed).schema
    on_time, late, checkpoint = (scratch_dir(spark, n) for n in ("ontime", "late", "ckpt"))
    landing.route_late(landing.read_stream(spark, landed, schema), on_time, late, checkpoint)
    return (
        spark.read.parquet(on_time).select("event_id", DAY, F.lit(False).alias("quarantined"))
        .unionByName(spark.read.parquet(late).select("event_id", DAY, F.lit(True).alias("quarantined")))
    )


@query(
    "stream_daily_panel",
    """SELECT CAST(ts AS DATE) AS snapshot_date, user_id, count(*) AS event_count, max(value) AS price_usd,
              CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS market_cap_usd
       FROM events GROUP BY 1, 2
       HAVING CAST(CAST(ts AS DATE) + 1 AS TIMESTAMP) <= (SELECT max(ts) - INTERVAL 1 DAY FROM events)""",
)
def stream_daily_panel(spark, root):
    """Days closed by the watermark; the newest days stay open in the state."""
    landed, sink, checkpoint = _landed_events(spark, root), scratch_dir(spark, "panel"), scratch_dir(spark, "ckpt")
    stream = landing.read_stream(spark, landed, spark.read.parquet(landed).schema)
    # Values have two decimals: as decimals their sums do not depend on the order of the rows.
    stream = stream.withColumn("value", F.col("value").cast("decimal(18,2)"))
    panel = landing.daily_panel(stream, "ts", "user_id", "value")
    landing.write_daily_panel(panel, sink, checkpoint, spark.sparkContext.defaultParallelism)
    return spark.read.parquet(sink).withColumn("price_usd", F.col("price_usd").cast("double"))


@query(
    "stream_late_events",
    """SELECT CAST(ts AS DATE) AS snapshot_date, user_id, count(*) AS event_count,
              CAST(count(*) FILTER (WHERE day(CAST(ts AS DATE)) <= 10) AS BIGINT) AS late_event_count, max(value) AS price_usd,
              CAST(sum(CAST(value AS DECIMAL(18,2))) AS DOUBLE) AS market_cap_usd
       FROM events GROUP BY 1, 2""",
)
def stream_late_events(spark, root):
    """The first ten days of the month arrive when they are closed; they are counted, and their days are whole."""
    landed = _landed_events(spark, root)
    schema = spark.read.parquet(landed).schema
    arrived, sink, checkpoint = scratch_dir(spark, "arrived"), scratch_dir(spark, "partials"), scratch_dir(spark, "ckpt")
    for late in (False, True):
        spark.read.parquet(landed).where((F.dayofmonth(DAY) <= 10) == F.lit(late)).write.mode("append").parquet(arrived)
        stream = landing.read_stream(spark, arrived, schema).withColumn("value", F.col("value").cast("decimal(18,2)"))
        landing.accumulate_panel(stream, "ts", "user_id", "value", sink, checkpoint)
    return landing.accumulated_panel(spark, sink, "user_id").withColumn("price_usd", F.col("price_usd").cast("double"))


@query("lineage_closure_downstream", _reach_sql("region:1", "parent", "child", 50))
def lineage_closure_downstream(spark, root):
    """Everything below one region, without a depth."""
    return closure(panels.edges(spark, root), "region:1", "downstream")[0]


@query("lineage_closure_upstream", _reach_sql("part:5", "child", "parent", 50))
def lineage_closure_upstream(spark, root):
    return closure(panels.edges(spark, root), "part:5", "upstream")[0]
