"""Query quotas, audit rollups and documentation drift as jobs over logs and tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Calls one request may make, by profile, and the form of a request id.
PROFILE_LIMITS = {"fast": 3, "thorough": 10}
REQUEST_ID = r"^[A-Za-z0-9][A-Za-z0-9._:-]{0,127}$"


def admitted_calls(log: DataFrame) -> DataFrame:
    """Calls within the quota of their request, with ``used``, ``call_limit`` and ``remaining``.

    ``log`` has request_id, profile, ts and call_id. The profile of the first valid call counts
    for the whole request; calls under another profile are refused and use nothing.

    Only the first ten calls per (request, profile) can matter. That bound is applied before the
    shuffle, in every map task (Spark pushes ``row_number() <= k`` below the exchange), so a
    request with any share of the log is cut down to a few rows.
    """
    most = max(PROFILE_LIMITS.values())
    order = [F.col("ts"), F.col("call_id")]
    valid = log.where(F.col("request_id").rlike(REQUEST_ID) & F.col("profile").isin(*PROFILE_LIMITS))
    per_profile = Window.partitionBy("request_id", "profile").orderBy(*order)
    heads = valid.withColumn("used", F.row_number().over(per_profile)).where(F.col("used") <= most)

    per_request = Window.partitionBy("request_id").orderBy(*order)
    first_profile = F.first("profile").over(per_request)
    limit = F.lit(None).cast("int")
    for name, n in PROFILE_LIMITS.items():
        limit = F.when(F.col("profile") == name, F.lit(n)).otherwise(limit)
    owned = heads.withColumn("_first", first_profile).where(F.col("profile") == F.col("_first"))
    return (
        owned.withColumn("call_limit", limit)
        .where(F.col("used") <= F.col("call_limit"))
        .withColumn("remaining", F.col("call_limit") - F.col("used"))
        .drop("_first")
    )


def quota_usage(log: DataFrame) -> DataFrame:
    """Calls and admitted calls per request."""
    calls = log.groupBy("request_id").agg(F.count(F.lit(1)).alias("call_count"))
    admitted = admitted_calls(log).groupBy("request_id").agg(F.count(F.lit(1)).alias("admitted_count"))
    return calls.join(admitted, "request_id", "left").select(
        "request_id",
        "call_count",
        F.coalesce("admitted_count", F.lit(0)).alias("admitted_count"),
        (F.col("call_count") - F.coalesce("admitted_count", F.lit(0))).alias("refused_count"),
    )


def audit_rollup(log: DataFrame) -> DataFrame:
    """Attempts per tool, outcome and failure code, with rows, bytes and time."""
    return log.groupBy("tool", "outcome", "failure_code").agg(
        F.count(F.lit(1)).alias("attempts"),
        F.sum("rows_read").alias("rows_read"),
        F.sum("bytes_read").alias("bytes_read"),
        F.max("elapsed_ms").alias("max_elapsed_ms"),
    )


def field_drift(live: DataFrame, documented: DataFrame) -> DataFrame:
    """Names found on one side only. Both frames have ``field``; case is ignored."""
    sides = (
        live.select(F.lower(F.trim("field")).alias("field"), F.lit(1).alias("live"), F.lit(0).alias("doc"))
        .unionByName(
            documented.select(F.lower(F.trim("field")).alias("field"), F.lit(0).alias("live"), F.lit(1).alias("doc"))
        )
        .groupBy("field")
        .agg(F.sum("live").alias("live_count"), F.sum("doc").alias("doc_count"))
    )
    return sides.where((F.col("live_count") == 0) | (F.col("doc_count") == 0)).select(
        "field",
        F.when(F.col("doc_count") == 0, "undocumented").otherwise("stale documentation").alias("finding"),
        "live_count",
    )


def schema_drift(df: DataFrame, documented: DataFrame) -> DataFrame:
    """The same for the columns of a table."""
    names = F.array(*(F.lit(c) for c in df.columns))
    live = df.sparkSession.range(1).select(F.explode(names).alias("field"))
    return field_drift(live, documented)
