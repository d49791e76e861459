"""The given tables as panels, dimensions and raw inputs.

N: nation by order day (sparse). E: user by event day (dense). S: supplier by ship day (large).
Prices and caps have two decimals; sums are taken over decimals so that every engine agrees.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrid.schemas import DAY, ENTITY


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def money(column: str) -> Column:
    return F.col(column).cast("decimal(18,2)")


def _panel(rows: DataFrame, prefix: str, number: str, value: str, flagged: Column) -> DataFrame:
    """Price is the largest value of the day, cap the sum, volume the sum of flagged rows.

    Rows are grouped by the entity number; the id text is built once per panel row.
    """
    volume = F.sum(F.when(flagged, money(value))).cast("double")
    days = rows.groupBy(number, DAY).agg(
        F.max(value).alias("price_usd"),
        F.sum(money(value)).cast("double").alias("market_cap_usd"),
        volume.alias("volume_usd_24hr"),
        (volume / F.count_if(flagged)).alias("vwap_24hr"),
    )
    return days.select(
        F.concat(F.lit(prefix), number).alias(ENTITY),
        DAY,
        "price_usd",
        "market_cap_usd",
        "volume_usd_24hr",
        F.lit(None).cast("double").alias("change_percent_24hr"),
        "vwap_24hr",
    )


def order_rows(spark: SparkSession, root: str) -> DataFrame:
    """Orders with the nation of their customer."""
    customers = table(spark, root, "customer").select("c_custkey", "c_nationkey")
    orders = table(spark, root, "orders")
    return orders.join(customers, orders.o_custkey == customers.c_custkey).select(
        "c_nationkey", F.to_date("o_orderdate").alias(DAY), "o_totalprice", "o_orderstatus", "o_orderpriority"
    )


def nation_panel(spark: SparkSession, root: str) -> DataFrame:
    rows = order_rows(spark, root)
    return _panel(rows, "nation_", "c_nationkey", "o_totalprice", F.col("o_orderstatus") == "F")


def urgent_panel(spark: SparkSession, root: str, urgent: bool) -> DataFrame:
    """The nation panel from urgent orders only, or from all the others."""
    is_urgent = F.col("o_orderpriority") == "1-URGENT"
    rows = order_rows(spark, root).where(is_urgent if urgent else ~is_urgent)
    return _panel(rows, "nation_", "c_nationkey", "o_totalprice", F.col("o_orderstatus") == "F")


def nation_dim(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "nation").select(
        F.concat(F.lit("nation_"), "n_nationkey").alias("id"),
        F.substring("n_name", 1, 3).alias("symbol"),
        F.col("n_name").alias("name"),
    )


def user_panel(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, "events").select("user_id", F.to_date("ts").alias(DAY), "value", "event_type")
    return _panel(rows, "user_", "user_id", "value", F.col("event_type") == "purchase")


def user_dim(spark: SparkSession, root: str) -> DataFrame:
    """Users that share a number with a supplier; the others have no dimension row."""
    return table(spark, root, "supplier").select(
        F.concat(F.lit("user_"), "s_suppkey").alias("id"),
        F.concat(F.lit("U"), "s_suppkey").alias("symbol"),
        F.col("s_name").alias("name"),
    )


def supplier_panel(spark: SparkSession, root: str) -> DataFrame:
    rows = table(spark, root, "lineitem").select(
        "l_suppkey", F.to_date("l_shipdate").alias(DAY), "l_extendedprice", "l_returnflag"
    )
    return _panel(rows, "supplier_", "l_suppkey", "l_extendedprice", F.col("l_returnflag") == "R")


def supplier_dim(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "supplier").select(
        F.concat(F.lit("supplier_"), "s_suppkey").alias("id"),
        F.concat(F.lit("S"), "s_suppkey").alias("symbol"),
        F.col("s_name").alias("name"),
    )


def latest_day(df: DataFrame, at_or_before: date) -> date:
    """Newest day of ``df`` up to a date (one value), else its first day."""
    row = df.agg(
        F.max(F.when(F.col(DAY) <= F.lit(at_or_before), F.col(DAY))).alias("at"), F.min(DAY).alias("first")
    ).first()
    return row["at"] or row["first"]


def order_days(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "orders").select(F.to_date("o_orderdate").alias(DAY))


def event_days(spark: SparkSession, root: str) -> DataFrame:
    return table(spark, root, "events").select(F.to_date("ts").alias(DAY))


def nation_end(spark: SparkSession, root: str) -> date:
    """Three days after the last order: the end of the availability calendar."""
    return order_days(spark, root).agg(F.date_add(F.max(DAY), 3)).first()[0]


def raw_snapshots(spark: SparkSession, root: str) -> DataFrame:
    """The user panel as landed string rows with bad numbers among them."""
    panel = user_panel(spark, root)
    dim = user_dim(spark, root)
    named = panel.join(dim, panel[ENTITY] == dim.id, "left")
    price = (
        F.when(F.col("price_usd") < 5, F.lit("not-a-number"))
        .when(F.col("price_usd") < 10, F.lit(""))
        .otherwise(F.col("price_usd").cast("string"))
    )
    return named.select(
        F.col(ENTITY).alias("id"),
        F.lit("0").alias("rank"),
        F.coalesce("symbol", F.upper(ENTITY)).alias("symbol"),
        F.coalesce("name", F.col(ENTITY)).alias("name"),
        F.dayofmonth(DAY).cast("string").alias("supply"),
        F.when(F.dayofmonth(DAY) > 15, F.lit("31.0")).alias("maxSupply"),
        F.col("market_cap_usd").cast("string").alias("marketCapUsd"),
        F.coalesce(F.col("volume_usd_24hr").cast("string"), F.lit("n/a")).alias("volumeUsd24Hr"),
        price.alias("priceUsd"),
        F.lit("1e-1").alias("changePercent24Hr"),
        F.col("vwap_24hr").cast("string").alias("vwap24Hr"),
        F.lit(None).cast("string").alias("explorer"),
        F.unix_millis(F.col(DAY).cast("timestamp")).alias("api_timestamp_ms"),
        F.col(DAY).cast("timestamp").alias("fetched_at_utc"),
        DAY,
    )


def raw_user_history(spark: SparkSession, root: str) -> DataFrame:
    """Events as raw history points: several per user and day, the ISO date missing on views."""
    ms = F.unix_millis(F.col("ts").cast("timestamp"))
    return table(spark, root, "events").select(
        F.concat(F.lit("user_"), "user_id").alias(ENTITY),
        ms.alias("time"),
        F.when(F.col("event_type") != "view", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")).alias("date"),
        F.col("value").cast("string").alias("priceUsd"),
        F.when(F.col("event_type") == "purchase", F.col("value").cast("string")).alias("volumeUsd24Hr"),
    )


def raw_nation_caps(spark: SparkSession, root: str) -> DataFrame:
    """Orders as raw market-cap points with a date and no time."""
    rows = order_rows(spark, root)
    return rows.select(
        F.concat(F.lit("nation_"), "c_nationkey").alias(ENTITY),
        F.date_format(DAY, "yyyy-MM-dd").alias("date"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice").cast("string")).alias("marketcapUsd"),
        F.when(F.col("o_orderstatus") == "P", F.col("o_totalprice").cast("string")).alias("marketCap"),
    )


def captures(spark: SparkSession, root: str) -> DataFrame:
    """Every event as one landed file: label, response time and fetch time; errors carry neither."""
    known = F.col("event_type") != "error"
    hours = F.pmod(F.col("event_id"), F.lit(5)).cast("int") * 12
    fetched = F.timestamp_millis(F.unix_millis(F.col("ts").cast("timestamp")) + hours * 3_600_000)
    return table(spark, root, "events").select(
        "event_id",
        F.to_date("ts").alias(DAY),
        F.when(known, F.floor(F.col("event_id") / F.lit(2))).alias("api_timestamp_ms"),
        F.when(known, fetched).alias("fetched_at_utc"),
    )


def call_log(spark: SparkSession, root: str) -> DataFrame:
    """Events as a log of engine calls: the user is the request, clicks ask for the long profile."""
    event = F.col("event_type")
    k = F.get_json_object("props", "$.k").cast("long")
    return table(spark, root, "events").select(
        F.concat(F.lit("req-"), "user_id").alias("request_id"),
        F.when(event == "click", F.lit("thorough")).otherwise(F.lit("fast")).alias("profile"),
        F.col("ts"),
        F.col("event_id").alias("call_id"),
        F.when(event == "view", F.lit("sample_rows")).otherwise(F.lit("execute_query")).alias("tool"),
        F.when(event == "error", F.lit("error")).otherwise(F.lit("success")).alias("outcome"),
        F.when(event == "error", F.when(k < 50, F.lit("ENGINE_ERROR")).otherwise(F.lit("PARSE_ERROR"))).alias(
            "failure_code"
        ),
        k.alias("rows_read"),
        (k * 1024).alias("bytes_read"),
        F.floor(F.col("value") * 10).alias("elapsed_ms"),
    )


def edges(spark: SparkSession, root: str) -> DataFrame:
    """Parent to child: region, nation, customer and supplier, order, part."""

    def pairs(name: str, parent: str, parent_key: str, child: str, child_key: str) -> DataFrame:
        return table(spark, root, name).select(
            F.concat(F.lit(f"{parent}:"), parent_key).alias("parent"),
            F.concat(F.lit(f"{child}:"), child_key).alias("child"),
        )

    return (
        pairs("nation", "region", "n_regionkey", "nation", "n_nationkey")
        .unionByName(pairs("customer", "nation", "c_nationkey", "customer", "c_custkey"))
        .unionByName(pairs("supplier", "nation", "s_nationkey", "supplier", "s_suppkey"))
        .unionByName(pairs("orders", "customer", "o_custkey", "order", "o_orderkey"))
        .unionByName(pairs("lineitem", "order", "l_orderkey", "part", "l_partkey"))
        .unionByName(pairs("lineitem", "supplier", "l_suppkey", "part", "l_partkey"))
    )
