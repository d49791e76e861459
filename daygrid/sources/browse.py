"""Catalog browsing: every helper returns a DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrid.operators import bounded, stats
from daygrid.schemas import DAY


def list_namespaces(spark: SparkSession) -> DataFrame:
    return spark.sql("SHOW NAMESPACES")


def list_tables(spark: SparkSession, namespace: str | None = None) -> DataFrame:
    return spark.sql(f"SHOW TABLES IN {namespace}" if namespace else "SHOW TABLES")


def describe_table(spark: SparkSession, table: str) -> DataFrame:
    return spark.sql(f"DESCRIBE {table}")


def register(df: DataFrame, name: str) -> DataFrame:
    """Make a frame available to SQL under ``name``."""
    df.createOrReplaceTempView(name)
    return df


def query_sql(spark: SparkSession, text: str) -> DataFrame:
    return spark.sql(text)


def preview_table(spark: SparkSession, table: str, n: int = 20) -> DataFrame:
    return spark.table(table).limit(n)


def count_table(spark: SparkSession, table: str) -> DataFrame:
    return stats.count_rows(spark.table(table))


def table_date_range(spark: SparkSession, table: str, day: str = DAY) -> DataFrame:
    return stats.date_range(spark.table(table), day)


def table_null_summary(spark: SparkSession, table: str, columns: list[str] | None = None) -> DataFrame:
    return stats.null_counts(spark.table(table), columns)


def table_distinct_values(spark: SparkSession, table: str, column: str, n: int = 50) -> DataFrame:
    return bounded.distinct_values(spark.table(table), column, n)


def describe_panel(df: DataFrame) -> DataFrame:
    """Columns with type, comment and number of non-NULL values (one pass over the frame)."""
    counted = df.agg(*(F.count(c).alias(c) for c in df.columns))
    rows = [
        F.struct(
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.lit(f.metadata.get("comment")).cast("string").alias("comment"),
            F.col(f.name).alias("value_count"),
        )
        for f in df.schema.fields
    ]
    return counted.select(F.inline(F.array(*rows)))


def table_stats(files: DataFrame) -> DataFrame:
    """Files, rows, bytes and newest modification of a frame read from files.

    Two steps: per file first (map-side combined), then over the file list.
    """
    per_file = (
        files.select(
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_size").alias("file_size"),
            F.col("_metadata.file_modification_time").alias("modified"),
        )
        .groupBy("file_path", "file_size", "modified")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    return per_file.agg(
        F.count(F.lit(1)).alias("file_count"),
        F.coalesce(F.sum("rows"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum("file_size"), F.lit(0)).alias("size_bytes"),
        F.max("modified").alias("last_modified"),
    )


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(table) if c.isPartition]


def newest_files(files: DataFrame, n: int = 10, ceiling: int | None = 100) -> DataFrame:
    """The ``n`` most recently written files, newest first."""
    bounded.require_size(n, "n", ceiling)
    return (
        files.select(
            F.col("_metadata.file_path").alias("file_path"),
            F.col("_metadata.file_modification_time").alias("modified"),
            F.col("_metadata.file_size").alias("file_size"),
        )
        .distinct()
        .orderBy(F.desc("modified"), "file_path")
        .limit(n)
    )
