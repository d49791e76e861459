"""What a table partitioned by day holds, from its folder names and file footers.

No data page is read. Folder names say which days may be there; a folder may still hold no row, so presence is taken
from the row counts in Parquet footers: a V2 scan with the aggregate pushed down opens only the files of the days asked
for. Days are as many as the calendar has, so they may pass through the driver.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daygrid.schemas import DAY

_FOOTERS = {"spark.sql.sources.useV1SourceList": "", "spark.sql.parquet.aggregatePushdown": "true"}


def folder_days(spark: SparkSession, path: str, by: str = DAY) -> list[date]:
    """Days that have a folder, ascending; none where there is no table. Files are not opened."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    names = [status.getPath().getName() for status in files.listStatus(folder) if status.isDirectory()]
    texts = [name.removeprefix(f"{by}=") for name in names if name.startswith(f"{by}=")]
    return sorted(date.fromisoformat(text) for text in texts if not text.startswith("__"))


def day_frame(spark: SparkSession, days: Iterable[date], by: str = DAY) -> DataFrame:
    return spark.createDataFrame([(day,) for day in days], T.StructType([T.StructField(by, T.DateType())]))


def stored_rows(spark: SparkSession, path: str, days: Iterable[date] | None = None, by: str = DAY) -> DataFrame:
    """(day, row_count) of the days that hold rows, among ``days`` or all, from file footers."""
    there = folder_days(spark, path, by)
    wanted = there if days is None else sorted(set(there) & set(days))
    if not wanted:
        return day_frame(spark, [], by).withColumn("row_count", F.lit(0).cast("long"))
    before = {key: spark.conf.get(key) for key in _FOOTERS}
    try:
        for key, value in _FOOTERS.items():
            spark.conf.set(key, value)
        table = spark.read.parquet(path).withColumn(by, F.col(by).cast("date"))
    finally:
        spark.conf.set("spark.sql.sources.useV1SourceList", before["spark.sql.sources.useV1SourceList"])
    # Pushing the aggregate down is decided when the query runs: the setting stays, other scans are V1 and do not see it.
    some = table if days is None else table.where(F.col(by).isin(wanted))
    return some.groupBy(by).agg(F.count(F.lit(1)).alias("row_count")).where("row_count > 0")


def newest_stored_day(spark: SparkSession, path: str, by: str = DAY) -> date | None:
    """The newest day that holds rows; the footers of older days are opened only while newer folders are empty."""
    for day in reversed(folder_days(spark, path, by)):
        if not stored_rows(spark, path, [day], by).isEmpty():
            return day
    return None


def missing_stored_days(spark: SparkSession, tables: Mapping[str, str], days: Iterable[date], by: str = DAY) -> DataFrame:
    """(table_name, day) of each wanted day on which the table at a path holds no row; only files of these days are opened."""
    days = sorted(set(days))
    wanted = day_frame(spark, days, by)
    absent = [
        wanted.join(stored_rows(spark, path, days, by), by, "left_anti").select(F.lit(name).alias("table_name"), by)
        for name, path in tables.items()
    ]
    return reduce(DataFrame.unionByName, absent)


def require_stored(spark: SparkSession, tables: Mapping[str, str], days: Iterable[date], by: str = DAY) -> None:
    """Raise with every absent (table, day)."""
    absent = missing_stored_days(spark, tables, days, by).orderBy(by, "table_name").collect()
    if absent:
        raise ValueError("no rows: " + ", ".join(f"{row.table_name} on {row[by]}" for row in absent))
