"""Writes to Parquet: partition overwrite, append, keyed merge, versioned dimension.

Parquet has no MERGE. A merge into a partitioned table reads only the partitions its source
touches, upserts by key and overwrites those partitions; files are replaced when the job
commits, so lost executors only repeat tasks.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from daygrid.operators.dedup import unique_or_fail
from daygrid.operators.upsert import upsert
from daygrid.schemas import DAY
from daygrid.session import scratch_dir
from daygrid.sinks.contract import write_checked
from daygrid.sources.snapshots import history_folder

#: Complete versions of an unpartitioned table that stay.
KEEP_VERSIONS = 3


def _placed(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """Group rows by partition value, splitting large values and merging small ones (AQE)."""
    return df.hint("rebalance", *by)


def write_partitions(df: DataFrame, path: str, by: Sequence[str] = (DAY,)) -> None:
    """Replace exactly the partitions present in ``df``; an empty frame replaces nothing."""
    (
        _placed(df, by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(*by)
        .parquet(path)
    )


def append_partitions(df: DataFrame, path: str, by: Sequence[str] = (DAY,)) -> None:
    _placed(df, by).write.mode("append").option("compression", "snappy").partitionBy(*by).parquet(path)


def replace_table(df: DataFrame, path: str) -> None:
    """Full refresh. ``df`` must not read ``path``."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)


def write_snapshots(records: DataFrame, root: str, day: str = DAY) -> None:
    """Land records in the dated folder layout, replacing the days present."""
    dated = records.select(
        *(c for c in records.columns if c != day),
        F.date_format(day, "yyyy").alias("year"),
        F.date_format(day, "MM").alias("month"),
        F.date_format(day, "dd").alias("day"),
    )
    write_partitions(dated, root, ("year", "month", "day"))


def table_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def staged(df: DataFrame, name: str) -> DataFrame:
    """Written once to the shared scratch folder and read back, for frames that several jobs read."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def merge_partitions(
    path: str, source: DataFrame, keys: Sequence[str], by: str = DAY, schema: StructType | None = None
) -> None:
    """Upsert ``source`` into the table at ``path``, rewriting only the partitions it touches.

    ``source`` is computed once: its rows are staged before they are checked and merged. With ``schema`` the merged
    rows are written only if they meet it.
    """

    def put(rows: DataFrame) -> None:
        if schema is None:
            write_partitions(rows, path, (by,))
        else:
            write_checked(rows, path, schema, (by,))

    source = staged(source, "merge-source")
    unique_or_fail(source, keys)
    target = table_or_none(source.sparkSession, path)
    if target is None:
        put(source)
        return
    touched = target.join(source.select(by).distinct(), by, "left_semi")
    put(upsert(touched, source, keys))


def _versions(spark: SparkSession, path: str) -> tuple[list[int], list[int]]:
    """Numbers of the complete versions and of all version folders, from folder names only."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return [], []
    paths = [status.getPath() for status in files.listStatus(folder)]
    numbers = {int(p.getName().removeprefix("version=")): p for p in paths if p.getName().startswith("version=")}
    done = [n for n, p in numbers.items() if files.exists(spark._jvm.org.apache.hadoop.fs.Path(p, "_SUCCESS"))]
    return sorted(done), sorted(numbers)


def read_version(spark: SparkSession, path: str) -> DataFrame | None:
    """Newest complete version of an unpartitioned table, or None. Older versions are not opened."""
    done, _ = _versions(spark, path)
    return spark.read.parquet(f"{path}/version={done[-1]}") if done else None


def upsert_version(path: str, source: DataFrame, keys: Sequence[str], keep: int = KEEP_VERSIONS) -> None:
    """Upsert into an unpartitioned table by writing its next version next to the old ones.

    The current version is never touched, so a load that fails leaves it as it was. Two writers cannot
    take the same number: the second fails. The last ``keep`` complete versions stay, for readers
    that still use them; older ones are deleted.
    """
    spark = source.sparkSession
    source = staged(source, "version-source")
    unique_or_fail(source, keys)
    current = read_version(spark, path)
    done, taken = _versions(spark, path)
    merged = source if current is None else upsert(current, source, keys)
    merged.write.mode("errorifexists").parquet(f"{path}/version={max(taken, default=0) + 1}")
    for number in done[: max(0, len(done) + 1 - keep)]:
        old = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/version={number}")
        old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)


def drop_stored_column(spark: SparkSession, path: str, name: str) -> bool:
    """Write the next version of a table without a column; False where it has no such column."""
    current = read_version(spark, path)
    if current is None or name not in current.columns:
        return False
    _, taken = _versions(spark, path)
    current.drop(name).write.mode("errorifexists").parquet(f"{path}/version={taken[-1] + 1}")
    return True


def copy_days(plan: DataFrame, captured: DataFrame, root: str) -> None:
    """Carry out a sync plan: the captured rows of its days replace those days in the dated layout."""
    write_snapshots(captured.join(plan.select(DAY).distinct(), DAY, "left_semi"), root)


def write_history(records: DataFrame, root: str, anchor: date, days: int, dataset: str) -> None:
    """Land accepted history records where ``read_history`` looks for them, replacing an earlier landing."""
    replace_table(records, f"{root}/{history_folder(anchor, days, dataset)}")
