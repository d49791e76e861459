"""Fewer files per day in a table partitioned by day and micro-batch.

Every micro-batch leaves a folder in each day it touches. Compaction writes the rows of a day's finished batches once more,
as one folder that bears the number of the newest of them, and swaps it in. Batches that the checkpoint has committed are
never repeated, so only they are taken: a batch that runs again still overwrites its own folder, and no row comes twice.

The rewritten rows wait in a folder readers skip. They are complete once they bear a mark; from then on each day's  (old folders go, the new one is renamed into place) can be repeated until it is through, by the same call or, after a
failure, by the next. In the middle of its swap a day can be seen without rows: plain Parquet has no transactions.
One compaction of a table may run at a time, besides its stream.
"""

from __future__ import annotations

import uuid
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daygrid.schemas import DAY
from daygrid.streaming.landing import BATCH

#: Rewritten rows that wait for their swap; readers skip names with an underscore.
WAITING = "_compaction"
#: Mark of a waiting folder whose rows are complete.
COMPLETE = "_complete"
#: Folders a day may have before it is rewritten.
MAX_BATCHES = 8


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _names(spark: SparkSession, path: str) -> list[str]:
    files, folder = _folder(spark, path)
    return [s.getPath().getName() for s in files.listStatus(folder)] if files.exists(folder) else []


def committed_batch(spark: SparkSession, checkpoint: str) -> int | None:
    """The newest batch the checkpoint of a stream records as done; None before the first."""
    done = [int(name) for name in _names(spark, f"{checkpoint}/commits") if name.isdigit()]
    return max(done, default=None)


def batches_by_day(spark: SparkSession, sink: str, by: str = DAY) -> dict[date, list[int]]:
    """Batch folders of each day, ascending, from folder names. As many as the calendar has days, times batches not compacted."""
    found = {}
    for name in _names(spark, sink):
        if name.startswith(f"{by}=") and not name.endswith("__"):
            inner = _names(spark, f"{sink}/{name}")
            numbers = [int(n.removeprefix(f"{BATCH}=")) for n in inner if n.startswith(f"{BATCH}=")]
            found[date.fromisoformat(name.removeprefix(f"{by}="))] = sorted(numbers)
    return found


def _delete(spark: SparkSession, path: str) -> None:
    files, folder = _folder(spark, path)
    files.delete(folder, True)


def _swap(spark: SparkSession, sink: str, waiting: str, by: str) -> None:
    """Put every rewritten day that still waits in the place of the folders it was made from."""
    for name in _names(spark, waiting):
        if not name.startswith(f"{by}="):
            continue
        for folder in _names(spark, f"{waiting}/{name}"):
            upto = int(folder.removeprefix(f"{BATCH}="))
            for old in _names(spark, f"{sink}/{name}"):
                if old.startswith(f"{BATCH}=") and int(old.removeprefix(f"{BATCH}=")) <= upto:
                    _delete(spark, f"{sink}/{name}/{old}")
            files, source = _folder(spark, f"{waiting}/{name}/{folder}")
            _, target = _folder(spark, f"{sink}/{name}/{folder}")
            if not files.rename(source, target):
                raise OSError(f"{source} could not be moved to {target}")
    _delete(spark, waiting)


def finish_swaps(spark: SparkSession, sink: str, by: str = DAY) -> int:
    """Carry through swaps that an earlier run left; rewritten rows that never became complete are dropped. Number finished."""
    finished = 0
    for name in sorted(_names(spark, f"{sink}/{WAITING}")):
        waiting = f"{sink}/{WAITING}/{name}"
        if COMPLETE in _names(spark, waiting):
            _swap(spark, sink, waiting, by)
            finished += 1
        else:
            _delete(spark, waiting)
    return finished


def rewrite(spark: SparkSession, sink: str, wanted: dict[date, int], schema: T.StructType, by: str = DAY) -> str:
    """Write the rows of each day's batches up to the given one to a waiting folder; the table is not touched."""
    waiting = f"{sink}/{WAITING}/{uuid.uuid4().hex}"
    upto = spark.createDataFrame(list(wanted.items()), f"{by} date, _upto int")
    # Literal days prune the folders that are listed; the join, small by the calendar, tells the batches of each.
    rows: DataFrame = spark.read.schema(schema).parquet(sink).where(F.col(by).isin(list(wanted)))
    taken = rows.join(F.broadcast(upto), by).where(F.col(BATCH) <= F.col("_upto"))
    merged = taken.withColumn(BATCH, F.col("_upto")).drop("_upto").hint("rebalance", by)
    merged.write.mode("errorifexists").option("compression", "snappy").partitionBy(by, BATCH).parquet(waiting)
    files, mark = _folder(spark, f"{waiting}/{COMPLETE}")
    files.create(mark).close()
    return waiting


def compact(
    spark: SparkSession, sink: str, checkpoint: str, schema: T.StructType, max_batches: int = MAX_BATCHES, by: str = DAY
) -> list[date]:
    """Rewrite the days that have more than ``max_batches`` folders of committed batches; the days, ascending.

    ``schema`` is that of the rows without the batch number. Afterwards such a day has one folder for these batches, whose
    number is the newest of them, and files of the size Spark's rebalancing aims at. Days with fewer folders are not read,
    and rows without a day stay as they are.
    """
    if max_batches < 1:
        raise ValueError("max_batches must be at least 1")
    finish_swaps(spark, sink, by)
    last = committed_batch(spark, checkpoint)
    if last is None:
        return []
    ready = {day: [n for n in numbers if n <= last] for day, numbers in batches_by_day(spark, sink, by).items()}
    wanted = {day: numbers[-1] for day, numbers in sorted(ready.items()) if len(numbers) > max_batches}
    if wanted:
        fields = [f for f in schema.fields if f.name != BATCH]
        stored = T.StructType([*fields, T.StructField(BATCH, T.IntegerType())])
        _swap(spark, sink, rewrite(spark, sink, wanted, stored, by), by)
    return list(wanted)
