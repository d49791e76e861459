"""Copies of landed files, byte for byte, made by the executors.

Rows are not decoded: a file arrives with the bytes it was captured with. Spark lists both sides and decides per file; the
tasks stream files in pieces through ``pyarrow.fs`` (local, HDFS, S3 and GCS paths), under a name readers skip, read the copy
back, and rename it into place only when its digest is that of the source. A task that is repeated finds the files it had
finished and leaves them.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from datetime import date

import pandas as pd
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daygrid.functions.text import date_from_path
from daygrid.schemas import DAY
from daygrid.sinks.partitions import staged
from daygrid.sources.inventory import list_files

PIECE = 8 << 20
#: Bytes one task is meant to copy; a larger file is a task of its own.
TASK_BYTES = 1 << 30
REPORT = "path string, action string, length long, sha256 string"


def _place(root: str) -> tuple[arrow_fs.FileSystem, str]:
    """File system and folder of a path or URI."""
    if root.startswith("file:"):
        root = "/" + root.removeprefix("file:").lstrip("/")
    if root.startswith("/"):
        return arrow_fs.LocalFileSystem(), root.rstrip("/")
    files, base = arrow_fs.FileSystem.from_uri(root)
    return files, base.rstrip("/")


def _digest(files: arrow_fs.FileSystem, path: str) -> tuple[int, str]:
    seen, digest = 0, hashlib.sha256()
    with files.open_input_stream(path) as source:
        while piece := source.read(PIECE):
            seen += len(piece)
            digest.update(piece)
    return seen, digest.hexdigest()


def _copy(source: arrow_fs.FileSystem, origin: str, target: arrow_fs.FileSystem, place: str) -> tuple[int, str]:
    """Length and digest of the source, whose bytes are at ``place`` when this returns."""
    folder, name = place.rsplit("/", 1)
    waiting = f"{folder}/_copying-{uuid.uuid4().hex}-{name}"
    target.create_dir(folder, recursive=True)
    seen, digest = 0, hashlib.sha256()
    with source.open_input_stream(origin) as reader, target.open_output_stream(waiting) as writer:
        while piece := reader.read(PIECE):
            seen += len(piece)
            digest.update(piece)
            writer.write(piece)
    found = (seen, digest.hexdigest())
    if _digest(target, waiting) != found:
        target.delete_file(waiting)
        raise OSError(f"{origin}: the copy has other bytes than the source")
    target.move(waiting, place)
    return found


def relative_files(spark: SparkSession, root: str) -> DataFrame:
    """(path below ``root``, length, day of the dated layout) of the files readers see; none where there is no folder.

    Spark's listing leaves out files without a byte, so these are neither copied nor removed; an empty file at the target
    in place of a longer one counts as absent there.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(root)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], f"path string, length long, {DAY} date")
    # The root as a path, without scheme and authority, as it stands within every listed path.
    inner = folder.toUri().getPath().rstrip("/") + "/"
    path = F.expr("path").substr(F.locate(inner, F.col("path")) + F.lit(len(inner)), F.length("path"))
    listed = list_files(spark, root).select(path.alias("path"), "length")
    return listed.withColumn(DAY, date_from_path(F.concat(F.lit("/"), F.col("path"))))


def file_plan(
    source: DataFrame, target: DataFrame, start: date | None = None, end: date | None = None, overwrite: bool = False
) -> DataFrame:
    """What each file needs: ``copy`` (not at the target), ``repair`` (another length there, so the copy is torn),
    ``compare`` (same length; only with ``overwrite``, which goes by the bytes) or ``remove`` (only with ``overwrite``:
    at the target alone, on a day the source has). Files outside the dated layout or the bounds are left alone. A day that
    holds files the source does not have was not copied from it: without ``overwrite`` it stays as it is.
    """
    theirs = target.select("path", F.col("length").alias("_there"), F.col(DAY).alias("_day"))
    both = source.join(theirs, "path", "full_outer").withColumn(DAY, F.coalesce(DAY, "_day"))
    both = both.where(F.col(DAY).isNotNull())
    if start is not None:
        both = both.where(F.col(DAY) >= F.lit(start))
    if end is not None:
        both = both.where(F.col(DAY) <= F.lit(end))
    action = (
        F.when(F.col("length").isNull(), "remove")
        .when(F.col("_there").isNull(), "copy")
        .when(F.col("length") != F.col("_there"), "repair")
        .otherwise("compare")
    )
    plan = both.select("path", DAY, F.coalesce("length", "_there").alias("length"), action.alias("action"))
    if not overwrite:
        foreign = plan.where("action = 'remove'").select(DAY).distinct()
        return plan.where(F.col("action").isin("copy", "repair")).join(foreign, DAY, "left_anti")
    captured = source.select(DAY).distinct()
    return plan.join(captured, DAY, "left_semi")


def copy_files(plan: DataFrame, source_root: str, target_root: str) -> DataFrame:
    """Carry out a file plan and return what was done: path, action, length, sha256.

    Actions: ``copied``, ``repaired``, ``kept`` (compared, same bytes) and ``removed`` (without digest). Stale files go only
    after every copy is in place, so a reader of an overwritten day may see both for a moment, but never less.
    """
    work = staged(plan.select("path", "length", "action"), "file-plan")
    size = work.agg(F.sum("length"), F.count(F.lit(1))).first()
    tasks = max(1, min(size[1], -(-(size[0] or 0) // TASK_BYTES) + work.sparkSession.sparkContext.defaultParallelism))

    def carry(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        source, origin = _place(source_root)
        target, place = _place(target_root)
        for batch in batches:
            done = []
            for path, action in zip(batch["path"], batch["action"], strict=True):
                here, there = f"{origin}/{path}", f"{place}/{path}"
                if target.get_file_info(there).type == arrow_fs.FileType.File:
                    length, digest = _digest(source, here)
                    if _digest(target, there) == (length, digest):
                        done.append((path, "copied" if action == "copy" else "kept", length, digest))
                        continue
                length, digest = _copy(source, here, target, there)
                done.append((path, "copied" if action == "copy" else "repaired", length, digest))
            yield pd.DataFrame(done, columns=["path", "action", "length", "sha256"])

    def remove(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        target, place = _place(target_root)
        for batch in batches:
            for path in batch["path"]:
                if target.get_file_info(f"{place}/{path}").type == arrow_fs.FileType.File:
                    target.delete_file(f"{place}/{path}")
            yield batch.assign(action="removed", sha256=None)[["path", "action", "length", "sha256"]]

    put = work.where("action <> 'remove'").repartition(tasks, "path").mapInPandas(carry, REPORT)
    report = staged(put, "files-copied")
    gone = staged(work.where("action = 'remove'").mapInPandas(remove, REPORT), "files-removed")
    return report.unionByName(gone)


def sync_files(
    spark: SparkSession, source_root: str, target_root: str,
    start: date | None = None, end: date | None = None, overwrite: bool = False,
) -> DataFrame:
    """Bring the files of captured days to ``target_root``: absent and torn ones, or with ``overwrite`` all that differ."""
    plan = file_plan(relative_files(spark, source_root), relative_files(spark, target_root), start, end, overwrite)
    return copy_files(plan, source_root, target_root)
