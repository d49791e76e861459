"""Writes that refuse rows against a declared schema.

Names and types are compared before anything runs. NULLs in required columns are counted by an ``Observation`` while
the rows are written, to a folder beside the table that readers do not see; no second pass reads them. Only a
write without violations is moved into the table, day by day, by renaming folders.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daygrid.schemas import DAY

VIOLATION = T.StructType([
    T.StructField("column_name", T.StringType()),
    T.StructField("problem", T.StringType()),
    T.StructField("row_count", T.LongType()),
])


class ContractError(ValueError):
    """The rows do not meet the declared schema; ``violations`` holds (column, problem, rows)."""

    def __init__(self, violations: list[tuple]):
        self.violations = violations
        super().__init__("; ".join(f"{c}: {p}" + (f" in {n} rows" if n is not None else "") for c, p, n in violations))


def shape_violations(df: DataFrame, schema: T.StructType) -> list[tuple]:
    """Columns that are missing, not declared, or of another type; (column, problem, None)."""
    have = {f.name: f.dataType for f in df.schema.fields}
    declared = {f.name: f.dataType for f in schema.fields}
    found = [(c, "missing column", None) for c in declared if c not in have]
    found += [(c, "column not declared", None) for c in have if c not in declared]
    return found + [
        (c, f"type {have[c].simpleString()}, declared {t.simpleString()}", None)
        for c, t in declared.items()
        if c in have and have[c] != t
    ]


def _null_counts(df: DataFrame, schema: T.StructType) -> dict[str, Column]:
    return {f.name: F.count_if(F.col(f.name).isNull()) for f in schema.fields if not f.nullable and f.name in df.columns}


def violations(df: DataFrame, schema: T.StructType) -> DataFrame:
    """What a checked write of ``df`` would refuse, without writing: column_name, problem, row_count (NULL for columns)."""
    shape = df.sparkSession.createDataFrame(shape_violations(df, schema), VIOLATION)
    nulls = _null_counts(df, schema)
    if not nulls:
        return shape
    each = [
        F.struct(F.lit(c).alias("column_name"), F.lit("NULL in a required column").alias("problem"), count.alias("row_count"))
        for c, count in nulls.items()
    ]
    counted = df.agg(F.array(*each).alias("_all")).select(F.inline("_all")).where("row_count > 0")
    return shape.unionByName(counted)


def write_checked(df: DataFrame, path: str, schema: T.StructType, by: Sequence[str] = (DAY,)) -> int:
    """Replace the partitions present in ``df``, or raise ``ContractError`` and leave the table as it is.

    Columns may come in any order. Returns the number of rows written; no rows replace nothing. Until the moves
    begin the table is untouched; they only rename folders, one day after the other.
    """
    shape = shape_violations(df, schema)
    if shape:
        raise ContractError(shape)
    spark = df.sparkSession
    nulls = _null_counts(df, schema)
    seen = Observation()
    watched = df.select(*schema.names).observe(
        seen, F.count(F.lit(1)).alias("rows"), *(count.alias(f"null {c}") for c, count in nulls.items())
    )
    # Readers skip folders whose names begin with an underscore.
    waiting = f"{path.rstrip('/')}/_waiting-{uuid.uuid4().hex}"
    to_path = spark._jvm.org.apache.hadoop.fs.Path
    files = to_path(path).getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        # Observed before rows are dealt: the exchange above may not run again what a retry repeats.
        watched.hint("rebalance", *by).write.option("compression", "snappy").partitionBy(*by).parquet(waiting)
        metrics = seen.get
        bad = [(c, "NULL in a required column", metrics[f"null {c}"]) for c in nulls if metrics[f"null {c}"]]
        if bad:
            raise ContractError(bad)
        _move(files, to_path, to_path(waiting), path.rstrip("/"), len(by))
    finally:
        files.delete(to_path(waiting), True)
    return metrics["rows"]


def _move(files, to_path, folder, target: str, depth: int) -> None:
    """Put the partition folders ``depth`` levels below ``folder`` in place of those of the same name."""
    for status in files.listStatus(folder):
        name = status.getPath().getName()
        if not status.isDirectory() or "=" not in name:
            continue
        place = f"{target}/{name}"
        if depth > 1:
            _move(files, to_path, status.getPath(), place, depth - 1)
            continue
        files.delete(to_path(place), True)
        files.mkdirs(to_path(target))
        if not files.rename(status.getPath(), to_path(place)):
            raise OSError(f"could not move {status.getPath()} to {place}")
