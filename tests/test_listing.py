"""Answers from folder names and file footers."""

import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from daygrid.functions.dates import date_of_epoch_ms
from daygrid.sinks.partitions import write_partitions
from daygrid.sources import listing
from tests.helpers import TARGET, before_target, rows_of, scenario_panel


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def table(spark, tmp_path):
    path = str(tmp_path / "panel")
    write_partitions(scenario_panel(spark), path)
    return path


def empty_day(spark, path, day):
    """A folder whose only file holds no row."""
    spark.read.parquet(path).drop("snapshot_date").limit(0).coalesce(1).write.parquet(f"{path}/snapshot_date={day}")


def test_days_and_rows_equal_a_scan(spark, table):
    want = spark.read.parquet(table).groupBy("snapshot_date").agg(F.count(F.lit(1)).alias("row_count"))
    assert rows_of(listing.stored_rows(spark, table)) == rows_of(want)
    assert listing.folder_days(spark, table) == sorted(r.snapshot_date for r in want.collect())
    assert listing.newest_stored_day(spark, table) == TARGET
    assert listing.folder_days(spark, table + "-none") == [] and listing.newest_stored_day(spark, table + "-none") is None


def test_one_day_opens_files_of_that_day_only(spark, table):
    rows = listing.stored_rows(spark, table, [TARGET])
    text = plan(rows)
    assert re.search(r"PushedAggregation: \[COUNT", text) and re.search(r"PartitionFilters: \[[^\]]*snapshot_date", text), text
    assert [tuple(r) for r in rows.collect()] == [(TARGET, 3)]
    absent = listing.missing_stored_days(spark, {"panel": table}, [TARGET, before_target(7)])
    assert [tuple(r) for r in absent.collect()] == [("panel", before_target(7))]
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""


def test_folders_without_rows_are_not_days(spark, table):
    late = date(2026, 2, 1)
    empty_day(spark, table, late)
    assert late in listing.folder_days(spark, table)
    assert listing.newest_stored_day(spark, table) == TARGET
    assert late not in [r.snapshot_date for r in listing.stored_rows(spark, table).collect()]
    with pytest.raises(ValueError, match="panel on 2026-02-01"):
        listing.require_stored(spark, {"panel": table}, [late, TARGET])
    listing.require_stored(spark, {"panel": table}, [TARGET])


def test_times_in_other_units_are_no_dates(spark):
    times = [0, 1_760_000_000_000, 1_760_000_000_000_000, 1_760_000_000_000_000_000, -10**18, None]
    df = spark.createDataFrame([(t,) for t in times], "ms long")
    found = [r[0] for r in df.select(date_of_epoch_ms(F.col("ms"))).collect()]
    assert found == [date(1970, 1, 1), date(2025, 10, 9), None, None, None, None]
