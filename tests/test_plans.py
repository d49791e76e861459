"""Shape of the physical plans: pruning, partitioned windows, checked broadcasts, no Python."""

import re
from datetime import date

import pytest

from daygrid.operators import ranking
from daygrid.plans import gold, governance
from daygrid.sinks.partitions import write_partitions
from daygrid.sources.snapshots import read_snapshots
from tests.helpers import TARGET, scenario_coins, scenario_panel


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "price_snapshots")
    write_partitions(scenario_panel(spark), path)
    return spark.read.parquet(path)


def builders(stored, coins, span):
    return {
        "daily": gold.daily_snapshot(stored, coins, span, method="window"),
        "rank": gold.rank_change(stored, coins, span, method="window"),
        "calendar": gold.rolling_average(stored, coins, span, frame="calendar"),
    }


def test_a_day_reads_only_the_days_it_depends_on(spark, stored):
    for name, df in builders(stored, scenario_coins(spark), (TARGET, TARGET)).items():
        assert re.search(r"PartitionFilters: \[.*snapshot_date", plan(df)), name


def test_landed_files_are_pruned_by_folder(spark, tmp_path):
    spark.createDataFrame([("a", "2026", "07", "28")], "id string, year string, month string, day string").write.partitionBy(
        "year", "month", "day"
    ).parquet(f"{tmp_path}/landed")
    text = plan(read_snapshots(spark, f"{tmp_path}/landed", (date(2026, 7, 1), date(2026, 7, 2))).select("id"))
    assert re.search(r"PartitionFilters: \[.*make_date", text) and "ReadSchema: struct<id:string>" in text


def test_columns_are_pruned(spark, stored):
    text = plan(gold.rank_change(stored, scenario_coins(spark), method="window"))
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert "volume" not in schema and "vwap" not in schema and "change_percent" not in schema


def test_no_window_runs_in_a_single_partition(spark, stored):
    for name, df in builders(stored, scenario_coins(spark), None).items():
        assert "SinglePartition" not in plan(df), name


def test_windows_by_entity_share_one_shuffle(spark, stored):
    text = plan(gold.rank_change(stored, scenario_coins(spark), method="window").drop("symbol", "name"))
    windows = text.count("hashpartitioning(coin_id")
    # One for both lookbacks, at most one more pair for the dimension join.
    assert text.count("Exchange hashpartitioning(snapshot_date") == 1 and windows <= 2, text


def test_dimension_is_broadcast_only_while_small(spark, stored, tmp_path):
    scenario_coins(spark).write.parquet(str(tmp_path / "coins"))
    coins = spark.read.parquet(str(tmp_path / "coins"))
    assert "BroadcastHashJoin" in plan(gold.with_dimension(stored, coins))
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        text = plan(gold.with_dimension(stored, coins))
        assert "BroadcastHashJoin" not in text and "SortMergeJoin" in text
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_large_days_are_ranked_in_cells(spark, stored, tmp_path):
    text = plan(gold.with_cap_rank(stored, cell_rows=1, staging=str(tmp_path / "cells")))
    keys = re.findall(r"Window \[rank\([^\n]*\], \[(snapshot_date#\d+[^\]]*)\]", text)
    assert keys and all("_cell" in key and "_salt" in key for key in keys)
    # Rows are dealt once; the others are counts per cell and their sums.
    assert text.count("Exchange hashpartitioning") <= 3, text
    small = plan(gold.with_cap_rank(stored, staging=str(tmp_path / "days")))
    assert "_cell" not in small and small.count("Exchange hashpartitioning") == 1


def test_ranks_read_the_panel_once(spark, stored, tmp_path):
    """Both ranks of a table read the rows stored for them, not the panel."""
    text = plan(gold.daily_snapshot(stored, scenario_coins(spark), cell_rows=1, staging=str(tmp_path / "once")))
    assert "price_snapshots" not in text
    ranking.remove_staging(spark, str(tmp_path / "once"))


def test_quota_prunes_before_the_shuffle(spark):
    log = spark.createDataFrame(
        [("r", "fast", date(2026, 1, 1), 1)], "request_id string, profile string, ts date, call_id long"
    )
    lines = plan(governance.admitted_calls(log)).splitlines()
    partial = next(i for i, line in enumerate(lines) if "WindowGroupLimit" in line and "Partial" in line)
    exchange = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning(request_id" in line)
    assert partial > exchange  # below it in the tree, that is, before it
