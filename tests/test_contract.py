"""Writes against declared schemas."""

import pytest
from pyspark.sql import functions as F

from daygrid.schemas import ASSET_MARKET_CAP, COINS, PRICE_SNAPSHOTS, TOTAL_MARKET_CAP
from daygrid.sinks.contract import ContractError, violations, write_checked
from daygrid.sinks.partitions import merge_partitions
from tests.helpers import TARGET, rows_of, scenario_coins, scenario_panel


def loose(df):
    """The same rows with every column nullable."""
    return df.select(*(F.when(F.lit(True), F.col(c)).alias(c) for c in df.columns))


def test_sound_rows_replace_their_days(spark, tmp_path):
    path = str(tmp_path / "panel")
    panel = scenario_panel(spark)
    assert write_checked(panel.select(*reversed(panel.columns)), path, PRICE_SNAPSHOTS) == panel.count()
    assert rows_of(spark.read.parquet(path)) == rows_of(panel)
    changed = panel.where(F.col("snapshot_date") == TARGET).withColumn("price_usd", F.lit(1.5))
    write_checked(changed, path, PRICE_SNAPSHOTS)
    want = panel.where(F.col("snapshot_date") < TARGET).unionByName(changed)
    assert rows_of(spark.read.parquet(path)) == rows_of(want)
    assert write_checked(panel.limit(0), path, PRICE_SNAPSHOTS) == 0
    assert rows_of(spark.read.parquet(path)) == rows_of(want)


def test_bad_rows_never_reach_the_table(spark, tmp_path):
    path = str(tmp_path / "panel")
    panel = scenario_panel(spark)
    write_checked(panel, path, PRICE_SNAPSHOTS)
    before = rows_of(spark.read.parquet(path))
    bad = loose(panel).withColumn("coin_id", F.when(F.col("coin_id") != "birch", F.col("coin_id")))
    with pytest.raises(ContractError) as failed:
        write_checked(bad, path, PRICE_SNAPSHOTS)
    assert failed.value.violations == [("coin_id", "NULL in a required column", 9)]
    with pytest.raises(ContractError, match="coin_id: NULL"):
        merge_partitions(path, bad.where("price_usd = 19"), ["coin_id", "snapshot_date"], schema=PRICE_SNAPSHOTS)
    for frame, text in (
        (panel.drop("vwap_24hr"), "vwap_24hr: missing column"),
        (panel.withColumn("extra", F.lit(1)), "extra: column not declared"),
        (panel.withColumn("price_usd", F.col("price_usd").cast("string")), "price_usd: type string, declared double"),
    ):
        with pytest.raises(ContractError, match=text):
            write_checked(frame, path, PRICE_SNAPSHOTS)
    assert rows_of(spark.read.parquet(path)) == before
    assert [p.name for p in (tmp_path / "panel").iterdir() if p.name.startswith("_waiting")] == []


def test_violations_of_each_schema(spark):
    panel = loose(scenario_panel(spark))
    coins = loose(scenario_coins(spark))
    none = F.lit(None)
    cases = [
        (panel.withColumn("snapshot_date", none.cast("date")), PRICE_SNAPSHOTS, {("snapshot_date", 19)}),
        (coins.withColumn("id", F.when(F.col("id") > "b", F.col("id"))), COINS, {("id", 1)}),
        (panel.select("coin_id", "snapshot_date", "market_cap_usd"), ASSET_MARKET_CAP, set()),
        (panel.select(none.cast("date").alias("snapshot_date"), F.lit(1.0).alias("total_market_cap_usd")), TOTAL_MARKET_CAP,
         {("snapshot_date", 19)}),
        (panel.select("snapshot_date"), TOTAL_MARKET_CAP, {("total_market_cap_usd", None)}),
    ]
    for df, schema, want in cases:
        assert {(r.column_name, r.row_count) for r in violations(df, schema).collect()} == want
