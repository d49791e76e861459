import math
import random
from datetime import date

import pytest
from pyspark.sql import functions as F

from daygrid.operators.ranking import rank_within_day, remove_staging, splitters
from tests.helpers import rows_of

DAYS = [date(2026, 1, d) for d in (1, 2, 3)]


def hard_values():
    rng = random.Random(7)
    values = [None, 0.0, -0.0, math.inf, -math.inf, math.nan, 5e-324, -5e-324, 1.7976931348623157e308, 1.0, -1.0]
    close = 100.0
    for _ in range(20):
        close = math.nextafter(close, math.inf)
        values += [close, -close]
    values += [rng.lognormvariate(0, 8) for _ in range(60)]
    values += [round(rng.uniform(-5, 5), 1) for _ in range(60)]
    return values + [7.5] * 30 + [None] * 10


def frame(spark):
    rows = [(f"e{i}", day, v) for day in DAYS for i, v in enumerate(hard_values())]
    return spark.createDataFrame(rows, "coin_id string, snapshot_date date, v double")


def test_both_ways_give_the_same_ranks(spark, tmp_path):
    df = frame(spark).withColumn("w", -F.col("v")).where("NOT (snapshot_date = DATE'2026-01-03' AND coin_id > 'e2')")
    ranks = {"by_v": "v", "by_w": "w"}
    want = rank_within_day(df, ranks, unranked_nulls={"by_w"}, method="window").drop("v", "w")
    staging = str(tmp_path / "ranks")
    for cell, folder in ((1, None), (7, None), (60, None), (1_000_000, staging)):
        have = rank_within_day(df, ranks, unranked_nulls={"by_w"}, staging=folder, cell_rows=cell).drop("v", "w")
        assert rows_of(have) == rows_of(want), cell
    assert sorted(p.name for p in (tmp_path / "ranks").iterdir()) == ["rows"]
    remove_staging(spark, staging)
    assert not (tmp_path / "ranks").exists()


def test_ranks_against_brute_force(spark):
    df = frame(spark).where("NOT isnan(v) OR v IS NULL")
    have = {(r.coin_id, r.snapshot_date): r.rank for r in rank_within_day(df, {"rank": "v"}, cell_rows=11).collect()}
    rows = df.collect()
    for r in rows:
        day = [o.v for o in rows if o.snapshot_date == r.snapshot_date]
        if r.v is None:
            greater = sum(o is not None for o in day)
        else:
            greater = sum(o is not None and o > r.v for o in day)
        assert have[r.coin_id, r.snapshot_date] == greater + 1


@pytest.mark.parametrize("most", [4.0, None, math.nan, -math.inf])
def test_a_value_shared_by_most_rows_is_spread(spark, tmp_path, most):
    """Two thirds of a day hold one value: its cell has no order and is cut by salts."""
    df = spark.range(6_000).select(
        F.lit(DAYS[0]).alias("snapshot_date"), "id",
        F.when(F.col("id") % 3 > 0, F.lit(most)).otherwise(F.col("id") * 1.0).cast("double").alias("v"),
    )
    want = rank_within_day(df, {"rank": "v"}, method="window").drop("v")
    have = rank_within_day(df, {"rank": "v"}, cell_rows=500, staging=str(tmp_path / "s"))
    assert rows_of(have.drop("v")) == rows_of(want)
    largest = have.groupBy("rank").count().agg(F.max("count")).first()[0]
    assert largest == 4_000


def test_cells_hold_about_their_share(spark, tmp_path):
    df = spark.range(20_000).select(F.lit(DAYS[0]).alias("snapshot_date"), (F.col("id") * 1.0).alias("v"))
    cuts = splitters(df, "snapshot_date", ["v"], 1_000, str(tmp_path / "cuts")).first()["_at_v"]
    edges = [0.0, *cuts, 20_000.0]
    assert len(cuts) == 19 and max(b - a for a, b in zip(edges, edges[1:], strict=False)) <= 1_100
    assert splitters(df, "snapshot_date", ["v"], 20_000, str(tmp_path / "none")) is None


def test_ranks_of_days_without_values(spark):
    df = spark.createDataFrame([(f"e{i}", DAYS[0], None) for i in range(9)], "coin_id string, snapshot_date date, v double")
    assert {r.rank for r in rank_within_day(df, {"rank": "v"}, cell_rows=2).collect()} == {1}
    assert rank_within_day(df.limit(0), {"rank": "v"}).collect() == []


def test_splitters_of_a_day_are_bounded_and_stay_out_of_the_shuffle(spark, tmp_path):
    """Cells of five rows would be 8,000 a day: all of them in every row and task."""
    df = spark.range(40_000).select(F.lit(DAYS[0]).alias("snapshot_date"), "id", (F.col("id") % 30_011 * 1.0).alias("v"))
    assert len(splitters(df, "snapshot_date", ["v"], 5, str(tmp_path / "cuts")).first()["_at_v"]) < 128
    have = rank_within_day(df, {"rank": "v", "again": "v"}, cell_rows=5, staging=str(tmp_path / "s"))
    assert rows_of(have) == rows_of(rank_within_day(df, {"rank": "v", "again": "v"}, method="window"))
    plan = have._jdf.queryExecution().optimizedPlan().toString()
    above = plan[: plan.index("_cut_v")].splitlines()
    assert sum("Window [rank(" in line for line in above) == 2


def test_ranks_read_no_other_column_and_look_cells_up_without_lambdas(spark, tmp_path):
    """Two ranks of 32 million rows took most of their time in a lambda per row and in columns nobody asked for."""
    df = spark.range(3_000).select(
        F.lit(DAYS[0]).alias("snapshot_date"), "id", F.lit("text").alias("memo"),
        F.when(F.col("id") % 4 > 0, F.col("id") % 700 * 1.0).alias("v"), (F.col("id") % 11 * 1.0).alias("w"),
    )
    ranks = {"by_v": "v", "by_w": "w"}
    have = rank_within_day(df, ranks, cell_rows=5, staging=str(tmp_path / "s")).select("id", *ranks)
    assert rows_of(have) == rows_of(rank_within_day(df, ranks, method="window").select("id", *ranks))
    plan = have._jdf.queryExecution().optimizedPlan().toString()
    assert "_cut_v" in plan and "aggregate([" not in plan
    scans = have._jdf.queryExecution().sparkPlan().toString()
    assert "ReadSchema" in scans and "memo" not in scans


def test_a_day_asked_for_is_asked_of_the_stored_rows(spark, tmp_path):
    have = rank_within_day(frame(spark), {"rank": "v"}, cell_rows=7, staging=str(tmp_path / "s")).where(F.col("snapshot_date") == DAYS[1])
    want = rank_within_day(frame(spark), {"rank": "v"}, method="window").where(F.col("snapshot_date") == DAYS[1])
    assert rows_of(have.drop("v")) == rows_of(want.drop("v"))
    scan = next(line for line in have._jdf.queryExecution().sparkPlan().toString().splitlines() if "coin_id" in line and "FileScan" in line)
    assert "EqualTo(snapshot_date,2026-01-02)" in scan
