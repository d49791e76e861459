from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from daygrid.plans import gold, serving
from tests.helpers import TARGET, before_target, by_key, panel_of, rows_of, scenario_coins, scenario_panel

D = date(2026, 1, 10)


def test_daily_snapshot_scenario(spark):
    daily = gold.daily_snapshot(scenario_panel(spark), scenario_coins(spark), (TARGET, TARGET))
    rows = by_key(daily, "coin_id")
    assert set(rows) == {"alder", "birch", "cedar"}
    a, b, c = rows["alder"], rows["birch"], rows["cedar"]
    assert (a.coin_rank, a.prev_price_usd, a.price_change_rank) == (2, 50.0, 1)
    assert a.price_change_pct == pytest.approx(10.0)
    assert (b.coin_rank, b.price_change_rank) == (1, 2)
    assert b.price_change_pct == pytest.approx(-5.0)
    assert (c.coin_rank, c.prev_price_usd, c.price_change_pct, c.price_change_rank) == (3, None, None, None)
    assert (a.symbol, c.name) == ("ALD", "Cedar")


def test_rank_change_scenario(spark):
    table = gold.rank_change(scenario_panel(spark), scenario_coins(spark), (TARGET, TARGET))
    rows = by_key(table, "coin_id")
    a, c = rows["alder"], rows["cedar"]
    assert (a.mc_rank_diff_14d, a.mc_rank_diff_30d) == (-1, 0)
    assert a.price_diff_14d_pct == pytest.approx(25.0)
    assert a.price_diff_30d_pct == pytest.approx(37.5)
    assert (c.mc_rank_diff_14d, c.price_diff_30d_pct) == (None, None)


def test_rolling_average_scenario(spark):
    table = gold.rolling_average(
        scenario_panel(spark), scenario_coins(spark), (TARGET, TARGET), frame="calendar"
    )
    rows = by_key(table, "coin_id")
    assert rows["alder"].wkly_roll_avg_price == pytest.approx(346 / 7)
    assert rows["alder"].wkly_roll_avg_volume == pytest.approx(70.0)
    assert rows["birch"].wkly_roll_avg_price == pytest.approx(130 / 7)
    assert rows["birch"].wkly_roll_avg_volume == pytest.approx(527 / 7)
    assert rows["cedar"].wkly_roll_avg_price == pytest.approx(2.5)


def edge_panel(spark):
    return panel_of(
        spark,
        [
            ("a", D, 0, 50, None), ("a", D + timedelta(1), 10, 50, None),  # previous price 0
            ("b", D, 5, 50, 1), ("b", D + timedelta(2), 6, 40, 1),  # gap of one day
            ("c", D, 8, None, 1), ("c", D + timedelta(1), 4, 10, 1),  # no cap on the first day
            ("z", D + timedelta(1), 3, 50, None),
        ],
    )


def test_changes_over_zero_gap_and_unknown_entity(spark):
    rows = by_key(gold.daily_snapshot(edge_panel(spark), scenario_coins(spark)))
    zero = rows["a", D + timedelta(1)]
    assert zero.prev_price_usd == 0.0 and zero.price_change_pct is None and zero.price_change_rank is None
    gap = rows["b", D + timedelta(2)]
    assert gap.prev_price_usd is None and gap.price_change_pct is None
    assert rows["c", D + timedelta(1)].price_change_pct == -50.0
    assert rows["c", D + timedelta(1)].price_change_rank == 1
    assert all(r.symbol is None and r.name is None for r in rows.values())


def test_cap_ties_share_a_rank_and_leave_a_gap(spark):
    rows = by_key(gold.with_cap_rank(edge_panel(spark)))
    assert [rows[e, D].coin_rank for e in "abc"] == [1, 1, 3]
    assert [rows[e, D + timedelta(1)].coin_rank for e in "azc"] == [1, 1, 3]


def test_rank_moves_are_positive_upwards(spark):
    later = D + timedelta(14)
    panel = panel_of(spark, [("a", D, 1, 10, 1), ("b", D, 1, 20, 1), ("a", later, 2, 30, 1), ("b", later, 1, 20, 1)])
    rows = by_key(gold.rank_change(panel, scenario_coins(spark)))
    assert rows["a", later].mc_rank_diff_14d == 1
    assert rows["b", later].mc_rank_diff_14d == -1
    assert rows["a", D].mc_rank_diff_14d is None


def test_row_frame_reaches_over_gaps_and_calendar_frame_does_not(spark):
    panel = panel_of(spark, [("a", D, 1, 1, None), ("a", D + timedelta(60), 3, 1, 4)])
    coins = scenario_coins(spark)
    last = ("a", D + timedelta(60))
    by_rows = by_key(gold.rolling_average(panel, coins, frame="rows"))
    by_days = by_key(gold.rolling_average(panel, coins, frame="calendar"))
    assert by_rows[last].wkly_roll_avg_price == 2.0
    assert by_days[last].wkly_roll_avg_price == 3.0
    assert by_rows[last].wkly_roll_avg_volume == 4.0
    assert by_rows["a", D].wkly_roll_avg_volume is None
    with pytest.raises(ValueError):
        gold.rolling_average(panel, coins, frame="weeks")


@pytest.mark.parametrize("method", ["window", "range"])
def test_any_span_equals_full_history_cut_to_it(spark, method):
    panel, coins = scenario_panel(spark), scenario_coins(spark)
    builders = [
        lambda span: gold.daily_snapshot(panel, coins, span, method=method),
        lambda span: gold.rank_change(panel, coins, span, method=method),
        lambda span: gold.rolling_average(panel, coins, span, frame="calendar"),
        lambda span: gold.rolling_average(panel, coins, span, frame="rows"),
    ]
    spans = [(TARGET, TARGET), (before_target(14), before_target(5))]
    for build in builders:
        full = build(None).cache()
        for span in spans:
            cut = full.where(F.col("snapshot_date").between(*span))
            assert rows_of(build(span)) == rows_of(cut)
        full.unpersist()


def test_latest_snapshot_and_availability(spark):
    panel, coins = scenario_panel(spark), scenario_coins(spark)
    daily = gold.daily_snapshot(panel, coins)
    latest = serving.latest_snapshot(daily)
    assert {r.snapshot_date for r in latest.collect()} == {TARGET} and latest.count() == 3
    end = TARGET + timedelta(2)
    table = serving.availability(
        panel,
        daily.where((F.col("snapshot_date") != F.lit(before_target(1))) | (F.col("coin_id") != "alder")),
        gold.rank_change(panel, coins).where(F.col("snapshot_date") != F.lit(before_target(2))),
        gold.rolling_average(panel, coins),
        end,
        expected=2,
    )
    rows = by_key(table, "snapshot_date")
    assert len(rows) == (end - before_target(30)).days + 1
    assert rows[TARGET].availability_status == "available" and rows[TARGET].availability_reason is None
    assert rows[end].availability_reason == "silver_missing" and rows[end].volume_coverage_pct is None
    assert rows[before_target(1)].availability_reason == "daily_snapshot_row_count_mismatch"
    assert rows[before_target(2)].availability_reason == "rank_change_missing"
    assert rows[TARGET].source_coverage_pct == 150.0 and rows[TARGET].vwap_coverage_pct == 0.0


def test_availability_of_an_empty_panel_is_one_missing_day(spark):
    panel = scenario_panel(spark).where("false")
    daily = gold.daily_snapshot(panel, scenario_coins(spark))
    rank = gold.rank_change(panel, scenario_coins(spark))
    rolling = gold.rolling_average(panel, scenario_coins(spark))
    rows = serving.availability(panel, daily, rank, rolling, TARGET).collect()
    assert [(r.snapshot_date, r.availability_status) for r in rows] == [(TARGET, "missing")]
    reversed_bounds = serving.availability(panel, daily, rank, rolling, TARGET, start=TARGET + timedelta(1))
    assert reversed_bounds.count() == 0


def test_affected_dates(spark):
    panel = scenario_panel(spark)
    changed = spark.createDataFrame([(before_target(14),)], "snapshot_date date")
    days = {r.snapshot_date for r in gold.affected_dates(changed, panel).collect()}
    assert days == {before_target(14), TARGET}
