"""Days of users and suppliers grow with the data: no window sorts a whole day."""

import pytest

from workload import load_queries

QUERIES, _ = load_queries()


@pytest.mark.parametrize("name", ["gold_daily_snapshot_full", "gold_rank_change_full"])
@pytest.mark.parametrize("suffix", ["_users", "_suppliers"])
def test_no_rank_over_a_whole_day(spark, data_root, name, suffix):
    plan = QUERIES[name + suffix](spark, data_root)._jdf.queryExecution().optimizedPlan().toString()
    assert "rank(" not in plan
