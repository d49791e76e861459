"""The row frame built forward from a state."""

import random
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from daygrid.plans import gold, rolling_state
from daygrid.sinks.partitions import write_partitions
from daygrid.sources.listing import folder_days
from tests.helpers import panel_of, rows_of, scenario_coins

FIRST = date(2026, 3, 1)


def sparse(spark, seed):
    """Entities that come and go; some are not seen for weeks."""
    rng = random.Random(seed)
    rows = []
    for k in range(40):
        for entity, chance in (("alder", 0.9), ("birch", 0.3), ("cedar", 0.1)):
            if k % 9 != 4 and rng.random() < chance:
                rows.append((entity, FIRST + timedelta(k), rng.randrange(1, 99), 5, None if rng.random() < 0.3 else rng.randrange(50)))
    return panel_of(spark, rows)


def rounded(df):
    return rows_of(df.withColumns({c: F.round(c, 9) for c in ("wkly_roll_avg_price", "wkly_roll_avg_volume")}))


@pytest.mark.parametrize("seed", [1, 2])
def test_builds_day_by_day_equal_the_full_build(spark, tmp_path, seed):
    panel, dim = sparse(spark, seed), scenario_coins(spark)
    silver, table, states = (str(tmp_path / n) for n in ("silver", "rolling", "states"))
    steps = [(0, 14), (15, 15), (16, 20), (23, 23), (21, 24), (25, 39)]
    for first, last in steps:
        span = (FIRST + timedelta(first), FIRST + timedelta(last))
        write_partitions(panel.where(F.col("snapshot_date").between(*span)), silver)
        held = folder_days(spark, silver)
        stored = spark.read.parquet(silver)
        rolling_state.advance(spark, stored, dim, states, held, span, lambda t: write_partitions(t, table))
        want = gold.rolling_average(stored, dim, frame="rows")
        assert rounded(spark.read.parquet(table)) == rounded(want), (first, last)


def test_a_day_reads_itself_and_the_state(spark, tmp_path):
    panel, dim = sparse(spark, 3), scenario_coins(spark)
    silver, states = str(tmp_path / "silver"), str(tmp_path / "states")
    write_partitions(panel, silver)
    stored, held = spark.read.parquet(silver), folder_days(spark, silver)
    written = []
    rolling_state.advance(spark, stored.where(F.col("snapshot_date") < held[-1]), dim, states, held[:-1], None, written.append)
    rolling_state.advance(spark, stored, dim, states, held, (held[-1], held[-1]), written.append)
    assert {r.snapshot_date for r in written[1].collect()} == {held[-1]}
    text = written[1]._jdf.queryExecution().executedPlan().toString()
    assert "(snapshot_date" in text and f"> {held[-2]}" in text and "PartitionFilters" in text
    assert folder_days(spark, states, "as_of") == [held[-2], held[-1]]
    per_entity = spark.read.parquet(f"{states}/as_of={held[-1]}").groupBy("coin_id").count().collect()
    assert {r["coin_id"] for r in per_entity} == {"alder", "birch", "cedar"} and max(r["count"] for r in per_entity) == 6
