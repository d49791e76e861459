"""Days that changed are found by their fingerprints, and Gold is rebuilt for them only."""

from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from daygrid.operators.fingerprint import changed_days, day_fingerprints
from daygrid.plans import jobs
from daygrid.schemas import DAY
from daygrid.sinks.partitions import upsert_version, write_partitions
from tests.helpers import TARGET, rows_of, scenario_coins, scenario_panel

ONE, TWO = date(2026, 5, 1), date(2026, 5, 2)


def prints(spark, rows, names="a long, b long"):
    return day_fingerprints(spark.createDataFrame(rows, f"{DAY} date, {names}"))


def found(before, after):
    return {r[DAY]: r.change for r in changed_days(before, after).collect()}


def test_order_of_rows_and_columns_does_not_matter(spark):
    rows = [(ONE, 1, 2), (ONE, 3, None), (ONE, 1, 2), (None, 4, 4)]
    turned = [(day, b, a) for day, a, b in reversed(rows)]
    assert found(prints(spark, rows), prints(spark, turned, "b long, a long")) == {}


def test_every_difference_is_found(spark):
    rows = [(ONE, 1, None), (TWO, 5, 5), (None, 1, 1)]
    swapped = [(ONE, None, 1), (TWO, 5, 5), (TWO, 5, 5), (None, 1, 2)]
    assert found(prints(spark, rows), prints(spark, swapped)) == {ONE: "changed", TWO: "changed", None: "changed"}
    assert found(prints(spark, rows[:1]), prints(spark, rows[1:])) == {ONE: "removed", TWO: "added", None: "added"}
    assert found(prints(spark, []), prints(spark, [])) == {}


def test_refresh_builds_what_changed(spark, tmp_path, monkeypatch):
    silver, gold, fresh = (str(tmp_path / n) for n in ("silver", "gold", "fresh"))
    panel = scenario_panel(spark)
    write_partitions(panel, f"{silver}/price_snapshots")
    upsert_version(f"{silver}/coins", scenario_coins(spark), ["id"])
    held = sorted(r[DAY] for r in panel.select(DAY).distinct().collect())
    assert jobs.refresh_gold(spark, silver, gold) == held
    spans, build = [], jobs.build_gold
    monkeypatch.setattr(jobs, "build_gold", lambda *args, **options: spans.append(args[3]) or build(*args, **options))
    # The same rows again, written anew in another order.
    write_partitions(panel.orderBy(F.desc("coin_id")), f"{silver}/price_snapshots")
    assert jobs.refresh_gold(spark, silver, gold) == [] and spans == []
    assert jobs.refresh_gold(spark, silver, gold, (TARGET, TARGET)) == [] and spans == []
    # One day with other prices: that day and those that depend on it are rebuilt.
    day = held[-2]
    dearer = panel.where(F.col(DAY) == F.lit(day)).withColumn("price_usd", F.col("price_usd") + 1)
    write_partitions(dearer, f"{silver}/price_snapshots")
    assert jobs.refresh_gold(spark, silver, gold, (held[0], held[0])) == []
    assert jobs.refresh_gold(spark, silver, gold) == [day] and spans == [(day, day)]
    build(spark, silver, fresh)
    for name in ("daily_snapshot", "rank_change", "rolling_average"):
        assert rows_of(spark.read.parquet(f"{gold}/{name}")) == rows_of(spark.read.parquet(f"{fresh}/{name}"))
    assert jobs.refresh_gold(spark, silver, gold) == []


def test_a_failed_refresh_finds_its_days_again(spark, tmp_path, monkeypatch):
    silver, gold = (str(tmp_path / n) for n in ("silver", "gold"))
    panel = scenario_panel(spark)
    write_partitions(panel, f"{silver}/price_snapshots")
    upsert_version(f"{silver}/coins", scenario_coins(spark), ["id"])

    def torn(*args, **options):
        raise OSError("lost")

    monkeypatch.setattr(jobs, "build_gold", torn)
    with pytest.raises(OSError):
        jobs.refresh_gold(spark, silver, gold)
    monkeypatch.undo()
    built = jobs.refresh_gold(spark, silver, gold)
    assert built and jobs.refresh_gold(spark, silver, gold) == []
    # A day that leaves the panel is refused.
    gone = spark._jvm.org.apache.hadoop.fs.Path(f"{silver}/price_snapshots/{DAY}={built[0]}")
    gone.getFileSystem(spark._jsc.hadoopConfiguration()).delete(gone, True)
    with pytest.raises(ValueError, match=str(built[0])):
        jobs.refresh_gold(spark, silver, gold, (built[0], built[0] + timedelta(3)))
