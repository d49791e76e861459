"""Landed files, contracts, typed tables, history repair, merges and whole loads."""

import json
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from daygrid.operators.dedup import latest_by_key, unique_or_fail
from daygrid.operators.upsert import upsert
from daygrid.plans import history, jobs, silver
from daygrid.schemas import DAY, KEY, SNAPSHOT_FILE
from daygrid.sinks.partitions import merge_partitions, read_version, upsert_version, write_partitions, write_snapshots
from daygrid.sources import payloads, snapshots
from tests.helpers import TARGET, before_target, by_key, panel_of, rows_of, scenario_coins, scenario_panel

LANDED = date(2025, 8, 9)
ANCHOR = date(2025, 12, 1)
START = ANCHOR - timedelta(60)


def asset(**changes):
    record = {
        "id": "alder", "rank": "4", "symbol": "ALD", "name": "Alder", "supply": "8200000.5",
        "maxSupply": "9000000.0", "marketCapUsd": "77100450.25", "volumeUsd24Hr": "3100200.75",
        "priceUsd": "9.4025", "changePercent24Hr": "-0.731", "vwap24Hr": "9.3811", "explorer": None,
    }
    return {**record, **changes}


BIRCH = asset(id="birch", rank="9", symbol="BIR", name="Birch", maxSupply=None, priceUsd="0.815")


def raw_rows(spark, *records, day=LANDED):
    rows = [(*(r[f] for f in SNAPSHOT_FILE.names[:12]), None, None) for r in records]
    return spark.createDataFrame(rows, SNAPSHOT_FILE).withColumn(DAY, F.lit(day))


def test_clean_snapshots_types_and_names(spark):
    cleaned = silver.clean_snapshots(raw_rows(spark, asset(), BIRCH).drop(DAY))
    assert cleaned.columns == [
        "id", "symbol", "name", "supply", "max_supply", "price_usd", "market_cap_usd",
        "volume_usd_24hr", "change_percent_24hr", "vwap_24hr",
    ]
    rows = by_key(cleaned, "id")
    assert rows["alder"].price_usd == pytest.approx(9.4025)
    assert rows["birch"].max_supply is None


@pytest.mark.parametrize("bad", ["not-a-number", "", "NaN", None])
def test_bad_price_is_null_and_refused(spark, bad):
    cleaned = silver.clean_snapshots(raw_rows(spark, asset(priceUsd=bad)))
    assert silver.required_field_nulls(cleaned).first().price_usd_nulls == 1
    with pytest.raises(ValueError, match="price_usd_nulls"):
        silver.require_fields(cleaned)


def test_load_snapshots_end_to_end(spark, tmp_path):
    landed, root = str(tmp_path / "landed"), str(tmp_path / "silver")
    write_snapshots(raw_rows(spark, asset(), BIRCH), landed)
    jobs.load_snapshots(spark, landed, root, (LANDED, LANDED))
    coins = by_key(read_version(spark, f"{root}/coins"), "id")
    panel = spark.read.parquet(f"{root}/price_snapshots")
    assert set(coins) == {"alder", "birch"} and "rank" not in coins["alder"].asDict()
    assert by_key(panel, "coin_id")["birch"].price_usd == 0.815
    assert "fetched_at_utc" not in panel.columns
    before = rows_of(panel)

    write_snapshots(raw_rows(spark, asset(name="Alder 2"), day=LANDED + timedelta(1)), landed)
    jobs.load_snapshots(spark, landed, root, (LANDED, LANDED + timedelta(1)))
    panel = spark.read.parquet(f"{root}/price_snapshots")
    assert rows_of(panel.where(F.col(DAY) == F.lit(LANDED))) == before
    assert panel.count() == 3
    coins = by_key(read_version(spark, f"{root}/coins"), "id")
    assert coins["alder"].name == "Alder 2" and len(coins) == 2
    with pytest.raises(ValueError, match="no landed files"):
        jobs.load_snapshots(spark, landed, root, (LANDED, LANDED + timedelta(2)))


def test_files_without_provenance_and_with_extra_columns(spark, tmp_path):
    root = str(tmp_path)
    old = raw_rows(spark, asset()).drop(DAY, "api_timestamp_ms", "fetched_at_utc").withColumn("extra", F.lit(1))
    old.write.parquet(f"{root}/{snapshots.dated_folder(LANDED)}")
    rows = snapshots.read_snapshots(spark, root).collect()
    assert len(rows) == 1 and rows[0][DAY] == LANDED and rows[0].api_timestamp_ms is None
    assert "extra" not in rows[0].asDict()


# ---------------------------------------------------------------- contracts


def checked(spark, contract, *bodies):
    texts = [b if isinstance(b, str) else json.dumps(b) for b in bodies]
    df = spark.createDataFrame(list(enumerate(texts)), "n int, payload string")
    good, bad = payloads.validate_contract(df, "payload", contract)
    return good.collect(), {r.n: r.reason for r in bad.collect()}


def test_asset_contract(spark):
    without_id = {k: v for k, v in asset().items() if k != "id"}
    without_optional = {k: v for k, v in asset().items() if k not in ("maxSupply", "vwap24Hr", "explorer")}
    good, bad = checked(
        spark,
        payloads.ASSETS,
        {"data": [asset(), BIRCH], "timestamp": 7},
        {"data": [asset(), without_id], "timestamp": 7},
        {"data": [asset(priceUsd=9.5)], "timestamp": 7},
        {"data": [asset()]},
        [asset()],
        "{broken",
        {"data": [without_optional], "timestamp": 8},
        {"data": [asset(symbol=None)], "timestamp": 8},
        {"data": [], "timestamp": 9},
        {"data": [asset(vwap24Hr=1)], "timestamp": 8},
    )
    assert sorted((r.n, r.id, r.api_timestamp_ms) for r in good) == [
        (0, "alder", 7), (0, "birch", 7), (6, "alder", 8)
    ]
    assert bad == {
        1: "missing id", 2: "not a string: priceUsd", 3: "no integer timestamp", 4: "no record list",
        5: "not JSON", 7: "missing symbol", 9: "not a string: vwap24Hr",
    }


def test_history_contracts(spark):
    good, bad = checked(
        spark,
        payloads.ASSET_HISTORY,
        [{"time": 1, "priceUsd": "1.5", "other": True}],
        {"data": [{"time": "2", "priceUsd": 2.5, "date": "2025-10-02"}]},
        {"data": [{"time": 3}]},
        {"data": [{"priceUsd": "1"}]},
        {"data": [{"time": 4, "priceUsd": True}]},
        {"data": [{"time": "x", "priceUsd": 1}]},
        {"rows": []},
    )
    assert sorted((r.n, r.time, r.priceUsd) for r in good) == [(0, "1", "1.5"), (1, "2", "2.5")]
    assert bad == {
        2: "missing priceUsd", 3: "missing time", 4: "not a number: priceUsd", 5: "not an integer: time",
        6: "no record list",
    }
    for spelling in ("marketCapUsd", "marketcapUsd", "marketCap", "marketcap"):
        good, bad = checked(spark, payloads.ASSET_MARKET_CAP_HISTORY, [{"time": 1, spelling: 5}])
        assert [r.marketCapUsd for r in good] == ["5"] and not bad
    good, bad = checked(spark, payloads.TOTAL_MARKET_CAP_HISTORY, [{"time": 1, "total_market_cap_usd": "6"}], [{"time": 1}])
    assert [r.totalMarketCapUsd for r in good] == ["6"] and bad == {1: "missing totalMarketCapUsd"}


# ---------------------------------------------------------------- history

MS = int(datetime(START.year, START.month, START.day, tzinfo=timezone.utc).timestamp() * 1000)


def write_history(spark, root):
    folder = f"{root}/anchor_date={ANCHOR}/window_days=60"
    iso = f"{START}T00:00:00.000Z"
    spark.createDataFrame(
        [("alder", "9.41", "3000100.0", MS, iso), ("birch", "0.83", "51000.0", MS, iso)],
        "coin_id string, priceUsd string, volumeUsd24Hr string, time long, date string",
    ).write.parquet(f"{folder}/asset_history.parquet")
    spark.createDataFrame(
        [("alder", "77000000.0", MS, None), ("birch", "252000.5", MS, None)],
        "coin_id string, marketCapUsd string, time long, date string",
    ).write.parquet(f"{folder}/asset_market_cap_history.parquet")
    spark.createDataFrame(
        [("880000000.25", MS, iso)], "totalMarketCapUsd string, time long, date string"
    ).write.parquet(f"{folder}/total_market_cap_history.parquet")


def test_history_backfill_end_to_end(spark, tmp_path):
    landed, root = str(tmp_path / "landed"), str(tmp_path / "silver")
    write_history(spark, landed)
    kept = panel_of(spark, [("alder", ANCHOR, 9.9, 80000000, 3200000)])
    write_partitions(kept, f"{root}/price_snapshots")
    for _ in range(2):  # a rerun changes nothing
        jobs.load_history(spark, landed, root, ANCHOR, 60)
        panel = by_key(spark.read.parquet(f"{root}/price_snapshots"))
        assert len(panel) == 3
        assert panel["alder", START].market_cap_usd == 77000000.0
        assert panel["alder", ANCHOR].price_usd == 9.9
        assert panel["birch", START].vwap_24hr is None
        caps = by_key(spark.read.parquet(f"{root}/asset_market_cap_history"))
        assert caps["birch", START].market_cap_usd == 252000.5
        total = spark.read.parquet(f"{root}/total_market_cap_history").collect()
        assert [(r.snapshot_date, r.total_market_cap_usd) for r in total] == [(START, 880000000.25)]


def test_history_points_without_optional_columns(spark):
    raw = spark.createDataFrame([("a", "1.5", MS), ("a", "2.5", MS + 1000), ("a", "3", None)], "coin_id string, priceUsd string, time long")
    rows = history.clean_asset_history(raw).collect()
    assert [(r.coin_id, r.snapshot_date, r.price_usd, r.volume_usd_24hr) for r in rows] == [("a", START, 2.5, None)]


def test_backfill_plan(spark):
    coins = spark.createDataFrame([("b",), ("a",)], "id string")
    panel = panel_of(spark, [("a", ANCHOR, 1, 1, 1), ("a", START, 1, 1, 1)])
    rows = history.backfill_plan(coins, panel, 60).orderBy("coin_id").collect()
    assert [r.coin_id for r in rows] == ["a", "b"]
    assert (rows[0].window_start_date, rows[0].window_end_date) == (START, ANCHOR - timedelta(1))
    assert history.backfill_plan(coins, panel, 1, START).first().window_end_date == START - timedelta(1)
    with pytest.raises(Exception, match="the panel is empty"):
        history.backfill_plan(coins, panel.where("false"), 60).collect()
    with pytest.raises(ValueError):
        history.backfill_plan(coins, panel, 0)
    with pytest.raises(ValueError, match="entity table is empty"):
        history.backfill_plan(coins.where("false"), panel, 60)


# ---------------------------------------------------------------- merges


def test_upsert_takes_source_nulls(spark):
    target = panel_of(spark, [("a", START, 1, 10, 5), ("b", START, 2, 20, 5)])
    source = panel_of(spark, [("a", START, 3, None, None), ("c", START, 4, 40, 1)])
    rows = by_key(upsert(target, source, KEY))
    assert (rows["a", START].price_usd, rows["a", START].market_cap_usd, rows["a", START].volume_usd_24hr) == (3.0, None, None)
    assert rows["b", START].price_usd == 2.0 and rows["c", START].price_usd == 4.0


def test_merge_rewrites_only_touched_days(spark, tmp_path):
    path = str(tmp_path / "t")
    days = [START, START + timedelta(1)]
    write_partitions(panel_of(spark, [("a", d, 1, 1, 1) for d in days]), path)
    untouched = sorted((tmp_path / "t" / f"snapshot_date={days[1]}").iterdir())
    source = panel_of(spark, [("a", days[0], 2, 2, 2), ("b", days[0], 3, 3, 3)])
    merge_partitions(path, source, KEY)
    rows = by_key(spark.read.parquet(path))
    assert [rows[k].price_usd for k in (("a", days[0]), ("b", days[0]), ("a", days[1]))] == [2.0, 3.0, 1.0]
    assert sorted((tmp_path / "t" / f"snapshot_date={days[1]}").iterdir()) == untouched
    with pytest.raises(ValueError, match="more than one source row"):
        merge_partitions(path, source.unionByName(source), KEY)


def test_versioned_dimension(spark, tmp_path):
    path = str(tmp_path / "coins")
    assert read_version(spark, path) is None
    coins = scenario_coins(spark)
    upsert_version(path, coins, ["id"])
    upsert_version(path, coins.where("id = 'alder'").withColumn("max_supply", F.lit(None).cast("double")), ["id"])
    rows = by_key(read_version(spark, path), "id")
    assert len(rows) == 3 and rows["alder"].max_supply is None


def test_dedup_is_deterministic_and_null_aware(spark):
    df = spark.createDataFrame([("a", 1, 5.0), ("a", 2, None), ("a", 2, 7.0), ("b", None, 1.0)], "k string, t int, v double")
    assert by_key(latest_by_key(df, ["k"], ["t"]), "k")["a"].v == 7.0
    assert unique_or_fail(df.select("k", "v"), ["k", "v"]).count() == 4
    with pytest.raises(ValueError):
        unique_or_fail(df, ["k"])


# ---------------------------------------------------------------- gold job


def write_silver(spark, root, panel):
    write_partitions(panel, f"{root}/price_snapshots")
    upsert_version(f"{root}/coins", scenario_coins(spark), ["id"])


@pytest.mark.parametrize("frame", ["calendar", "rows"])
def test_late_day_is_repaired_by_cascade(spark, tmp_path, frame):
    """Build without one day, add it, rebuild only its range: the result equals a full build."""
    late = before_target(1)
    panel = scenario_panel(spark)
    silver_root, gold_root, fresh = (str(tmp_path / n) for n in ("silver", "gold", "fresh"))
    write_silver(spark, silver_root, panel.where(F.col(DAY) != F.lit(late)))
    jobs.build_gold(spark, silver_root, gold_root, frame=frame)
    write_partitions(panel.where(F.col(DAY) == F.lit(late)), f"{silver_root}/price_snapshots")
    for _ in range(2):  # and a rerun changes nothing
        jobs.build_gold(spark, silver_root, gold_root, (late, late), frame=frame)
        spark.catalog.clearCache()
    jobs.build_gold(spark, silver_root, fresh, frame=frame)
    for name in ("daily_snapshot", "rank_change", "rolling_average"):
        have, want = (spark.read.parquet(f"{r}/{name}") for r in (gold_root, fresh))
        assert rows_of(have) == rows_of(want), name
    jobs.build_serving(spark, silver_root, gold_root, TARGET, expected=2)
    assert spark.read.parquet(f"{gold_root}/latest_snapshot").count() == 3
    with pytest.raises(ValueError, match="no rows"):
        jobs.build_gold(spark, silver_root, gold_root, (TARGET + timedelta(8), TARGET + timedelta(9)), frame=frame)


def test_gold_needs_every_requested_day(spark, tmp_path):
    silver_root, gold_root = str(tmp_path / "silver"), str(tmp_path / "gold")
    write_silver(spark, silver_root, scenario_panel(spark))
    jobs.build_gold(spark, silver_root, gold_root, (before_target(6), TARGET), method="window")
    other = str(tmp_path / "gold-with-gap")
    with pytest.raises(ValueError) as failed:
        jobs.build_gold(spark, silver_root, other, (before_target(8), TARGET), method="window")
    tables = ("daily_snapshot", "price_snapshots", "rank_change", "rolling_average")
    absent = [f"{name} on {before_target(k)}" for k in (8, 7) for name in tables]
    assert str(failed.value) == "no rows: " + ", ".join(absent)
    # All three tables hold the days that the panel has.
    for name in ("daily_snapshot", "rank_change", "rolling_average"):
        assert rows_of(spark.read.parquet(f"{other}/{name}")) == rows_of(spark.read.parquet(f"{gold_root}/{name}")), name
    with pytest.raises(ValueError, match="end is before start"):
        jobs.build_gold(spark, silver_root, gold_root, (TARGET, before_target(1)))


def test_malformed_time_with_a_good_date(spark):
    raw = spark.createDataFrame(
        [("a", "1.5", "noon", f"{START}T00:00:00.000Z"), ("a", "2.5", "noon", None)], "coin_id string, priceUsd string, time string, date string"
    )
    assert [(r[DAY], r.price_usd) for r in history.clean_asset_history(raw).collect()] == [(START, 1.5)]


def test_versions_stay_few_and_only_complete_ones_count(spark, tmp_path):
    path = str(tmp_path / "coins")
    for _ in range(5):
        upsert_version(path, scenario_coins(spark), ["id"])
    assert sorted(p.name for p in (tmp_path / "coins").iterdir()) == ["version=3", "version=4", "version=5"]
    (tmp_path / "coins" / "version=6").mkdir()  # a writer that died
    assert read_version(spark, path).count() == 3
    upsert_version(path, scenario_coins(spark), ["id"])
    assert (tmp_path / "coins" / "version=7").exists()


def test_merge_source_is_computed_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)
    rows = panel_of(spark, [("a", START, 1, 1, 1), ("b", START, 2, 2, 2)])

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    counted = rows.coalesce(1).mapInPandas(count, rows.schema)
    write_partitions(rows, str(tmp_path / "t"))
    merge_partitions(str(tmp_path / "t"), counted, KEY)
    assert seen.value == 2


def test_provenance_survives_the_landed_files(spark, tmp_path):
    rows = raw_rows(spark, asset()).withColumn("api_timestamp_ms", F.lit(5).cast("long")).withColumn(
        "fetched_at_utc", F.lit(datetime(2025, 8, 9, 0, 30)).cast("timestamp")
    )
    write_snapshots(rows, str(tmp_path))
    found = snapshots.provenance(snapshots.read_snapshots(spark, str(tmp_path))).collect()
    assert [(r[DAY], r.api_timestamp_ms) for r in found] == [(LANDED, 5)]
