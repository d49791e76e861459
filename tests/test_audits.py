"""Dates, inventories, provenance, governance, bounded results, checks."""

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from daygrid.functions import dates, text
from daygrid.operators import bounded, compare, reach
from daygrid.operators.spine import calendar
from daygrid.plans import checks, dashboards, governance, provenance
from daygrid.schemas import DAY, document
from daygrid.sources import browse, inventory
from tests.helpers import TARGET, before_target, by_key, panel_of, rows_of, scenario_panel

D = date(2026, 7, 28)


def days_frame(spark, *days):
    return spark.createDataFrame([(d,) for d in days], f"{DAY} date")


def days_in(df):
    return sorted(r[DAY] for r in df.collect())


# ---------------------------------------------------------------- dates


def test_ranges():
    assert dates.span_of(None, None) is None
    assert dates.span_of(D, D) == (D, D)
    assert dates.span_of(D, D + timedelta(4000)) == (D, D + timedelta(4000))
    for start, end, cap in ((D, None, None), (None, D, None), (D, D - timedelta(1), None), (D, D + timedelta(9), 9)):
        with pytest.raises(ValueError):
            dates.span_of(start, end, cap)


def test_backfill_window():
    assert dates.backfill_window(date(2025, 3, 2), 30) == (date(2025, 1, 31), date(2025, 3, 1))
    with pytest.raises(ValueError):
        dates.backfill_window(D, 0)


def test_epoch_bounds_and_event_dates(spark):
    row = days_frame(spark, date(2026, 1, 14)).select(
        dates.day_start_ms(F.col(DAY)).alias("a"), dates.day_end_ms(F.col(DAY)).alias("b")
    ).first()
    assert (row.a, row.b) == (1768348800000, 1768348800000 + 86_400_000 - 1)
    df = spark.createDataFrame(
        [("2026-01-14T23:59:59.999Z", None), (None, row.b), ("nonsense", row.a), (None, None), (None, -1)], "t string, ms long"
    )
    found = [r[0] for r in df.select(dates.event_date(F.col("t"), F.col("ms"))).collect()]
    assert found == [date(2026, 1, 14)] * 3 + [None, date(1969, 12, 31)]


def test_id_lists(spark):
    df = spark.createDataFrame([('["a", " b ", ""]',), (" a, ,b,",), ("solo",), ("",)], "raw string")
    assert [r[0] for r in df.select(text.id_list(F.col("raw"))).collect()] == [["a", "b"], ["a", "b"], ["solo"], []]


# ---------------------------------------------------------------- inventories


def test_dates_from_paths(spark):
    paths = ["x/year=2026/month=07/day=28/a.parquet", "x/year=2026/month=07/day=28/b.parquet", "x/readme.txt",
             "x/year=2026/month=13/day=40/a.parquet", "x/year=26/month=07/day=28/a.parquet"]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    assert days_in(inventory.dates_from_paths(df)) == [D]


def test_inventory_of_real_files(spark, tmp_path):
    for day in (D, D + timedelta(1)):
        spark.range(1).write.parquet(f"{tmp_path}/year={day:%Y}/month={day:%m}/day={day:%d}")
    files = inventory.list_files(spark, str(tmp_path))
    assert days_in(inventory.dates_from_paths(files)) == [D, D + timedelta(1)]


def test_sync_plan(spark):
    captured = days_frame(spark, D, D, D + timedelta(1), D + timedelta(2))
    local = days_frame(spark, D + timedelta(1))
    assert days_in(inventory.sync_plan(captured, local)) == [D, D + timedelta(2)]
    assert days_in(inventory.sync_plan(captured, local, start=D + timedelta(1))) == [D + timedelta(2)]
    assert days_in(inventory.sync_plan(captured, local, end=D)) == [D]
    assert days_in(inventory.sync_plan(captured, local, overwrite=True)) == [D + timedelta(i) for i in range(3)]
    assert days_in(inventory.sync_plan(captured, captured)) == []
    many = calendar(spark, D, D + timedelta(20))
    with pytest.raises(ValueError, match="more than 20"):
        inventory.within_cap(inventory.sync_plan(many, local, overwrite=True), 20)
    assert inventory.within_cap(inventory.sync_plan(many, local), 20).count() == 20


@pytest.mark.parametrize("age,limit,status", [(0, 2, "fresh"), (2, 2, "fresh"), (3, 2, "stale"), (9, 0, "disabled")])
def test_freshness(spark, age, limit, status):
    captured = days_frame(spark, D, D - timedelta(5))
    row = inventory.freshness(captured, D + timedelta(age), limit).first()
    assert (row.newest_date, row.age_days, row.status) == (D, age, status)


def test_freshness_of_nothing_raises(spark):
    nothing = days_frame(spark, D).where("false")
    assert inventory.freshness(nothing, D).first().status == "empty"
    with pytest.raises(RuntimeError):
        inventory.require_fresh(nothing, D)
    inventory.require_fresh(days_frame(spark, D), D)


# ---------------------------------------------------------------- provenance


def files(spark):
    late, twice = D + timedelta(4), [D + timedelta(9), D + timedelta(10)]
    fetched_twice = datetime(D.year, D.month, D.day, 21, 6) + timedelta(12)
    rows = [
        (D, 31, datetime(D.year, D.month, D.day, 3, 12)), (D, 32, datetime(D.year, D.month, D.day, 23, 50)),
        (late, 33, datetime(late.year, late.month, late.day, 1, 15) + timedelta(2)), *((d, 640, fetched_twice) for d in twice),
        (D, 34, datetime(D.year, D.month, D.day, 21, 0) - timedelta(1)), (D + timedelta(11), 35, None), (D - timedelta(3), None, None),
    ]
    return spark.createDataFrame(rows, f"{DAY} date, api_timestamp_ms long, fetched_at_utc timestamp")


def test_mislabelled(spark):
    found = {(r[DAY], round(r.lag_hours, 2)): r.reason for r in provenance.mislabelled(files(spark)).collect()}
    assert found == {
        (D + timedelta(4), 49.25): "late", (D, -3.0): "early", (D + timedelta(9), 93.1): "late", (D + timedelta(10), 69.1): "late"
    }
    one = spark.createDataFrame([(D, 1, datetime(D.year, D.month, D.day, 4) + timedelta(1))], files(spark).schema)
    assert provenance.mislabelled(one, 29).count() == 0 and provenance.mislabelled(one, 27).count() == 1


def test_duplicates_and_coverage(spark):
    rows = provenance.duplicate_fetches(files(spark)).collect()
    assert [(r.api_timestamp_ms, r.dates) for r in rows] == [(640, [D + timedelta(9), D + timedelta(10)])]
    row = provenance.provenance_coverage(files(spark)).first()
    assert (row.known_count, row.total_count, row.unknown_count, row.earliest_auditable_date) == (7, 8, 1, D)
    assert not provenance.audit_clean(files(spark))


# ---------------------------------------------------------------- governance


def test_quota(spark):
    base = datetime(2026, 1, 1)
    rows = [("r1", "fast", base + timedelta(minutes=i), i) for i in range(5)]
    rows += [("r1", "thorough", base + timedelta(seconds=30), 90)]  # a request may not change its profile
    rows += [("r2", "thorough", base + timedelta(minutes=i), 100 + i) for i in range(12)]
    rows += [("bad id!", "fast", base, 200), ("r3", "slow", base, 201)]
    log = spark.createDataFrame(rows, "request_id string, profile string, ts timestamp, call_id long")
    admitted = governance.admitted_calls(log)
    by_request = {}
    for r in admitted.orderBy("used").collect():
        by_request.setdefault(r.request_id, []).append((r.call_id, r.used, r.remaining))
    assert by_request["r1"] == [(0, 1, 2), (1, 2, 1), (2, 3, 0)]
    assert [u for _, u, _ in by_request["r2"]] == list(range(1, 11))
    assert set(by_request) == {"r1", "r2"}
    usage = by_key(governance.quota_usage(log), "request_id")
    assert (usage["r1"].refused_count, usage["r3"].admitted_count) == (3, 0)
    assert "WindowGroupLimit" in admitted._jdf.queryExecution().executedPlan().toString()


def test_lineage(spark):
    edges = spark.createDataFrame(
        [("src", "daily"), ("daily", "latest"), ("daily", "avail"), ("latest", "avail"), ("avail", "src"), ("avail", "far")],
        "parent string, child string",
    )

    def found(*args):
        return {r.node: r.distance for r in reach.reachable(edges, *args).collect()}

    assert found("src", "downstream", 1) == {"daily": 1}
    assert found("src", "downstream", 5) == {"daily": 1, "latest": 2, "avail": 2, "far": 3}
    assert found("latest", "upstream", 2) == {"daily": 1, "src": 2}
    assert found("unknown", "downstream", 3) == {}
    for bad in (0, 6, True):
        with pytest.raises(ValueError):
            reach.reachable(edges, "src", "downstream", bad)
    with pytest.raises(ValueError):
        reach.reachable(edges, "src", "sideways", 1)


def test_schema_drift(spark):
    documented = spark.createDataFrame([("COIN_ID",), ("gone",)], "field string")
    df = spark.createDataFrame([("a", 1)], "coin_id string, extra int")
    found = {r.field: r.finding for r in governance.schema_drift(df, documented).collect()}
    assert found == {"extra": "undocumented", "gone": "stale documentation"}


# ---------------------------------------------------------------- bounded results and comparisons


def test_bounded(spark):
    df = spark.range(7).toDF("x")
    for cap, rows, cut in ((5, 5, True), (7, 7, False), (9, 7, False)):
        result = bounded.bounded(df, ["x"], cap).collect()
        assert [r.x for r in result] == list(range(rows)) and {r.truncated for r in result} == {cut}
    for bad in (0, 501, True, "5"):
        with pytest.raises(ValueError):
            bounded.bounded(df, ["x"], bad)
    with pytest.raises(ValueError):
        bounded.sample(df, ["x"], 21)
    assert bounded.sample(df, [F.desc("x")], 2).collect()[0].x == 6
    with pytest.raises(ValueError):
        bounded.checked_result(df, ["y"], False)
    with pytest.raises(ValueError):
        bounded.checked_result(df.where("false"), ["x"], True)


def test_frames_diff(spark):
    a = spark.createDataFrame([("x", 1.0), ("x", 1.0), ("y", None), ("z", 0.1 + 0.2)], "k string, v double")
    b = spark.createDataFrame([("x", 1.0), ("y", None), ("z", 0.3), ("w", 2.0)], "other string, w double")
    found = {(r.k, r.side): r.copies for r in compare.frames_diff(a, b, digits=9).collect()}
    assert found == {("x", "left"): 1, ("w", "right"): 1}
    assert compare.frames_diff(a, a).count() == 0
    assert compare.frames_diff(a, b).where("k = 'z'").count() == 2
    with pytest.raises(ValueError):
        compare.frames_diff(a, b.select("other"))


def test_browse(spark):
    browse.register(document(scenario_panel(spark)), "panel_view")
    described = by_key(browse.describe_panel(spark.table("panel_view")), "column_name")
    assert described["price_usd"].value_count == 19 and described["vwap_24hr"].value_count == 0
    assert described["price_usd"].comment.startswith("Price")
    assert browse.query_sql(spark, "SELECT count(*) AS n FROM panel_view").first().n == 19
    assert browse.table_distinct_values(spark, "panel_view", "coin_id", 2).count() == 2
    assert browse.count_table(spark, "panel_view").first().row_count == 19
    assert browse.table_date_range(spark, "panel_view").first().max_date == TARGET
    assert browse.table_null_summary(spark, "panel_view", ["vwap_24hr"]).first().vwap_24hr_nulls == 19
    assert browse.preview_table(spark, "panel_view", 3).count() == 3
    assert browse.list_tables(spark).where("tableName = 'panel_view'").count() == 1
    assert browse.list_namespaces(spark).count() >= 1
    assert browse.describe_table(spark, "panel_view").count() == 7
    spark.catalog.dropTempView("panel_view")


# ---------------------------------------------------------------- checks and key figures


def availability_frame(spark, statuses, start=D):
    rows = [(start + timedelta(i), s) for i, s in enumerate(statuses)]
    return spark.createDataFrame(rows, f"{DAY} date, availability_status string")


@pytest.mark.parametrize(
    "statuses,streak", [("aaa", 3), ("apa", 1), ("aam", 0), ("m", 0), ("maa", 2)]
)
def test_streak(spark, statuses, streak):
    names = {"a": "available", "p": "partial", "m": "missing"}
    table = availability_frame(spark, [names[s] for s in statuses] + ["missing"])  # today is empty
    today = D + timedelta(len(statuses))
    assert dashboards.available_streak(table, today).first()[0] == streak
    last = max((i for i, s in enumerate(statuses) if s != "m"), default=None)
    want = None if last is None else len(statuses) - last
    assert dashboards.freshness_days(table, today).first()[0] == want
    assert dashboards.coverage_30d(table, today).first()[0] == round(100 * statuses.count("a") / 30, 1)


def test_missing_input_and_contiguous(spark):
    present = days_frame(spark, D, D + timedelta(2))
    assert days_in(checks.missing_input_dates(present, (D, D + timedelta(2)))) == [D + timedelta(1)]
    row = checks.calendar_contiguous(present).first()
    assert (row[DAY], row.previous_date) == (D + timedelta(2), D)
    assert checks.calendar_contiguous(calendar(spark, D, D + timedelta(3))).count() == 0


def test_serving_tables_line_up_on_days_of_any_table(spark):
    a, b, c = (panel_of(spark, [("x", D + timedelta(i), 1, 1, 1)]) for i in (0, 1, 1))
    found = by_key(checks.serving_models_agree(a, b, c), DAY)
    assert set(found) == {D, D + timedelta(1)}
    late = found[D + timedelta(1)]
    assert (late.daily_snapshot_row_count, late.rank_change_row_count, late.weekly_average_row_count) == (None, 1, 1)


def test_gap_and_duplicate_checks(spark):
    columns = "snapshot_date date, coin_id string, price_usd double, prev_price_usd double, price_change_pct double, price_change_rank int"
    flat = [(D, f"c{i}", 1.0, 1.0, 0.0, 1) for i in range(5)]
    few = [(D + timedelta(5), f"c{i}", 1.0, 1.0, 0.0, 1) for i in range(4)]
    daily = spark.createDataFrame([*flat, *few, (D, "new", 1.0, None, 3.0, None)], columns)
    assert days_in(checks.duplicate_fetch_dates(daily)) == [D]
    assert days_in(checks.unchanged_days(daily)) == [D + timedelta(5)]
    assert [r.coin_id for r in checks.gap_values_null(daily).collect()] == ["new"]
    checks.require_rows({"daily": daily}, days_frame(spark, D, D + timedelta(5)))
    with pytest.raises(ValueError, match="daily"):
        checks.require_rows({"daily": daily}, days_frame(spark, D, D + timedelta(1)))
    assert rows_of(checks.accepted_values(daily, "coin_id", ["new"]).select("value")) == [(f"c{i}",) for i in range(5)]
