from datetime import date, datetime, timedelta

import pytest

from daygrid.schemas import DAY
from daygrid.streaming import landing
from tests.helpers import rows_of

FIRST = date(2026, 7, 1)


def land(spark, path, *rows):
    df = spark.createDataFrame(rows, f"{DAY} date, coin_id string, fetched_at_utc timestamp")
    df.write.mode("append").partitionBy(DAY).parquet(path)


def at(day, hours):
    return datetime(day.year, day.month, day.day) + timedelta(hours=hours)


def test_each_file_is_taken_once_and_later_files_of_a_day_are_added(spark, tmp_path):
    source, sink, checkpoint = (str(tmp_path / n) for n in ("src", "sink", "ckpt"))
    land(spark, source, (FIRST, "a", at(FIRST, 1)), (FIRST + timedelta(1), "b", at(FIRST, 25)))
    schema = spark.read.parquet(source).schema

    def run():
        landing.ingest(landing.read_stream(spark, source, schema, max_files=1), sink, checkpoint)
        return rows_of(spark.read.parquet(sink).drop(landing.BATCH))

    first = run()
    assert len(first) == 2 and run() == first
    land(spark, source, (FIRST, "c", at(FIRST, 2)))
    assert len(run()) == 3
    batches = spark.read.parquet(sink).select(landing.BATCH).distinct().count()
    assert batches == 3


def test_late_captures_go_to_quarantine(spark, tmp_path):
    source, good, late, checkpoint = (str(tmp_path / n) for n in ("src", "good", "late", "ckpt"))
    land(
        spark, source,
        (FIRST, "ok", at(FIRST, 36)), (FIRST, "late", at(FIRST, 37)), (FIRST, "early", at(FIRST, -1)), (FIRST, "unknown", None),
    )
    schema = spark.read.parquet(source).schema
    landing.route_late(landing.read_stream(spark, source, schema), good, late, checkpoint)
    assert {r.coin_id for r in spark.read.parquet(good).collect()} == {"ok", "unknown"}
    assert {r.coin_id for r in spark.read.parquet(late).collect()} == {"late", "early"}


def test_daily_panel_waits_for_the_watermark(spark, tmp_path):
    source, sink, checkpoint = (str(tmp_path / n) for n in ("src", "sink", "ckpt"))

    def events(*rows):
        df = spark.createDataFrame(rows, "ts timestamp, user string, value double")
        df.write.mode("append").parquet(source)

    def run():
        schema = spark.read.parquet(source).schema
        panel = landing.daily_panel(landing.read_stream(spark, source, schema), "ts", "user", "value")
        landing.write_daily_panel(panel, sink, checkpoint)
        return {(r[DAY], r.user): (r.event_count, r.price_usd, r.market_cap_usd) for r in spark.read.parquet(sink).collect()}

    second, third = FIRST + timedelta(1), FIRST + timedelta(2)
    events((at(FIRST, 1), "u", 1.5), (at(FIRST, 2), "u", 2.5), (at(second, 1), "u", 9.0), (at(third, 1), "u", 1.0))
    assert run() == {(FIRST, "u"): (2, 2.5, 4.0)}
    events((at(second, 3), "u", 1.0), (at(third, 30), "u", 5.0))
    assert run() == {(FIRST, "u"): (2, 2.5, 4.0), (second, "u"): (2, 9.0, 10.0)}
    events((at(FIRST, 5), "u", 100.0))  # too late: its day is closed
    assert run()[FIRST, "u"] == (2, 2.5, 4.0)


def test_daily_panel_sums_small_and_large_values(spark, tmp_path):
    source, sink, checkpoint = (str(tmp_path / n) for n in ("src", "sink", "ckpt"))
    rows = [(at(FIRST, 1), "u", 0.0000123), (at(FIRST, 2), "u", 0.004), (at(FIRST, 1), "v", 1e17), (at(FIRST, 80), "u", 1.0)]
    spark.createDataFrame(rows, "ts timestamp, user string, value double").write.parquet(source)
    panel = landing.daily_panel(landing.read_stream(spark, source, spark.read.parquet(source).schema), "ts", "user", "value")
    landing.write_daily_panel(panel, sink, checkpoint)
    sums = {r.user: r.market_cap_usd for r in spark.read.parquet(sink).collect()}
    assert sums == {"u": pytest.approx(0.0040123), "v": 1e17}


def test_rows_of_closed_days_repair_them(spark, tmp_path):
    source, sink, checkpoint = (str(tmp_path / n) for n in ("src", "sink", "ckpt"))
    second, third = FIRST + timedelta(1), FIRST + timedelta(2)

    def run(*rows):
        spark.createDataFrame(rows, "ts timestamp, user string, value double").coalesce(1).write.mode("append").parquet(source)
        stream = landing.read_stream(spark, source, spark.read.parquet(source).schema)
        landing.accumulate_panel(stream, "ts", "user", "value", sink, checkpoint)
        panel = landing.accumulated_panel(spark, sink, "user")
        return {(r[DAY], r.user): (r.event_count, r.late_event_count, r.price_usd, r.market_cap_usd) for r in panel.collect()}

    run((at(FIRST, 1), "u", 1.5), (at(FIRST, 2), "u", 2.5), (at(second, 1), "u", 9.0), (None, "u", 7.0))
    run((at(second, 3), "u", 1.0), (at(third, 30), "u", 5.0))
    # The first and second day are closed now; late rows count in them all the same.
    found = run((at(FIRST, 5), "u", 100.0), (at(second, 5), "v", 3.0), (at(third, 31), "u", 1.0))
    assert found == {
        (FIRST, "u"): (3, 1, 100.0, 104.0), (second, "u"): (2, 0, 9.0, 10.0), (second, "v"): (1, 1, 3.0, 3.0),
        (third + timedelta(1), "u"): (2, 0, 5.0, 6.0),
    }
    # A batch repeated after a failure before its commit replaces what it had written.
    (tmp_path / "ckpt" / "commits" / "2").unlink()
    for crc in (tmp_path / "ckpt" / "commits").glob(".2*"):
        crc.unlink()
    stream = landing.read_stream(spark, source, spark.read.parquet(source).schema)
    landing.accumulate_panel(stream, "ts", "user", "value", sink, checkpoint)
    panel = landing.accumulated_panel(spark, sink, "user").collect()
    assert {(r[DAY], r.user): (r.event_count, r.late_event_count, r.price_usd, r.market_cap_usd) for r in panel} == found


def test_scratch_folder_is_shared_by_the_session(spark):
    from daygrid import session

    assert session.scratch_dir(spark, "x").startswith(session.scratch_root(spark))
    assert session.scratch_root(spark) == spark.conf.get("spark.checkpoint.dir").rstrip("/")

    class Unset:
        class conf:
            get = staticmethod(lambda key, default=None: "hdfs://shared/warehouse" if "warehouse" in key else default)

    assert session.scratch_root(Unset).startswith("hdfs://shared/warehouse/")
