import shutil
from datetime import timedelta
from pathlib import Path

import pytest

from daygrid.schemas import DAY
from daygrid.streaming import compaction, landing
from tests.helpers import rows_of
from tests.test_streaming import FIRST, at, land

NEXT = FIRST + timedelta(1)


class Table:
    """A stream of one file per micro-batch and its table."""

    def __init__(self, spark, folder):
        self.spark = spark
        self.source, self.sink, self.checkpoint = (str(folder / n) for n in ("src", "sink", "ckpt"))

    def take(self, *rows):
        land(self.spark, self.source, *rows)
        self.schema = self.spark.read.parquet(self.source).schema
        landing.ingest(landing.read_stream(self.spark, self.source, self.schema), self.sink, self.checkpoint)

    def rows(self):
        return rows_of(self.spark.read.parquet(self.sink).drop(landing.BATCH))

    def landed(self):
        return rows_of(self.spark.read.parquet(self.source))

    def batches(self):
        return compaction.batches_by_day(self.spark, self.sink)

    def compact(self, most=1):
        return compaction.compact(self.spark, self.sink, self.checkpoint, self.schema, most)

    def rewrite(self, upto):
        stored = self.spark.read.parquet(self.sink).schema
        return compaction.rewrite(self.spark, self.sink, upto, stored)


@pytest.fixture
def table(spark, tmp_path):
    table = Table(spark, tmp_path)
    for n in range(4):
        rows = [(FIRST, f"a{n}", at(FIRST, n))]
        if n == 2:
            rows.append((NEXT, "b", None))
        table.take(*rows)
    return table


def test_busy_days_become_one_folder_and_later_batches_are_taken_once(table):
    assert table.batches() == {FIRST: [0, 1, 2, 3], NEXT: [2]}
    assert table.compact(4) == [] and table.compact() == [FIRST]
    assert table.batches() == {FIRST: [3], NEXT: [2]} and table.rows() == table.landed()
    assert table.compact() == []
    table.take((FIRST, "late", None))
    assert table.batches()[FIRST] == [3, 4] and table.rows() == table.landed()
    assert len(list(Path(table.sink, f"{DAY}={FIRST}", "ingest_batch=3").glob("*.parquet"))) == 1


def test_batch_that_is_not_committed_is_left_alone_and_may_run_again(table, tmp_path):
    (tmp_path / "ckpt" / "commits" / "3").unlink()
    (tmp_path / "ckpt" / "commits" / ".3.crc").unlink(missing_ok=True)
    assert table.compact() == [FIRST] and table.batches()[FIRST] == [2, 3]
    landing.ingest(landing.read_stream(table.spark, table.source, table.schema), table.sink, table.checkpoint)
    assert table.batches()[FIRST] == [2, 3] and table.rows() == table.landed()


def test_swap_that_stopped_anywhere_is_finished(table, tmp_path):
    waiting = table.rewrite({FIRST: 2, NEXT: 2})
    assert table.rows() == table.landed()  # what waits is not read
    shutil.rmtree(tmp_path / "sink" / f"{DAY}={FIRST}" / "ingest_batch=0")
    shutil.rmtree(tmp_path / "sink" / f"{DAY}={FIRST}" / "ingest_batch=2")
    assert compaction.finish_swaps(table.spark, table.sink) == 1
    assert table.batches() == {FIRST: [2, 3], NEXT: [2]} and table.rows() == table.landed()
    assert compaction.finish_swaps(table.spark, table.sink) == 0
    assert not (tmp_path / waiting).exists()


def test_swap_that_stopped_between_days_is_finished(table, tmp_path):
    waiting = table.rewrite({FIRST: 3, NEXT: 2})
    shutil.rmtree(tmp_path / "sink" / f"{DAY}={NEXT}" / "ingest_batch=2")
    shutil.move(f"{waiting}/{DAY}={NEXT}/ingest_batch=2", tmp_path / "sink" / f"{DAY}={NEXT}")
    assert table.compact() == []
    assert table.batches() == {FIRST: [3], NEXT: [2]} and table.rows() == table.landed()


def test_rows_that_never_became_complete_are_dropped(table):
    waiting = table.rewrite({FIRST: 3})
    (Path(waiting) / compaction.COMPLETE).unlink()
    assert compaction.finish_swaps(table.spark, table.sink) == 0
    assert table.batches()[FIRST] == [0, 1, 2, 3] and table.rows() == table.landed()


def test_no_table_and_bad_bound(spark, tmp_path):
    schema = spark.createDataFrame([], f"{DAY} date, coin_id string").schema
    assert compaction.compact(spark, str(tmp_path / "s"), str(tmp_path / "c"), schema) == []
    with pytest.raises(ValueError):
        compaction.compact(spark, str(tmp_path / "s"), str(tmp_path / "c"), schema, 0)
