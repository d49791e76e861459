import hashlib
from datetime import date
from pathlib import Path

import pytest

from daygrid.sinks.filecopy import file_plan, relative_files, sync_files


def put(root: Path, day: int, name: str, content: bytes) -> Path:
    path = root / "year=2026" / "month=02" / f"day={day:02d}" / name
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_bytes(content)
    return path


def content(root: Path):
    return {str(p.relative_to(root)): p.read_bytes() for p in root.rglob("*") if p.is_file() and not p.name.startswith(".")}


def report(df):
    return {(r.path.rsplit("/", 2)[-2], r.path.rsplit("/", 1)[-1]): r for r in df.collect()}


@pytest.fixture
def roots(tmp_path):
    captured, local = tmp_path / "captured", tmp_path / "local files"
    put(captured, 3, "a.parquet", b"\x00\xffabc\n" * 1000)
    put(captured, 3, "b.parquet", b"")
    put(captured, 4, "a.parquet", b"day four")
    put(captured, 9, "a b.json", b"{}")
    (captured / "notes.txt").write_bytes(b"no day")
    return captured, local


def test_absent_files_arrive_with_their_bytes_and_once(spark, roots):
    captured, local = roots
    done = report(sync_files(spark, str(captured), str(local)))
    wanted = {k: v for k, v in content(captured).items() if k != "notes.txt" and v}
    assert content(local) == wanted
    assert {r.action for r in done.values()} == {"copied"} and len(done) == 3
    assert done["day=03", "a.parquet"].sha256 == hashlib.sha256(b"\x00\xffabc\n" * 1000).hexdigest()
    assert sync_files(spark, str(captured), str(local)).isEmpty()


def test_torn_copy_is_repaired_and_bounds_hold(spark, roots):
    captured, local = roots
    put(local, 3, "a.parquet", b"\x00\xffabc\n" * 10)
    put(local, 4, "a.parquet", b"day f")
    put(local, 9, "a b.json", b"")
    done = report(sync_files(spark, f"file:{captured}", f"file://{local}", start=date(2026, 2, 4), end=date(2026, 2, 4)))
    assert {k: r.action for k, r in done.items()} == {("day=04", "a.parquet"): "repaired"}
    assert content(local)["year=2026/month=02/day=04/a.parquet"] == b"day four"
    assert len(content(local)["year=2026/month=02/day=03/a.parquet"]) == 60


def test_overwrite_goes_by_bytes_and_removes_stale_files_of_captured_days(spark, roots):
    captured, local = roots
    put(local, 4, "a.parquet", b"DAY FOUR")  # same length, other bytes
    put(local, 9, "a b.json", b"{}")
    put(local, 3, "stale.parquet", b"old")
    put(local, 20, "own.parquet", b"not captured")
    # Day 3 holds a file that was not captured, days 4 and 9 have the captured lengths.
    assert sync_files(spark, str(captured), str(local)).isEmpty()
    done = report(sync_files(spark, str(captured), str(local), overwrite=True))
    assert done["day=04", "a.parquet"].action == "repaired"
    assert done["day=09", "a b.json"].action == "kept"
    assert done["day=03", "stale.parquet"].action == "removed"
    found = content(local)
    assert found.pop("year=2026/month=02/day=20/own.parquet") == b"not captured"
    assert found == {k: v for k, v in content(captured).items() if k != "notes.txt" and v}


def test_no_folder_has_no_files(spark, tmp_path):
    none = relative_files(spark, str(tmp_path / "absent"))
    assert none.isEmpty() and file_plan(none, none, overwrite=True).isEmpty()
    assert sync_files(spark, str(tmp_path / "absent"), str(tmp_path / "target")).isEmpty()
