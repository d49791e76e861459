"""Run registered queries against their SQL counterparts: ``run_oracles.py [folder] [name part ...]``."""

from __future__ import annotations

import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

import __spark_entry__ as spark_entry  # noqa: E402
from tests.compare import connect, differences  # noqa: E402


def main() -> int:
    root = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    parts = sys.argv[2:]
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", os.environ.get("SCRATCH_DIR") or tempfile.mkdtemp(prefix="run-"))
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    con = connect(root)
    oracles, failed = spark_entry.oracle_sql(), 0
    for name, build in spark_entry.queries().items():
        if parts and not any(p in name for p in parts):
            continue
        start = time.time()
        try:
            df = build(spark, root)
            if name in oracles:
                problem = differences(df, con, oracles[name])
                note = f"{con.execute('select count(*) from (' + oracles[name] + ')').fetchone()[0]} rows"
            else:
                problem, note = None, f"{df.count()} rows, no SQL"
        except Exception as error:  # noqa: BLE001
            problem, note = f"{type(error).__name__}: {str(error)[:900]}", ""
        failed += problem is not None
        print(f"{'FAIL' if problem else 'ok  '} {name} {time.time() - start:.1f}s {note} {problem or ''}", flush=True)
    print(f"{failed} failed")
    return 1 if failed else 0


if __name__ == "__main__":
    sys.exit(main())
