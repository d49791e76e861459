"""Time the headline queries on the supplier-day panel; prints one JSON line.

One warm-up and the median of three runs per query, fully materialised into the noop sink.
Ranks use the library's default; ``*_window`` is the window by day. Building the plan and the rows a rank
stores on the way are part of the time. Availability reads the stored panel and tables, written before its time starts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from daygrid.plans import gold, serving  # noqa: E402
from daygrid.schemas import DAY  # noqa: E402
from daygrid.session import apply_settings  # noqa: E402
from daygrid.sinks.partitions import staged  # noqa: E402
from workload import panels  # noqa: E402

RUNS = 3


def build_queries(spark: SparkSession, root: str):
    def inputs():
        return panels.supplier_panel(spark, root), panels.supplier_dim(spark, root)

    panel, dim = inputs()
    panel = staged(panel, "bench-panel")
    stored = (
        staged(gold.daily_snapshot(panel, dim), "bench-daily"),
        staged(gold.rank_change(panel, dim), "bench-rank"),
        staged(gold.rolling_average(panel, dim), "bench-rolling"),
    )

    def availability():
        end = panel.agg(F.date_add(F.max(DAY), 3)).first()[0]
        return serving.availability(panel, *stored, end)

    return {
        "gold_daily_snapshot_full": lambda: gold.daily_snapshot(*inputs()),
        "gold_daily_snapshot_window": lambda: gold.daily_snapshot(*inputs(), method="window"),
        "gold_rank_change_full": lambda: gold.rank_change(*inputs()),
        "gold_rank_change_window": lambda: gold.rank_change(*inputs(), method="window"),
        "gold_rolling_average_rows": lambda: gold.rolling_average(*inputs(), frame="rows"),
        "gold_rolling_average_calendar": lambda: gold.rolling_average(*inputs(), frame="calendar"),
        "availability_daily": availability,
    }


def seconds(build) -> float:
    start = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "*")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", os.cpu_count() if cpus == "*" else cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "6g"))
        .config("spark.ui.enabled", "false")
        .config("spark.checkpoint.dir", os.environ.get("SCRATCH_DIR") or tempfile.mkdtemp(prefix="run-"))
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    apply_settings(spark)
    times = {}
    for name, build in build_queries(spark, root).items():
        seconds(build)
        times[name] = round(statistics.median(seconds(build) for _ in range(RUNS)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "panel_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(root.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
