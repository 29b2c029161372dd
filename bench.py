"""Headline query timings: one JSON line on standard output.

Reads ``BENCH_SF_DIR`` and ``BENCH_CPUS``. Every query gets one warm-up run on the
same data and is then timed; its result is written to the no-op sink, so that all
rows and columns are computed. Short queries count with the median of three runs. Streams
are timed once, without a warm-up; ``streams`` has their rows, rows per second, state bytes and
rows dropped as late.
"""

from __future__ import annotations

import json
import os
import sys
import time
from statistics import median

from pyspark.sql import SparkSession

from stockflow.queries import QUERIES
from stockflow.storage import set_shared_folder
from stockflow.streaming.progress import Progress

SF_DIR = os.getenv("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.getenv("BENCH_CPUS", "8")

BATCH = [
    "parse_events",
    "invalid_reason_counts",
    "net_movement_by_day",
    "sales_velocity_5m",
    "state_history",
    "current_inventory",
    "alerts",
    "promotion_metrics",
    "promotion_window",
    "latest_state_by_day",
    "reconciliation",
    "daily_summary",
    "monthly_summary",
    "merge_daily_summary",
]
LONG = 6.0  # seconds of a query that is run once
STREAMS = ["stream_silver", "stream_velocity", "stream_state"]


def run(spark: SparkSession, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("stockflow-bench")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    set_shared_folder(spark)
    seconds = {}
    for name in BATCH:
        run(spark, name)
        times = [run(spark, name)]
        if times[0] < LONG:
            times += [run(spark, name) for _ in range(2)]
        seconds[name] = round(median(times), 3)
        print(name, seconds[name], file=sys.stderr)
    progress = Progress()
    spark.streams.addListener(progress)
    for name in STREAMS:
        seconds[name] = round(run(spark, name), 3)
        print(name, seconds[name], file=sys.stderr)
    streams: dict[str, dict] = {}
    for name, _, rows, speed, _, state, late in progress.records():
        one = streams.setdefault(name, {"rows": 0, "rows_per_second": 0.0, "state_bytes": 0, "late": 0})
        one["rows"] += rows
        one["rows_per_second"] = round(max(one["rows_per_second"], speed), 1)
        one["state_bytes"] = max(one["state_bytes"], state)
        one["late"] += late
    print(
        json.dumps(
            {
                "streams": streams,
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
