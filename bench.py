"""
Time the headline queries on the tables in $BENCH_SF_DIR and print one JSON line.

Each query is planned and run to completion into the no-op sink, so every output row and
column is produced. One warm-up run, then the median of $BENCH_RUNS runs.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

from tallybrook.plans.catalog import QUERIES
from tallybrook.session import build_session

HEADLINES = (
    "events_project", "events_clean", "events_dead_letter", "edits_dedup",
    "rollup_1m", "rollup_1d", "editors_distinct",
    "timeline_5m", "timeline_1h", "timeline_1d", "top_wikis", "top_editors", "history_tiles",
    "stored_timeline_1h", "stored_top_wikis", "stored_window_latest",
    "window_summary", "window_merged", "window_top_editors", "window_top_editors_slices",
    "window_dense", "window_gap_capped", "late_events", "running_watermark",
    "reconcile_hot_cold", "counter_rate", "histogram_quantile", "alert_states",
)


def run(spark, folder: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINES
    if names == ["all"]:
        names = list(QUERIES)
    spark = build_session("bench", f"local[{cpus}]", {
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "8g"),
    })
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        run(spark, folder, name)
        seconds[name] = round(statistics.median(run(spark, folder, name) for _ in range(runs)), 3)
    spark.stop()
    scale = re.search(r"sf([0-9.]+)", folder)
    print(json.dumps({
        "metric": "headline queries, sum of medians",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(scale.group(1)) if scale else None,
    }))


if __name__ == "__main__":
    main()
