"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from daybook import build_session, catalog

HEADLINE = (
    "strength_metrics",
    "ewma_by_metric",
    "volume_ewma",
    "interval_enrich",
    "ordered_rule_override",
    "heatmap_series",
    "heatmap_push_pull",
    "label_rollup",
    "goal_count_progress",
    "weight_series",
    "diary_clean",
    "tidy_scores",
)
RUNS = 3


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "daybook-bench", f"local[{cpus}]",
        **{"spark.sql.shuffle.partitions": cpus, "spark.ui.enabled": "false", "spark.driver.memory": "8g",
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[1:] or HEADLINE
    seconds = {}
    for name in wanted:
        query = catalog.queries()[name]
        times = []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            query(spark, folder).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    print(json.dumps({
        "metric": "headline queries, sum of medians after one warm-up",
        "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"), "runs": RUNS,
        "cpus": int(cpus), "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
