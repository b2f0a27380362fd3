"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the data folder, BENCH_CPUS the number of local cores. Every
query runs once to warm the JVM and is then timed to the end of a full
materialisation; nothing is cached between the two runs.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "detections_in_areas",
    "detections_in_split_areas",
    "detections_in_country",
    "events_per_area",
    "event_table",
    "event_extents_below_cutoff",
    "nearest_settlements",
    "nearest_settlements_no_cutoff",
    "detection_numbers",
    "scene_availability",
    "imagery_validation",
    "burnt_regions",
    "detection_mart",
    "event_mart",
    "detection_links",
    "id_set_report",
]


def main() -> None:
    from pyspark.sql import SparkSession

    from emberscope.workload import run

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    names = sys.argv[1:] or HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        # Small data on one machine: keep more than one task per stage.
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        for _ in range(2):
            start = time.perf_counter()
            run(name, spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name:32s} {times[name]:8.2f}", file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
