"""Times the headline queries and prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (timed runs per query after one warm-up, default 3; the median counts).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from wearlake.plans.driver_queries import QUERIES  # noqa: E402
from wearlake.session import build_session  # noqa: E402

HEADLINE = (
    "device_wear_days",
    "series_summary",
    "birth_date_qc",
    "convert_acc",
    "convert_eda",
    "csv_round_trip",
    "validate_dictionary",
    "signal_summary",
    "describe_numeric",
    "percentiles_lineitem",
    "sampling_rate",
    "histogram30",
    "box_stats",
    "rolling_band",
    "high_variation",
    "flat_points",
    "file_audit",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "bench",
        spark__master=f"local[{cpus}]",
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "16g"),
        spark__sql__shuffle__partitions=cpus,
        spark__ui__enabled="false",
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        taken = []
        for _ in range(runs + 1):
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(taken[1:]), 3)
    spark.stop()
    total = round(sum(seconds.values()), 3)
    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": float(scale) if scale.replace(".", "", 1).isdigit() else scale,
            }
        )
    )


if __name__ == "__main__":
    main()
