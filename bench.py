"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data
and cores. Each query runs once to warm up, then three times into a sink that keeps
nothing; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from lanewise.plans.queries import QUERIES
from lanewise.session import build_session

HEADLINE = [
    "daily_datapoints",
    "datapoint_cost",
    "lane_prices_ports",
    "lane_prices_regions",
    "lane_prices_regions_wide",
    "prices",
    "crowded_median",
    "validate_datapoints",
    "stage_charges",
    "datapoint_versions",
    "active_datapoints",
    "region_ancestors",
]
RUNS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "lanewise-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="lanewise-bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        times = []
        for _ in range(RUNS + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, warm, median of 3",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
