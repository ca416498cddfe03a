"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs to completion once into Spark's ``noop`` sink (full
computation, no driver collection) after one warm-up pass on sf0.001.
Prints one JSON line: total seconds plus per-query seconds.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from gridwise.plans.registry import all_queries  # noqa: E402
from gridwise.session import build_session  # noqa: E402

HEADLINE = [
    "inspections_total_areas",
    "inspections_total",
    "spatial_join_points",
    "spatial_join_two_layers",
    "st_transform",
    "inspection_rounds",
    "explode_rounds",
    "join_concat_key",
    "area_hierarchy",
    "with_row_index",
    "flatten_wide",
    "records_to_table",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    extra = {}
    if os.environ.get("BENCH_EVENT_LOG"):
        # stage and task times for later inspection, written to a scratch folder
        extra = {"spark__eventLog__enabled": "true",
                 "spark__eventLog__dir": os.environ["BENCH_EVENT_LOG"]}
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus, **extra)
    qs = all_queries()
    names = [q for q in HEADLINE if q in qs]
    warm = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(warm):
        for name in names:
            qs[name](spark, warm).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "headline_queries_total_wall",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
