"""Benchmark: run every driver query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full into the ``noop`` sink (no collect to the driver), once
after a warm-up; prints one JSON line with per-query seconds and their sum."""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stationlink.plans import QUERIES  # noqa: E402
from stationlink.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [a for a in sys.argv[1:] if a in QUERIES]
    spark = build_session(f"local[{cpus}]", app="stationlink-bench", shuffle_partitions=max(cpus, 8),
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")})
    # warm-up: every query once on the smallest scale (JVM JIT, codegen and ML code
    # paths), then the timed pass at the bench scale
    warm_dir = os.environ.get("BENCH_WARM_DIR", "/root/testdata/sf0.001")
    for name, fn in QUERIES.items():
        if not only or name in only:
            fn(spark, warm_dir).write.format("noop").mode("overwrite").save()
    times = {}
    for name, fn in QUERIES.items():
        if only and name not in only:
            continue
        t0 = time.perf_counter()
        fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
