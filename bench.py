"""Benchmark: run the headline queries at one scale factor, print one JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Each query is executed fully into Spark's ``noop`` sink (no driver collect).
The derived tables are written once (as the ETL would) and one untimed pass
over all queries warms the JVM and code generation; then three timed passes
follow and each query reports its median (single local runs jitter by 30%+).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fuelsight.plans.catalog import QUERIES  # noqa: E402
from fuelsight.session import local_session  # noqa: E402

HEADLINE = [
    "daily_kpis",
    "km_kpis",
    "total_fuel_km",
    "aircon_rate",
    "other_fuel_day",
    "other_fuel_km",
    "lifetime_totals",
    "after_checkpoint",
    "cost_per_km",
    "average_speed",
    "fuel_heating",
    "fill_kpis",
    "economy_ranking",
    "assign_fill_interval",
    "assign_fill_interval_asof",
    "low_fuel_windows",
    "fuel_summary",
    "refuel_events_steps",
    "refuel_events",
    "drop_future_readings",
    "read_range",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, partitions=int(cpus) if cpus.isdigit() else 8, app="fuelsight-bench")
    spark.sparkContext.setLogLevel("ERROR")
    for name in HEADLINE:  # warm-up pass, not timed
        run(QUERIES[name](spark, sf_dir))
    samples: dict[str, list[float]] = {name: [] for name in HEADLINE}
    for _ in range(int(os.environ.get("BENCH_REPEAT", "3"))):
        for name in HEADLINE:
            t0 = time.perf_counter()
            run(QUERIES[name](spark, sf_dir))
            samples[name].append(time.perf_counter() - t0)
    times = {name: round(statistics.median(v), 3) for name, v in samples.items()}
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
