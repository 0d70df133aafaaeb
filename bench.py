"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

The metering tables are first ingested once into year/month-partitioned
Parquet (timed as ``ingest``), then each headline query runs over the stored
tables: one warm-up, then the median of 3 timed runs.  A query is forced to
completion with the ``noop`` sink (every row computed, nothing collected).
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "daily_consumption",
    "monthly_consumption",
    "tariff_zone_analysis",
    "specific_consumption",
    "baseline_comparison",
    "anomaly_detection",
    "load_factor_analysis",
    "hourly_profile",
    "solar_battery_balance",
    "level_2_consumption",
    "level_3_consumption",
    "daily_meter_summary",
    "build_baseline",
    "daily_metrics",
    "detect_anomalies",
    "cumulative_totalizer",
    "top_anomalies",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    per_site = int(os.environ.get("BENCH_SUPPLIERS_PER_SITE", "4"))  # spread the same readings over more or fewer sites
    from meterframe.plans import registry
    from meterframe.plans.catalog import QUERY_FNS, finish
    from meterframe.session import local_session
    from meterframe.sources.fixtures import MeterTables
    from meterframe.sources.io import scratch_path
    from meterframe.sources.store import materialize

    spark = local_session(cores=cpus, shuffle_partitions=cpus, app="meterframe-bench")
    registry.all_queries()
    root = scratch_path(spark, "bench-tables", sf_dir)  # fresh folder under spark.checkpoint.dir
    t0 = time.time()
    stored = materialize(MeterTables(spark, sf_dir, per_site=per_site), root=root)
    ingest = time.time() - t0

    def run(name: str) -> float:
        s = time.time()
        finish(QUERY_FNS[name](stored)).write.format("noop").mode("overwrite").save()
        return time.time() - s

    times = {}
    for name in HEADLINE:
        run(name)
        times[name] = round(statistics.median(run(name) for _ in range(runs)), 3)
    total = round(sum(times.values()), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": total,
                "unit": "sec",
                "queries": times,
                "ingest_sec": round(ingest, 3),
                "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
                "cpus": cpus,
                "suppliers_per_site": per_site,
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
