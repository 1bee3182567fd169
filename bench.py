"""Time the headline queries; prints one JSON line.

Each query is written to the `noop` sink: once to warm up, then three times, of
which the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from contrail.plans.registry import QUERIES
from contrail.session import build_session

HEADLINE = [
    "clean_silver",
    "flatten_states",
    "quality_report",
    "country_totals",
    "flight_aggregations",
    "aircraft_activity",
    "altitude_distribution",
    "density_heatmap",
    "country_daily_summary",
    "flight_trajectories",
    "speed_anomalies",
    "top_busiest_countries",
    "anomalies_by_country",
    "kpi_snapshot",
    "upsert_country_totals",
    "feature_matrix",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "contrail-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in HEADLINE:
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]), 3)
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "event_rows": rows,
                "cpus": int(cpus),
            }
        )
    )


if __name__ == "__main__":
    main()
