"""Times the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import time
from collections.abc import Callable

from cartlens.session import local_session
from verification.queries import QUERIES

HEADLINE = [
    "stg_events",
    "int_sessions",
    "int_user_journey",
    "int_product_performance",
    "dim_users",
    "dim_products",
    "dim_date",
    "fct_daily_engagement",
    "fct_funnel",
    "fct_revenue",
    "flat_sessions",
    "flat_daily_metrics",
    "flat_product_performance",
    "sessionize_gap",
    "sessionize_events",
    "validate_events",
    "validity_rate",
    "dq_report",
    "funnel_overall",
    "batch_job_daily_metrics",
]
RUNS = 3


def seconds(action: Callable[[], None]) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, "bench")
    spark.sparkContext.setLogLevel("OFF")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    timings = {}
    for name in names:

        def run(query=QUERIES[name]) -> None:
            query(spark, folder).write.format("noop").mode("overwrite").save()

        run()  # warm-up
        timings[name] = round(statistics.median(seconds(run) for _ in range(RUNS)), 4)
    job = timings.get("batch_job_daily_metrics")
    events = spark.read.parquet(f"{folder}/events.parquet").count()
    report = {
        "metric": "sum of median wall times of the headline queries",
        "value": round(sum(timings.values()), 4),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
        "events": events,
        "batch_job_events_per_sec": round(events / job) if job else None,
    }
    spark.stop()
    print(json.dumps(report))


if __name__ == "__main__":
    main()
