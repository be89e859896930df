"""Time the headline queries on one machine and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the number of local threads,
BENCH_QUERIES an optional comma-separated list of query names, BENCH_RUNS (default 2) the runs per query; the best
run counts. Every run builds the query anew and consumes all of its rows.
"""

from __future__ import annotations

import json
import os
import sys
import time

from wardlight.plans.registry import QUERIES
from wardlight.session import build_session

HEADLINE = [
    "scan_events",
    "validate_events",
    "route_events",
    "hourly_event_rate",
    "severity_trend",
    "bed_availability",
    "vaccination_trend",
    "outbreak_risk",
    "outbreak_risk_joined",
    "top_risk",
    "dq_report",
    "alert_feed",
    "alert_cooldown",
    "pipeline_from_raw",
    "bed_warning_report",
    "pipeline_health",
    "chart_event_rate",
    "pipeline_refresh",
    "predictions_refresh",
    "ingest_stream",
    "stream_hourly_rate",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    names = [name for name in os.environ.get("BENCH_QUERIES", "").split(",") if name] or HEADLINE
    spark = build_session(
        "wardlight-bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["hourly_event_rate"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    seconds: dict[str, float] = {}
    for name in names:
        for _ in range(runs):
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            elapsed = time.perf_counter() - started
            seconds[name] = round(min(elapsed, seconds.get(name, elapsed)), 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
