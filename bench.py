"""Benchmark the headline queries.

Runs each query fully (Spark's ``noop`` sink: every row is computed, none
is collected) on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` and prints one JSON line. ``BENCH_QUERIES`` (comma
list, or ``all``) selects the queries.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "exception_reports", "breadcrumbs", "sessions", "session_range_join", "identity_links", "event_payload",
    "reject_summary", "session_summary", "idle_sessions", "form_batches", "cap_queue",
    "batch_disposition", "flush_status", "environment_dim", "stack_frames", "sanitize_properties",
    "delivery_order", "audit_ids",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from fleetscope.config import build_session
    from fleetscope.plans.queries import QUERIES, forget_plans
    from fleetscope.plans.stage import staging

    sel = os.environ.get("BENCH_QUERIES", "")
    names = sorted(QUERIES) if sel == "all" else ([s for s in sel.split(",") if s] or HEADLINE)
    extra = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")}
    if os.environ.get("BENCH_ADVISORY"):
        extra["spark.sql.adaptive.advisoryPartitionSizeInBytes"] = os.environ["BENCH_ADVISORY"]
    spark = build_session(f"local[{cpus}]", app_name="fleetscope-bench", shuffle_partitions=int(cpus) * 2, **extra)
    # Warm-up: JVM, parquet footers and code paths.
    QUERIES["call_log"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    for n in names:
        forget_plans()
        with staging(spark):
            t0 = time.perf_counter()
            QUERIES[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[n] = round(time.perf_counter() - t0, 3)
    total = round(sum(times.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": times,
                      "sf": float(sf) if sf.replace(".", "").isdigit() else sf}))
    spark.stop()


if __name__ == "__main__":
    main()
