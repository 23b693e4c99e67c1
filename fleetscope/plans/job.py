"""One batch job over a call log: reconstruct the state once, write every
output from it.

The state scan is the expensive part (one exchange and sort of all calls),
so it runs once and is staged under the shared checkpoint folder; each
output then reads only the columns it needs from the staged table.

    python -m fleetscope.plans.job CALLS_PATH CONFIG_PATH OUT_DIR
"""

from __future__ import annotations

import os
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope import schemas
from fleetscope.functions.core import partition_key
from fleetscope.operators.breadcrumbs import exception_payload, exception_reports
from fleetscope.operators.events import event_payload, reject_summary, track_events
from fleetscope.operators.identity import identity_links
from fleetscope.operators.sessions import build_sessions
from fleetscope.operators.state import reconstruct
from fleetscope.plans.stage import stage, staging
from fleetscope.sources import read_call_log

OUTPUTS = ("events", "exception_reports", "sessions", "identity_links", "refusals")


def _by_app_day(df: DataFrame, ts: str = "ts") -> DataFrame:
    """Rows rebalanced on app and day: one file for a small folder, several
    tasks for a hot one."""
    return (df.withColumn("app_key", partition_key("source_app"))
              .withColumn("event_date", F.to_date(F.col(ts).cast("timestamp_ntz")))
              .hint("rebalance", "app_key", "event_date"))


def run(calls: DataFrame, app_config: DataFrame, out_dir: str, initial_consent: DataFrame | None = None,
        mode: str = "overwrite") -> dict[str, str]:
    """Write all outputs under ``out_dir``; returns output name -> path."""
    paths = {k: os.path.join(out_dir, k) for k in OUTPUTS}
    with staging(calls.sparkSession):
        _write(stage(reconstruct(calls, app_config, initial_consent), "job-state"), paths, mode)
    return paths


def _write(st: DataFrame, paths: dict[str, str], mode: str) -> None:
    ev = event_payload(track_events(st))
    (_by_app_day(ev).select("app_key", "event_date", "install_id", "seq", "event_id", "payload_json")
        .write.mode(mode).partitionBy("app_key", "event_date").parquet(paths["events"]))

    rep = exception_payload(exception_reports(st))
    (_by_app_day(rep).select("app_key", "event_date", "install_id", "seq", "exception_id", "severity",
                             "payload_json")
        .write.mode(mode).partitionBy("app_key", "event_date").parquet(paths["exception_reports"]))

    (_by_app_day(build_sessions(st), "started_ts").drop("epoch")
        .write.mode(mode).partitionBy("app_key", "event_date").parquet(paths["sessions"]))

    identity_links(st).write.mode(mode).parquet(paths["identity_links"])
    reject_summary(st).write.mode(mode).parquet(paths["refusals"])


def main(argv: list[str]) -> None:
    from fleetscope.config import build_session
    calls_path, config_path, out_dir = argv[1:4]
    spark: SparkSession = build_session(app_name="fleetscope-job")
    calls, rejects = read_call_log(spark, calls_path, "json" if calls_path.rstrip("/").endswith((".json", ".jsonl")) else "parquet")
    rejects.write.mode("overwrite").parquet(os.path.join(out_dir, "rejects"))
    cfg = spark.read.schema(schemas.APP_CONFIG).parquet(config_path)
    for k, p in run(calls, cfg, out_dir).items():
        print(k, p)


if __name__ == "__main__":
    main(sys.argv)
