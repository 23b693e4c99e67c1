"""Structured Streaming forms of the operators.

Delivery is at least once (a lost reply is retried with the same
``event_id``) and undelivered events wait in the durable queue, so they can
reach a consumer long after their timestamp. Each streaming operator here
has a batch twin with the same result on the same rows; the watermark
delay should be sized from ``operators.queue.delivery_lag``.

Event time columns are ``timestamp_ntz`` in the tables; watermarks need
``timestamp``, so streams cast with the session time zone set to UTC.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetscope.functions.core import iso_millis


def _event_time(df: DataFrame, col: str = "ts", out: str = "event_time") -> DataFrame:
    return df.withColumn(out, F.col(col).cast("timestamp"))


# --------------------------------------------------------------- dedupe (53)

def dedupe_batch(events: DataFrame, key: str = "event_id") -> DataFrame:
    """Batch twin: one row per event id."""
    return events.dropDuplicates([key])


def dedupe_stream(events: DataFrame, delay: str, ts: str = "ts", key: str = "event_id") -> DataFrame:
    """Drop redelivered events by id; state is kept for ``delay`` after the
    event time (``dropDuplicatesWithinWatermark``)."""
    e = _event_time(events, ts).withWatermark("event_time", delay)
    return e.dropDuplicatesWithinWatermark([key])


# ----------------------------------------------------- stateless checks (54)

def validate_stream(calls: DataFrame) -> DataFrame:
    """Stateless checks (reserved category, actor rules, truncation) on a
    batch or streaming DataFrame; ``reject_reason`` is null for valid rows."""
    from fleetscope.operators.events import normalize_event, reject_reserved_category, validate_actor
    v = normalize_event(validate_actor(reject_reserved_category(calls)))
    return v.withColumn("reject_reason", F.when(F.col("reserved"), F.lit("reserved_category"))
                        .otherwise(F.col("actor_error")))


def start_validation_stream(calls: DataFrame, accepted_path: str, rejected_path: str, checkpoint: str,
                            **trigger):
    """Run ``validate_stream`` and write each micro-batch's valid rows and
    refused rows to two parquet sinks through ``foreachBatch`` (one folder
    per batch id, so a retried batch rewrites its own files)."""
    def sink(df: DataFrame, batch_id: int) -> None:
        df = df.cache()
        try:
            df.filter(F.col("reject_reason").isNull()).write.mode("overwrite").parquet(
                f"{accepted_path}/batch_id={batch_id}")
            df.filter(F.col("reject_reason").isNotNull()).write.mode("overwrite").parquet(
                f"{rejected_path}/batch_id={batch_id}")
        finally:
            df.unpersist()

    w = validate_stream(calls).writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


# -------------------------------------------------------- idle sessions (55)

def idle_sessions_stream(events: DataFrame, gap: str, delay: str, key: str = "install_id",
                         ts: str = "ts") -> DataFrame:
    """Gap sessions with ``session_window``; closed sessions are emitted in
    append mode once the watermark passes their end."""
    e = _event_time(events, ts).withWatermark("event_time", delay)
    g = e.groupBy(F.col(key), F.session_window("event_time", gap).alias("w")).agg(
        F.count(F.lit(1)).alias("n_events"), F.min("event_time").alias("first"), F.max("event_time").alias("last"))
    return g.select(key, iso_millis(F.col("first").cast("timestamp_ntz")).alias("started_at"),
                    iso_millis(F.col("last").cast("timestamp_ntz")).alias("last_event_at"), "n_events")


# ------------------------------------------------- flush window counts (57)

def window_counts(events: DataFrame, width: str, key: str = "source_app", ts: str = "ts") -> DataFrame:
    """Batch twin: events per app and tumbling window (flush cadence)."""
    g = events.groupBy(F.col(key), F.window(F.col(ts).cast("timestamp_ntz"), width).alias("w")).agg(
        F.count(F.lit(1)).alias("n"))
    return g.select(key, iso_millis(F.col("w.start")).alias("window_start"), "n")


def window_counts_stream(events: DataFrame, width: str, delay: str, key: str = "source_app",
                         ts: str = "ts") -> DataFrame:
    e = _event_time(events, ts).withWatermark("event_time", delay)
    g = e.groupBy(F.col(key), F.window("event_time", width).alias("w")).agg(F.count(F.lit(1)).alias("n"))
    return g.select(key, iso_millis(F.col("w.start").cast("timestamp_ntz")).alias("window_start"), "n")
