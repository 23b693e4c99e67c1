"""Explicit schemas of the inputs (never inferred)."""

from pyspark.sql import types as T

CALLS = T.StructType([
    T.StructField("install_id", T.LongType(), False),
    T.StructField("ts", T.TimestampNTZType(), False),
    T.StructField("seq", T.LongType(), False),
    T.StructField("op", T.StringType(), False),
    T.StructField("category", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("explicit_actor", T.StringType()),
    T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
    T.StructField("exc_type", T.StringType()),
    T.StructField("severity", T.StringType()),
    T.StructField("message", T.StringType()),
    T.StructField("stack_trace", T.StringType()),
    T.StructField("source_app", T.StringType()),
])

APP_CONFIG = T.StructType([
    T.StructField("app_name", T.StringType()),
    T.StructField("api_key", T.StringType()),
    T.StructField("api_base_url", T.StringType()),
    T.StructField("app_version", T.StringType()),
    T.StructField("enabled", T.BooleanType()),
    T.StructField("flush_interval_seconds", T.IntegerType()),
    T.StructField("max_batch_size", T.IntegerType()),
    T.StructField("max_queue_size_mb", T.IntegerType()),
    T.StructField("max_breadcrumbs", T.IntegerType()),
])

QUEUE = T.StructType([
    T.StructField("install_id", T.LongType(), False),
    T.StructField("id", T.LongType(), False),
    T.StructField("payload_json", T.StringType()),
    T.StructField("queued_at", T.TimestampNTZType()),
    T.StructField("retry_count", T.IntegerType()),
])

ATTEMPTS = T.StructType([
    T.StructField("install_id", T.LongType(), False),
    T.StructField("batch_id", T.LongType(), False),
    T.StructField("attempt_no", T.IntegerType(), False),
    T.StructField("origin", T.StringType()),
    T.StructField("status_code", T.IntegerType()),
    T.StructField("is_network_error", T.BooleanType()),
    T.StructField("retry_after", T.StringType()),
    T.StructField("attempted_at", T.TimestampNTZType()),
])

# One delivered event inside a batch body.
EVENT = T.StructType([
    T.StructField("actor_id", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("event_id", T.StringType()),
    T.StructField("name", T.StringType()),
    T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
    T.StructField("session_id", T.StringType()),
    T.StructField("source_app", T.StringType()),
    T.StructField("source_version", T.StringType()),
    T.StructField("timestamp", T.StringType()),
])
