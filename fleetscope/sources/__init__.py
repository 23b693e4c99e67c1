"""Readers and writers: call logs, batch bodies, event log, manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetscope import schemas
from fleetscope.functions.core import partition_key


# Layout of times in JSON call logs (Spark's own default keeps milliseconds only).
JSON_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
REQUIRED = tuple(f.name for f in schemas.CALLS.fields if not f.nullable)


def _parsed(raw: DataFrame, fmt: str, schema: T.StructType, **options: str) -> DataFrame:
    """Columns of ``schema``, then ``__raw`` (line of a text log that is no
    whole record) and ``source_file``."""
    file = F.col("_metadata.file_path").alias("source_file")
    if fmt != "json":
        return raw.select(*[f.name for f in schema], F.lit(None).cast("string").alias("__raw"), file)
    loose = T.StructType([T.StructField(f.name, f.dataType) for f in schema] + [T.StructField("__bad", T.StringType())])
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__bad", "timestampNTZFormat": JSON_TIME, **options}
    lines = raw.select("value", file).filter(F.length(F.trim("value")) > 0)
    parsed = lines.withColumn("__r", F.from_json("value", loose, opts))
    # Text that is no object parses to nothing at all.
    bad = F.when(F.col("__r").isNull() | F.col("__r.__bad").isNotNull(), F.col("value"))
    return parsed.select(*[F.col(f"__r.`{f.name}`") for f in schema], bad.alias("__raw"), "source_file")


def split_calls(parsed: DataFrame, schema: T.StructType = schemas.CALLS) -> tuple[DataFrame, DataFrame]:
    """Parsed log rows -> (calls, rejects). A reject has ``reason``
    ``malformed_record`` (the text is no record of the schema, ``raw`` holds
    it) or ``missing_field`` (a field that every call has is null), what could
    be read of it, and its file."""
    lacks = F.lit(False)
    for f in schema.fields:
        if not f.nullable:
            lacks = lacks | F.col(f.name).isNull()
    reason = F.when(F.col("__raw").isNotNull(), F.lit("malformed_record")).when(lacks, F.lit("missing_field"))
    tagged = parsed.withColumn("reason", reason)
    calls = tagged.filter(F.col("reason").isNull()).drop("reason", "__raw")
    # Fields of a damaged record are not trusted.
    held = [F.when(F.col("__raw").isNull(), F.col(k)).alias(k) for k in REQUIRED if k in parsed.columns]
    return calls, tagged.filter(F.col("reason").isNotNull()).select("reason", *held, F.col("__raw").alias("raw"), "source_file")


def read_calls(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: T.StructType = schemas.CALLS, **options: str) -> DataFrame:
    """Read a call log of whole records with its explicit schema (parquet,
    json, orc, ...). Logs that may be damaged are read by ``read_call_log``.

    Text formats need the producer's time layout, e.g. for JSON with
    microseconds ``timestampNTZFormat=JSON_TIME`` (Spark's JSON default keeps
    milliseconds only)."""
    return spark.read.schema(schema).format(fmt).options(**options).load(path)


def read_calls_stream(spark: SparkSession, path: str, fmt: str = "parquet",
                      schema: T.StructType = schemas.CALLS, max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema).format(fmt)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.load(path)


def read_call_log(spark: SparkSession, path: str, fmt: str = "parquet",
                  schema: T.StructType = schemas.CALLS, **options: str) -> tuple[DataFrame, DataFrame]:
    """Read a call log with its explicit schema -> (calls, rejects).

    ``fmt`` is ``json`` (one object per line; times as ``JSON_TIME`` unless
    ``timestampNTZFormat`` says otherwise) or a columnar format. Damaged lines
    and rows without a required field are returned as rejects and never fail
    the job or vanish; both outputs carry ``source_file``. A columnar file
    that cannot be opened fails the job."""
    if fmt == "json":
        return split_calls(_parsed(spark.read.text(path), fmt, schema, **options), schema)
    return split_calls(_parsed(spark.read.schema(schema).format(fmt).options(**options).load(path), fmt, schema), schema)


def read_call_log_stream(spark: SparkSession, path: str, fmt: str = "parquet", schema: T.StructType = schemas.CALLS,
                         max_files: int | None = None, **options: str) -> tuple[DataFrame, DataFrame]:
    """``read_call_log`` over files as they arrive; both results are streams."""
    r = spark.readStream
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    raw = r.text(path) if fmt == "json" else r.schema(schema).format(fmt).options(**options).load(path)
    return split_calls(_parsed(raw, fmt, schema, **options), schema)


def explode_event_batches(batches: DataFrame, body: str = "body",
                          key: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Batch bodies (JSON arrays of events) -> (events, quarantine).

    Each element is parsed on its own and becomes one row with its position,
    so one bad element never takes its neighbours along. A body that is not a
    JSON array (null, truncated, another value), elements that are no object
    and elements without an ``event_id`` go to the quarantine output with
    their raw text.
    """
    key = key or [c for c in batches.columns if c != body]
    arr = F.from_json(F.col(body), T.ArrayType(T.StringType()))
    # Spark reads a lone value as an array of one; a body must show brackets.
    b = batches.withColumn("__arr", F.when(F.col(body).rlike(r"^\s*\["), arr))
    bad_body = b.filter(F.col("__arr").isNull()).select(*key, F.lit(None).cast("int").alias("pos"),
                                                          F.lit("body_not_json_array").alias("reason"), F.col(body).alias("raw"))
    e = b.filter(F.col("__arr").isNotNull()).select(*key, F.posexplode("__arr").alias("pos", "raw"))
    e = e.withColumn("event", F.when(F.col("raw").startswith("{"), F.from_json("raw", schemas.EVENT)))
    good = F.col("event.event_id").isNotNull()
    ok = e.filter(good).select(*key, "pos", "event.*")
    reason = F.when(F.coalesce(F.col("raw").startswith("{"), F.lit(False)), F.lit("element_without_event_id")).otherwise(F.lit("element_not_object"))
    bad_el = e.filter(~F.coalesce(good, F.lit(False))).select(*key, "pos", reason.alias("reason"), "raw")
    return ok, bad_body.unionByName(bad_el)


def write_event_log(rows: DataFrame, path: str, app_col: str = "source_app",
                    ts_col: str = "queued_at", mode: str = "append", granularity: str = "day") -> None:
    """Append durable-queue rows, partitioned by a path-safe app key and
    the day (or month) of ``ts_col`` (timestamp or ISO text) in column
    ``event_period``, so later reads prune partitions. Rows are rebalanced on
    the partition columns first: small partitions get one file per write, and
    a hot app and period is split over several tasks.
    The file commit protocol makes each write all-or-nothing, like one
    transaction."""
    keyed = (rows.withColumn("app_key", partition_key(app_col))
                 .withColumn("event_period", F.left(F.col(ts_col).cast("string"),
                                                    F.lit(10 if granularity == "day" else 7))))
    (keyed.hint("rebalance", "app_key", "event_period")
          .write.mode(mode).partitionBy("app_key", "event_period").parquet(path))


def write_event_log_stream(rows: DataFrame, path: str, checkpoint: str, app_col: str = "source_app",
                           ts_col: str = "queued_at", **trigger):
    """Streaming form of ``write_event_log``: a parquet file sink with the
    same partition columns; the checkpoint makes each file commit exactly
    once across restarts."""
    keyed = (rows.withColumn("app_key", partition_key(app_col))
                 .withColumn("event_period", F.left(F.col(ts_col).cast("string"), F.lit(10))))
    w = (keyed.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
              .partitionBy("app_key", "event_period").outputMode("append"))
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def export_manifest(manifests: DataFrame, path: str) -> None:
    """Write one JSON manifest per app under ``app_key=<safe name>/``."""
    (manifests.withColumn("app_key", partition_key("source_app"))
              .select("app_key", "manifest_json")
              .write.mode("overwrite").partitionBy("app_key").text(path))
