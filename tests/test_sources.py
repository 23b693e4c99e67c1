"""Readers and writers keep rows and types."""

import os
import tempfile

from pyspark.sql import functions as F

from fleetscope import fixtures as fx
from fleetscope import schemas
from fleetscope.sources import read_calls, read_calls_stream, write_event_log
from tests.conftest import SF001


def same_types(a, b):
    return [(f.name, f.dataType) for f in a.fields] == [(f.name, f.dataType) for f in b.fields]


def test_read_calls_json_and_parquet(spark):
    calls = fx.calls(spark, SF001)
    d = tempfile.mkdtemp(prefix="fs-src-")
    fmt_us = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}
    calls.write.options(**fmt_us).json(os.path.join(d, "j"))
    calls.write.parquet(os.path.join(d, "p"))
    want = sorted(map(tuple, calls.select("install_id", "seq", "op", "explicit_actor", "ts").collect()))
    for fmt, sub, opts in (("json", "j", fmt_us), ("parquet", "p", {})):
        got = read_calls(spark, os.path.join(d, sub), fmt=fmt, **opts)
        assert same_types(got.schema, schemas.CALLS)
        assert sorted(map(tuple, got.select("install_id", "seq", "op", "explicit_actor", "ts").collect())) == want
    s = read_calls_stream(spark, os.path.join(d, "p"), max_files=1)
    assert s.isStreaming and same_types(s.schema, schemas.CALLS)


def test_event_log_partitions_prune(spark):
    from fleetscope.operators.queue import spill_rows
    q = fx.queue(spark, SF001)
    rows = spill_rows(q).withColumn("source_app", F.lit("My:App/v2"))
    d = tempfile.mkdtemp(prefix="fs-log-")
    write_event_log(rows, d, granularity="month")
    assert os.listdir(d) and any(x.startswith("app_key=My_App_v2") for x in os.listdir(d))
    back = spark.read.parquet(d)
    one = back.filter(F.col("event_period") == "1996-01")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "event_period" in plan
    assert one.count() == rows.filter(F.col("queued_at").startswith("1996-01")).count()
