"""Streaming forms give the batch result on the same rows."""

import os
import tempfile

from pyspark.sql import functions as F

from fleetscope import fixtures as fx
from fleetscope import streaming as stm
from fleetscope.operators.events import track_events
from fleetscope.operators.sessions import idle_sessions
from fleetscope.operators.state import reconstruct
from tests.conftest import SF001


def _files(df, n=4):
    d = tempfile.mkdtemp(prefix="fs-stream-")
    df.repartition(n).write.mode("overwrite").parquet(os.path.join(d, "in"))
    return os.path.join(d, "in"), d


def _run(stream_df, name, mode="append"):
    q = (stream_df.writeStream.format("memory").queryName(name).outputMode(mode)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return stream_df.sparkSession.table(name)


def test_dedupe_stream_equals_batch(spark):
    ev = track_events(reconstruct(fx.calls(spark, SF001), fx.app_config_raw(spark, SF001)))
    ev = ev.select("install_id", "ts", "event_id", "category", "name")
    dup = ev.unionByName(ev.filter(F.col("install_id") % 3 == 0))      # redelivered batches
    path, _ = _files(dup)
    s = spark.readStream.schema(dup.schema).option("maxFilesPerTrigger", 1).parquet(path)
    got = _run(stm.dedupe_stream(s, "3650 days").select("event_id"), "dedupe_out")
    want = stm.dedupe_batch(dup).select("event_id")
    assert sorted(r.event_id for r in got.collect()) == sorted(r.event_id for r in want.collect())


def test_window_counts_stream_equals_batch(spark):
    ev = track_events(reconstruct(fx.calls(spark, SF001), fx.app_config_raw(spark, SF001)))
    ev = ev.select("source_app", "ts")
    path, _ = _files(ev)
    s = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(path)
    got = _run(stm.window_counts_stream(s, "60 seconds", "3650 days"), "wc_out", mode="update")
    want = stm.window_counts(ev, "60 seconds")
    g = {(r.source_app, r.window_start): r.n for r in got.collect()}
    w = {(r.source_app, r.window_start): r.n for r in want.collect()}
    assert g == w


def test_idle_sessions_stream_closed_equal_batch(spark):
    calls = fx.calls(spark, SF001).select("install_id", "ts", "seq")
    path, _ = _files(calls)
    s = spark.readStream.schema(calls.schema).parquet(path)
    got = _run(stm.idle_sessions_stream(s, "12 hours", "0 seconds"), "idle_out")
    want = idle_sessions(calls, 12 * 3600)
    g = {(r.install_id, r.started_at): (r.last_event_at, r.n_events) for r in got.collect()}
    w = {(r.install_id, r.started_at): (r.last_event_at, r.n_events) for r in want.collect()}
    # Append mode emits a session once the watermark passes its end; every
    # emitted one equals the batch session, and only the tail is pending.
    assert g and all(w[k] == v for k, v in g.items())
    assert len(g) >= len(w) - calls.select("install_id").distinct().count()


def test_validate_stream(spark):
    calls = fx.calls(spark, SF001)
    path, _ = _files(calls)
    s = spark.readStream.schema(calls.schema).parquet(path)
    got = _run(stm.validate_stream(s).select("seq", "reject_reason"), "val_out")
    want = stm.validate_stream(calls).select("seq", "reject_reason")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_stateful_stream_equals_batch(spark):
    from fleetscope.operators.breadcrumbs import exception_reports
    from fleetscope.streaming.stateful import stateful_stream
    calls = fx.calls(spark, SF001)
    cfg = fx.app_config_raw(spark, SF001)
    d = tempfile.mkdtemp(prefix="fs-stateful-")
    # Four files in time order: each micro-batch continues the previous state.
    bounds = ["2024-01-08", "2024-01-15", "2024-01-23"]
    cond = [F.col("ts") < bounds[0]] + \
           [(F.col("ts") >= bounds[i]) & (F.col("ts") < bounds[i + 1]) for i in range(2)] + [F.col("ts") >= bounds[2]]
    for i, c in enumerate(cond):
        calls.filter(c).coalesce(1).write.parquet(os.path.join(d, "in", f"part{i}"))
    src = spark.readStream.schema(calls.schema).option("maxFilesPerTrigger", 1).option(
        "recursiveFileLookup", "true").parquet(os.path.join(d, "in"))
    qy = stateful_stream(src, cfg, os.path.join(d, "state"), os.path.join(d, "out"), os.path.join(d, "ckpt"),
                         availableNow=True)
    qy.awaitTermination()
    out = spark.read.parquet(os.path.join(d, "out", "state"))
    assert out.select("batch_id").distinct().count() == 4
    st = reconstruct(calls, cfg)
    cols = ["install_id", "seq", "opted_out_before", "epoch", "device_id", "gate_reason", "reject_reason",
            "accepted", "actor_id", "session_id", "track_no"]
    got = sorted(tuple(r) for r in out.select(*cols).collect())
    want = sorted(tuple(r) for r in st.select(*cols).collect())
    assert got == want
    rep = spark.read.parquet(os.path.join(d, "out", "exception_reports"))
    g = sorted((r.seq, r.exception_id, tuple(x.name for x in (r.breadcrumbs or []))) for r in rep.collect())
    w = sorted((r.seq, r.exception_id, tuple(x.name for x in (r.breadcrumbs or [])))
               for r in exception_reports(st).collect())
    assert g == w
    assert spark.read.parquet(os.path.join(d, "out", "late_calls")).count() == 0


def test_validation_stream_two_sinks(spark):
    calls = fx.calls(spark, SF001)
    path, d = _files(calls)
    s = spark.readStream.schema(calls.schema).parquet(path)
    q = stm.start_validation_stream(s, os.path.join(d, "ok"), os.path.join(d, "bad"), os.path.join(d, "ck"),
                                    availableNow=True)
    q.awaitTermination()
    ok = spark.read.parquet(os.path.join(d, "ok"))
    bad = spark.read.parquet(os.path.join(d, "bad"))
    want = stm.validate_stream(calls)
    assert ok.count() == want.filter("reject_reason IS NULL").count()
    assert bad.count() == want.filter("reject_reason IS NOT NULL").count() > 0


def test_event_log_stream_sink_and_watermark(spark):
    from fleetscope.operators import queue as qm
    from fleetscope.sources import write_event_log_stream
    q = fx.queue(spark, SF001)
    delay = qm.watermark_delay(q)
    assert delay.endswith(" seconds") and int(delay.split()[0]) >= 60
    rows = qm.spill_rows(q).withColumn("source_app", F.get_json_object("payload_json", "$.source_app"))
    path, d = _files(rows)
    s = spark.readStream.schema(rows.schema).parquet(path)
    out = os.path.join(d, "log")
    w = write_event_log_stream(s, out, os.path.join(d, "ck"), availableNow=True)
    w.awaitTermination()
    back = spark.read.parquet(out)
    assert back.count() == rows.count() and back.select("app_key").distinct().count() == 1
