"""The incremental store behind the stateful stream."""

import datetime as dt
import os
import random
import uuid

import pytest
from pyspark.sql import functions as F

from fleetscope import schemas
from fleetscope.config import scratch_path
from fleetscope.operators.breadcrumbs import exception_reports
from fleetscope.operators.identity import identity_links
from fleetscope.operators.sessions import build_sessions
from fleetscope.operators.state import reconstruct
from fleetscope.streaming.stateful import StateStore, last_tracks, process_batch, stream_sessions
from tests.test_state_machine import CFG_ROWS, random_calls


def frame(spark, rows):
    return spark.createDataFrame([tuple(r[f.name] for f in schemas.CALLS.fields) for r in rows], schemas.CALLS)


def files(path):
    """Data files below a folder, by their relative folder."""
    path = path.removeprefix("file:").replace("//", "/")
    return sorted(os.path.relpath(d, path) for d, _, names in os.walk(path) for n in names if n.endswith(".parquet"))


def rows_of(df, *cols):
    return sorted(map(tuple, df.select(*cols).collect()), key=str)


def compare(spark, calls, cfg, out):
    st = reconstruct(calls, cfg).cache()
    cols = ["install_id", "seq", "opted_out_before", "epoch", "device_id", "gate_reason", "accepted", "actor_id", "session_id", "track_no"]
    assert rows_of(spark.read.parquet(f"{out}/state"), *cols) == rows_of(st, *cols)
    cols = ["install_id", "seq", "anonymous_actor_id", "identified_actor_id", "conflict"]
    assert rows_of(spark.read.parquet(f"{out}/identity_links"), *cols) == rows_of(identity_links(st), *cols)
    cols = ["session_id", "started_ts", "ended_ts", "ended_by", "lost_ts"]
    assert rows_of(stream_sessions(spark, out), *cols) == rows_of(build_sessions(st), *cols)
    cols = ["exception_id", "session_id", "breadcrumbs.timestamp"]
    assert rows_of(spark.read.parquet(f"{out}/exception_reports"), *cols) == rows_of(exception_reports(st), *cols)
    st.unpersist()


@pytest.mark.parametrize("seed", [3, 4])
def test_random_micro_batches_equal_one_batch(spark, seed):
    """Each install's calls are cut at times of its own; deltas are compacted
    often, one micro-batch is repeated and one fails half-way."""
    base = scratch_path(spark, f"store-{uuid.uuid4().hex}")
    rows = random_calls(seed, installs=6, per=120)
    cfg = spark.createDataFrame(CFG_ROWS, schemas.APP_CONFIG)
    rng = random.Random(seed)
    parts = 5
    cuts = {i: sorted(rng.sample(range(120), parts - 1)) for i in range(6)}
    seen: dict[int, int] = {}
    groups = [[] for _ in range(parts)]
    for r in sorted(rows, key=lambda r: (r["ts"], r["seq"])):
        k = seen[r["install_id"]] = seen.get(r["install_id"], -1) + 1
        groups[sum(k >= c for c in cuts[r["install_id"]])].append(r)
    groups[2] = [r for r in groups[2] if r["install_id"] in (0, 1)]
    kept = [r for g in groups for r in g]
    # Install 2-5 skip the third micro-batch: their calls of it never come.
    store = StateStore(spark, f"{base}/state", buckets=4, compact_after=1, keep=2)
    for i, g in enumerate(groups):
        part = frame(spark, g).repartition(3)
        if i == 3:                                  # files of an attempt that failed before it published
            part.limit(3).select("install_id").withColumn("bucket", F.lit(1)).write.partitionBy("bucket").parquet(f"{base}/state/v=3")
        process_batch(part, i, cfg, f"{base}/state", f"{base}/out", store=store)
        if i == 1:
            before = files(f"{base}/state/v=1")
            process_batch(part, i, cfg, f"{base}/state", f"{base}/out", store=store)
            assert files(f"{base}/state/v=1") == before
    pointer = store.pointer(4)
    assert all(len(v) <= 3 for v in pointer.buckets.values())
    assert store.pointers() == [3, 4]               # older pointers and what they alone named are gone
    live = pointer.versions() | store.pointer(3).versions()
    assert {int(n[2:]) for n in os.listdir(f"{base}/state".removeprefix("file:").replace("//", "/")) if n.startswith("v=")} == live
    compare(spark, frame(spark, kept), cfg, f"{base}/out")


def test_work_follows_the_active_installs(spark):
    base = scratch_path(spark, f"store-{uuid.uuid4().hex}")
    t0 = dt.datetime(2024, 1, 1)

    def call(install, minute, op="track"):
        return dict(install_id=install, ts=t0 + dt.timedelta(minutes=minute), seq=minute * 1000 + install, op=op, category="c", name="n",
                    explicit_actor=None, properties=None, exc_type=None, severity=None, message=None, stack_trace=None, source_app="app0")

    cfg = spark.createDataFrame(CFG_ROWS, schemas.APP_CONFIG)
    store = StateStore(spark, f"{base}/state", buckets=16)
    process_batch(frame(spark, [call(i, 0) for i in range(200)]), 0, cfg, f"{base}/state", f"{base}/out", store=store)
    assert len(files(f"{base}/state/v=0")) == 16
    process_batch(frame(spark, [call(7, 1), call(7, 2)]), 1, cfg, f"{base}/state", f"{base}/out", store=store)
    b = spark.range(1).select(store.bucket(F.lit(7).cast("long"))).first()[0]
    assert files(f"{base}/state/v=1") == [f"bucket={b}"]                             # one file written
    assert len(store.paths(store.before(2), [b])) == 2 and len(store.paths(store.before(2), [(b + 1) % 16])) == 1
    assert spark.read.parquet(f"{base}/state/v=1").count() == 1
    saved = store.read(store.before(2), [b]).filter("install_id = 7").first()
    assert saved["track_no"] == 3 and sorted(c["track_no"] for c in saved["crumbs"]) == [1, 2, 3]
    # Late calls alone change nothing and are set aside.
    process_batch(frame(spark, [call(7, 1)]), 2, cfg, f"{base}/state", f"{base}/out", store=store)
    assert not files(f"{base}/state/v=2") and spark.read.parquet(f"{base}/out/late_calls").count() == 1
    assert store.read(store.before(3), [b]).filter("install_id = 7").first()["track_no"] == 3


def test_ring_of_a_hot_install_stays_bounded(spark):
    """100,000 tracks of one install in 20 slices: each slice keeps its own
    last n, and no exchange carries more."""
    n, slices = 25, 20
    st = (spark.range(100_000).select(
        F.lit(1).cast("long").alias("install_id"), F.lit(0).cast("long").alias("ring"), (F.col("id") + 1).alias("track_no"),
        (F.col("id") % slices).alias("x"), F.expr("timestamp_ntz'2024-01-01' + make_dt_interval(0, 0, 0, id)").alias("ts"),
        F.lit("c").alias("category"), F.lit("n").alias("name"), F.lit(None).cast("map<string,string>").alias("properties"),
        F.lit(n).alias("max_breadcrumbs"), F.lit(True).alias("accepted"), F.lit("track").alias("op"),
        F.floor(F.col("id") / (100_000 // slices)).alias("slice")).drop("x").repartition(8))
    from fleetscope.streaming.stateful import SAVED
    now = spark.createDataFrame([(1, 0, 100_000, n)], "install_id long, ring long, track_no long, max_breadcrumbs int")
    got = last_tracks(st, spark.createDataFrame([], SAVED), now)
    assert sorted(c["track_no"] for c in got.first()["crumbs"]) == list(range(100_000 - n + 1, 100_001))
    plan = got._jdf.queryExecution().executedPlan().toString()
    # The group limit stands below the exchange too (Partial) and above it (Final).
    assert "WindowGroupLimit" in plan and "Partial" in plan and "Final" in plan
    assert "slice" in plan[plan.index("WindowGroupLimit"):][:200]


def test_another_bucket_count_is_refused(spark):
    base = scratch_path(spark, f"store-{uuid.uuid4().hex}")
    store = StateStore(spark, base, buckets=4)
    from fleetscope.streaming.stateful import Pointer
    store.publish(0, Pointer({1: [0]}))
    assert store.before(1).buckets == {1: [0]} and store.before(0).buckets == {}
    with pytest.raises(ValueError):
        StateStore(spark, base, buckets=8).before(1)
