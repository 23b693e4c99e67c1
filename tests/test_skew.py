"""A hot install (most of all rows) is spread over many tasks and stays exact."""

import datetime as dt
import random

from pyspark.sql import functions as F

from fleetscope import schemas
from fleetscope.operators.state import reconstruct
from tests import brute


def test_hot_install_is_split_and_exact(spark):
    rng = random.Random(3)
    rows, seq = [], 0
    base = dt.datetime(2024, 1, 1)
    for inst, n in [(0, 4000), (1, 300), (2, 300)]:          # install 0 holds ~87% of the rows
        t = base
        for _ in range(n):
            t += dt.timedelta(seconds=rng.choice([1, 60, 600, 3600]))
            op = rng.choice(["track"] * 6 + ["exception", "identify", "start_session", "end_session",
                                             "opt_out", "opt_in", "reset"])
            ex = rng.choice(["u1", "u2"]) if op == "identify" else None
            rows.append((inst, t, seq, op, "ui" if op == "track" else None, "n" if op == "track" else None, ex,
                         None, None, None, None, None, "app"))
            seq += 1
    calls = spark.createDataFrame(rows, schemas.CALLS)
    prev = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        st = reconstruct(calls, slice_hours=6)
        parts = (st.filter("install_id = 0").select(F.spark_partition_id().alias("p")).distinct().count())
        assert parts >= 4, parts            # not one task for the hot install
        got = {(r.install_id, r.seq): (r.epoch, r.accepted, r.opted_out_before) for r in
               st.select("install_id", "seq", "epoch", "accepted", "opted_out_before").collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", prev)
    exp = brute.run([{"install_id": r[0], "ts": r[1], "seq": r[2], "op": r[3], "category": r[4],
                      "explicit_actor": r[6]} for r in rows])
    assert got == {k: (e["epoch"], e["accepted"], e["opted_out_before"]) for k, e in exp.items()}


def test_hot_aware_slices_split_dense_day(spark):
    rng = random.Random(5)
    rows, seq = [], 0
    base = dt.datetime(2024, 1, 1)
    for inst, n, step in [(0, 3000, [1, 5, 20]), (1, 200, [600, 3600])]:   # install 0: 3000 calls within a day
        t = base
        for _ in range(n):
            t += dt.timedelta(seconds=rng.choice(step))
            op = rng.choice(["track"] * 5 + ["exception", "identify", "start_session", "opt_out", "opt_in", "reset"])
            ex = rng.choice(["u1", "u2"]) if op == "identify" else None
            rows.append((inst, t, seq, op, "ui" if op == "track" else None, "n" if op == "track" else None, ex,
                         None, None, None, None, None, "app"))
            seq += 1
    calls = spark.createDataFrame(rows, schemas.CALLS)
    from fleetscope.operators.scan import hot_aware_slice
    plain = hot_aware_slice(calls, "install_id", "ts", 10 ** 9).filter("install_id = 0")
    hot = hot_aware_slice(calls, "install_id", "ts", 300)
    n_plain = plain.select("slice").distinct().count()
    n_hot = hot.filter("install_id = 0").select("slice").distinct().count()
    assert n_plain <= 2 and n_hot >= 8, (n_plain, n_hot)
    cold_plain = hot_aware_slice(calls, "install_id", "ts", 10 ** 9).filter("install_id = 1")
    assert sorted(r.slice for r in hot.filter("install_id = 1").select("slice").collect()) == \
        sorted(r.slice for r in cold_plain.select("slice").collect())       # cold install: plain day slices
    st = reconstruct(calls, target_rows=300)
    got = {(r.install_id, r.seq): (r.epoch, r.accepted, r.opted_out_before, r.track_no) for r in
           st.select("install_id", "seq", "epoch", "accepted", "opted_out_before", "track_no").collect()}
    exp = brute.run([{"install_id": r[0], "ts": r[1], "seq": r[2], "op": r[3], "category": r[4],
                      "explicit_actor": r[6]} for r in rows])
    assert {k: v[:3] for k, v in got.items()} == {k: (e["epoch"], e["accepted"], e["opted_out_before"])
                                                  for k, e in exp.items()}


def test_crash_loop_meets_its_breadcrumbs_once(spark):
    from fleetscope.operators import breadcrumbs as bcm
    n_tracks, n_crashes, ring = 60, 3000, 25
    base = dt.datetime(2024, 1, 1)
    rows = [(0, base + dt.timedelta(seconds=i), i, "track" if i < n_tracks else "exception", "ui" if i < n_tracks else None,
             f"n{i}" if i < n_tracks else None, None, None, None, None, None, None, "app") for i in range(n_tracks + n_crashes)]
    st = reconstruct(spark.createDataFrame(rows, schemas.CALLS))
    ex = bcm.accepted_exceptions(st)
    tracks = st.filter("accepted AND op = 'track'")
    assert ex.count() == n_crashes
    groups = [r["count"] for r in bcm.candidates(ex, tracks).groupBy(*bcm.BC_KEY).count().collect()]
    assert groups and max(groups) <= 2 * ring * ring and sum(groups) <= 2 * ring
    got = bcm.breadcrumbs(st).select("seq", F.col("breadcrumbs.name").alias("names")).collect()
    want = [f"n{i}" for i in range(n_tracks - ring, n_tracks)]
    assert len(got) == n_crashes and all(r.names == want for r in got)


def test_calls_without_a_trace_do_not_meet_in_one_task(spark, tmp_path):
    from fleetscope import fixtures as fx
    n = 4000
    events = spark.range(n).select(
        F.when(F.col("id") % 501 != 500, F.col("id")).alias("event_id"), F.timestamp_seconds(F.col("id") + 1_700_000_000).alias("ts"),
        (F.col("id") % 90).alias("user_id"), F.when(F.col("id") % 10 == 0, "error").when(F.col("id") % 10 < 9, "view").alias("event_type"),
        F.format_string('{"k": %d}', F.col("id") % 100).alias("props"))
    events.repartition(8).write.parquet(f"{tmp_path}/events.parquet")
    spark.range(30).select((F.col("id") % 10).alias("conv_id"), F.floor(F.col("id") / 10).alias("turn"), F.lit("user").alias("role"),
                           F.lit("text").alias("text")).write.parquet(f"{tmp_path}/conversations.parquet")
    held = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.files.openCostInBytes": "64m"}
    before = {k: spark.conf.get(k, None) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    try:
        calls = fx.calls(spark, str(tmp_path))
        parts = calls.groupBy(F.spark_partition_id()).agg(F.count("op").alias("n"), F.count("stack_trace")).collect()
        sizes = [r["n"] for r in parts]
        got = calls.select("op", "seq", "stack_trace").collect()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert sum(sizes) == n and max(sizes) < n / 3, sizes
    assert sum(r.op == "exception" for r in got) == n / 10
    for r in got:                 # a trace for each exception with an id, none for other calls
        assert (r.stack_trace is not None) == (r.op == "exception" and r.seq is not None)
        if r.stack_trace is not None:
            conv = r.seq % 10
            assert f"conv{conv}" in r.stack_trace and r.stack_trace.count("\n") == 2


def test_calls_of_one_app_meet_its_config_in_many_tasks(spark):
    from fleetscope.operators.config import attach_app_config
    n = 40_000
    calls = spark.range(n).repartition(8).select("id", F.when(F.col("id") % 50 > 0, "hot").otherwise(F.concat(F.lit("a"), F.col("id") % 40)).alias("source_app"),
                                                 F.sha2(F.col("id").cast("string"), 256).alias("payload"))
    cfg = spark.range(40).select(F.when(F.col("id") == 39, "hot").otherwise(F.concat(F.lit("a"), F.col("id"))).alias("app_name"),
                                 F.concat(F.lit("key-"), F.col("id")).alias("api_key"), F.lit("http://h").alias("api_base_url"), F.lit("1").alias("app_version"),
                                 F.lit(True).alias("enabled"), *[F.lit(50).alias(c) for c in ("flush_interval_seconds", "max_batch_size", "max_queue_size_mb", "max_breadcrumbs")])
    held = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k"}
    before = {k: spark.conf.get(k, None) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    try:
        parts = (attach_app_config(calls, cfg).groupBy(F.spark_partition_id())
                 .agg(F.count("payload").alias("n"), F.count_if(F.col("enabled") & (F.col("max_batch_size") == 50)).alias("known")).collect())
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert sum(r["n"] for r in parts) == n and sum(r["known"] for r in parts) == n
    assert max(r["n"] for r in parts) < n / 3, parts
