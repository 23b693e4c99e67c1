"""Process boundaries: what ends with the process and what the install keeps."""

import datetime as dt

from pyspark.sql import functions as F

from fleetscope import schemas
from fleetscope.operators.breadcrumbs import exception_reports
from fleetscope.operators.config import normalize_app_config
from fleetscope.operators.delivery import apply_halt, environment_batches
from fleetscope.operators.identity import identity_links
from fleetscope.operators.sessions import build_sessions, events_with_session
from fleetscope.operators.state import reconstruct

T0 = dt.datetime(2024, 3, 1)


def log(spark, *ops, install=1):
    """Calls one minute apart: (op, explicit actor or None)."""
    rows = []
    for i, o in enumerate(ops):
        op, actor = o if isinstance(o, tuple) else (o, None)
        rows.append((install, T0 + dt.timedelta(minutes=i), i, op, "c" if op == "track" else None, f"n{i}" if op == "track" else None, actor,
                     None, "E" if op == "exception" else None, None, None, None, "app"))
    return spark.createDataFrame(rows, schemas.CALLS)


def by_seq(df, *cols):
    return {r["seq"]: tuple(r[c] for c in cols) if len(cols) > 1 else r[cols[0]] for r in df.select("seq", *cols).collect()}


def test_actor_session_and_crumbs_end_with_the_process(spark):
    st = reconstruct(log(spark, "start", ("identify", "u"), "start_session", "track", "exception", "exit", "start", "track", "exception")).cache()
    rows = by_seq(st, "actor_id", "session_id", "device_id", "accepted")
    assert rows[3][0] == "u" and rows[3][1] is not None
    assert rows[7][0] == rows[7][2] == rows[3][2]        # anonymous again, on the same device
    assert rows[7][1] is None and all(r[3] for r in rows.values())
    crumbs = {r["seq"]: [b["name"] for b in r["breadcrumbs"] or []] for r in exception_reports(st).collect()}
    assert crumbs == {4: ["n3"], 8: ["n7"]}
    s = build_sessions(st).first()
    assert (s["ended_ts"], s["end_reason"], s["ended_by"]) == (None, None, None) and s["lost_seq"] == 5
    ev = st.filter("accepted AND op IN ('track', 'exception')")
    assert by_seq(events_with_session(ev, build_sessions(st)), "session_id") == by_seq(ev, "session_id")


def test_a_crash_without_exit_is_a_boundary_too(spark):
    st = reconstruct(log(spark, ("identify", "u"), "start_session", "track", "start", "track"))
    assert by_seq(st, "session_id")[4] is None and by_seq(st, "epoch")[4] == 0


def test_consent_and_device_outlive_the_process(spark):
    st = reconstruct(log(spark, "opt_out", "exit", "start", "track", "opt_in", "track", "reset", "exit", "start", "track"))
    rows = by_seq(st, "gate_reason", "epoch", "device_id")
    assert rows[3][0] == "opted_out" and rows[5][0] is None
    assert [rows[i][1] for i in (0, 6, 9)] == [0, 0, 1]
    assert rows[0][2] == rows[5][2] != rows[9][2]


def test_the_same_actor_links_again_after_a_restart(spark):
    links = identity_links(reconstruct(log(spark, ("identify", "u"), ("identify", "u"), "exit", ("identify", "u"), "start", ("identify", "v"))))
    assert by_seq(links, "identified_actor_id", "conflict") == {0: ("u", False), 3: ("u", False), 5: ("v", True)}


def test_boundaries_apply_while_opted_out_or_disabled(spark):
    st = reconstruct(log(spark, ("identify", "u"), "start_session", "opt_out", "start", "opt_in", "track"))
    assert by_seq(st, "session_id")[5] is None
    init = spark.createDataFrame([(1, True)], "install_id long, opted_out boolean")
    assert by_seq(reconstruct(log(spark, "track", "opt_in", "track"), initial_consent=init), "accepted") == {0: False, 1: True, 2: True}


def test_boundaries_across_slices(spark):
    """Many short slices give what one slice gives."""
    ops = ["start", ("identify", "u"), "start_session", "track", "exception", "exit", "track", "exception", "start", "start_session", "track"] * 12
    calls = log(spark, *ops).withColumn("ts", F.expr("timestampadd(HOUR, cast(seq * 5 as int), ts)"))
    cols = ["actor_id", "session_id", "track_no", "ring", "device_id"]
    one = by_seq(reconstruct(calls, slice_hours=100_000, target_rows=None), *cols)
    assert by_seq(reconstruct(calls, slice_hours=1, target_rows=None), *cols) == one
    assert by_seq(reconstruct(calls, target_rows=3), *cols) == one


def batches(spark, *classes):
    return spark.createDataFrame([(1, i, T0 + dt.timedelta(minutes=i), c) for i, c in enumerate(classes)],
                                 "install_id long, batch_id long, first_attempt_at timestamp_ntz, deciding_class string")


def at(spark, *minutes):
    return spark.createDataFrame([(1, T0 + dt.timedelta(minutes=m)) for m in minutes], "install_id long, ts timestamp_ntz")


def test_a_new_process_sends_again_after_a_halt(spark):
    d = batches(spark, "success", "halt", "success", "success", "halt", "success")
    held = lambda x: [r["held"] for r in x.orderBy("batch_id").collect()]
    assert held(apply_halt(d)) == [False, False, True, True, True, True]
    assert held(apply_halt(d, at(spark, 3, 3))) == [False, False, True, False, False, True]
    assert held(apply_halt(d, at(spark, 1))) == [False, False, True, True, True, True]       # before the batch of its time
    assert apply_halt(d, at(spark, 3)).columns == apply_halt(d).columns


def test_a_new_process_arms_the_environment(spark):
    d = batches(spark, "success", "success", "retryable", "success", "success")
    starts = spark.createDataFrame([], "install_id long, ts timestamp_ntz, seq long")
    armed = lambda x: [r["with_environment"] for r in x.orderBy("batch_id").collect()]
    assert armed(environment_batches(d, starts)) == [True, False, False, False, False]
    assert armed(environment_batches(d, starts, at(spark, 2))) == [True, False, True, True, False]


def test_versions_are_compared_by_their_numbers(spark):
    rows = [("a", "k1", "http://h", v, True, 60, 25, 10, 25) for v in ("1.9", "1.10", "0.99")]
    assert normalize_app_config(spark.createDataFrame(rows, schemas.APP_CONFIG)).first()["app_version"] == "1.10"
