"""The state-machine consequences that are easy to get wrong, one log each."""

import datetime as dt

from pyspark.sql import functions as F

from fleetscope import schemas
from fleetscope.operators.breadcrumbs import breadcrumbs
from fleetscope.operators.identity import identity_links
from fleetscope.operators.sessions import build_sessions
from fleetscope.operators.state import reconstruct

T0 = dt.datetime(2024, 5, 1, 12, 0, 0)


def log(spark, ops, install=1):
    rows = []
    for i, o in enumerate(ops):
        op, arg = (o, None) if isinstance(o, str) else o
        cat = name = ex = None
        if op == "track":
            cat, name = "ui", arg or f"t{i}"
        elif arg is not None:
            ex = arg
        rows.append((install, T0 + dt.timedelta(seconds=i), i, op, cat, name, ex, None, None, None, None, None, "app"))
    return spark.createDataFrame(rows, schemas.CALLS)


def by_seq(df, *cols):
    return {r.seq: tuple(r[c] for c in cols) for r in df.select("seq", *cols).collect()}


def test_validation_comes_after_the_consent_gate(spark):
    st = reconstruct(log(spark, ["opt_out", ("identify", ""), ("track", None), "opt_in", ("identify", "")]))
    got = by_seq(st, "gate_reason", "reject_reason")
    assert got[1] == ("opted_out", None) and got[4] == (None, "actor_empty")


def test_start_session_with_actor_then_identify_links_nothing(spark):
    st = reconstruct(log(spark, [("start_session", "u"), ("identify", "u"), ("identify", "v")]))
    assert [r.seq for r in identity_links(st).collect()] == [2]


def test_breadcrumbs_survive_sessions_and_opt_out_until_reset(spark):
    ops = [("track", "a"), "start_session", ("track", "b"), "end_session", "opt_out", ("track", "x"), "opt_in",
           "exception", "reset", ("track", "c"), "exception"]
    st = reconstruct(log(spark, ops))
    bc = {r.seq: [x.name for x in (r.breadcrumbs or [])] for r in breadcrumbs(st).collect()}
    assert bc == {7: ["a", "b"], 10: ["c"]}


def test_session_survives_opt_out_period(spark):
    ops = ["start_session", "opt_out", "end_session", "opt_in", ("track", "a")]
    st = reconstruct(log(spark, ops))
    s = by_seq(st, "session_id", "new_session_id")
    assert s[4][0] == s[0][1] is not None           # event after opt-in carries the old session
    sess = build_sessions(st).collect()
    assert len(sess) == 1 and sess[0].ended_ts is None   # the ignored end did not close it


def test_reset_relinks_same_actor_to_new_device(spark):
    st = reconstruct(log(spark, [("identify", "u"), "reset", ("identify", "u")]))
    links = identity_links(st).orderBy("seq").collect()
    assert [r.identified_actor_id for r in links] == ["u", "u"]
    assert links[0].anonymous_actor_id != links[1].anonymous_actor_id
    assert not any(r.conflict for r in links)


def test_initial_consent_and_device_fallback(spark):
    init = spark.createDataFrame([(1, True)], "install_id long, opted_out boolean")
    st = reconstruct(log(spark, [("track", "a"), "opt_in", ("track", "b"), ("track", None)]), initial_consent=init)
    got = by_seq(st, "accepted", "actor_id", "device_id")
    assert got[0][0] is False and got[2][0] is True
    assert got[2][1] == got[2][2]                   # anonymous actor = device id


def test_explicit_actor_track_does_not_change_current_actor(spark):
    st = reconstruct(log(spark, [("identify", "u"), ("track", None), "exception"]).withColumn(
        "explicit_actor", F.when(F.col("seq") == 1, F.lit("other")).otherwise(F.col("explicit_actor"))))
    got = by_seq(st, "actor_id")
    assert got[1] == ("other",) and got[2] == ("u",)


def test_observed_refusal_metrics(spark):
    from fleetscope.operators.events import observe_refusals
    st = reconstruct(log(spark, ["opt_out", ("track", "a"), "opt_in", ("identify", ""), ("track", "b")]))
    df, obs = observe_refusals(st)
    df.write.format("noop").mode("overwrite").save()
    m = obs.get
    assert (m["calls"], m["accepted"], m["refused_ignored"], m["refused_error"]) == (5, 3, 1, 1)
