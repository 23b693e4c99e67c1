"""Per-install state reconstruction from the call log.

The tracked client is a state machine per install: opted-out flag C,
identified actor A, session S, device epoch E, breadcrumbs B. Each call is
first gated (disabled app, opted out), then validated, and only accepted
calls change A and S. ``reset``, ``opt_out`` and ``opt_in`` bypass the
gate. All state is a prefix scan in call order ``(ts, seq)`` per install,
computed by one ``ordered_scan`` whose flag is the opted-out state C:
epochs (resets), clock start, actor and session setters of accepted calls,
the accepted-track counter and the "next" lookups (next session change,
next consent change).

Two scopes. C and E belong to the install: they are persisted and outlive
the process. A, S and B belong to the process: a ``start`` or ``exit`` row of
the log (either may be missing after a crash) clears them as ``reset`` does,
but a session open at that point is lost without an end record. Calls between
an exit and the next start belong to a process whose start is not logged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetscope import config as C
from fleetscope.functions.core import actor_error, is_reserved_category, null_if_empty, uuid7_from_key
from fleetscope.operators.config import attach_app_config
from fleetscope.operators.scan import Scan, hot_aware_slice, ordered_scan, time_slice

ORDER = ["ts", "seq"]
# Rows of the log that bound a process of an install.
PROCESS_OPS = ("start", "exit")
BYPASS_OPS = ("opt_out", "opt_in", "reset", *PROCESS_OPS)
ACTOR_OPS = ("track", "exception", "start_session")
OPS = ("track", "exception", "identify", "start_session", "end_session", "opt_out", "opt_in", "reset", "flush", *PROCESS_OPS)


def validation_expr() -> Column:
    """Why a call would be refused if it passes the gate (null = valid).

    For ``track`` the reserved-category check comes before the actor check.
    """
    op, explicit = F.col("op"), F.col("explicit_actor")
    return (F.when(~op.isin(*OPS), F.lit("unknown_op"))
             .when((op == "track") & is_reserved_category("category"), F.lit("reserved_category"))
             .when(op == "identify", actor_error(explicit))
             .when(op.isin(*ACTOR_OPS) & explicit.isNotNull(), actor_error(explicit)))


def accepted_expr(opted_out_before: Column) -> Column:
    """Accepted = passes the gate (bypass op, or enabled and opted in) and valid."""
    return F.col("valid") & (F.col("bypass") | (F.col("enabled") & ~opted_out_before))


RESUME_OP = "__resume"
SNAPSHOT_COLS = {"snap_opted_out": "boolean", "snap_actor": "string", "snap_session": "string",
                 "snap_epoch": "long", "snap_epoch_start": "timestamp_ntz", "snap_first_ts": "timestamp_ntz",
                 "snap_track_no": "long", "snap_ring": "long"}


def state_scans(resume: bool = False) -> list[Scan]:
    """All per-install scans; flag-dependent ones take "opted out before".

    With ``resume``, a ``__resume`` row (one per install, ordered before the
    new calls) carries a saved snapshot into every scan, so a stream
    continues exactly where the previous micro-batch stopped.
    """
    op, explicit, ts = F.col("op"), F.col("explicit_actor"), F.col("ts")
    rs = op == RESUME_OP

    def snap(name, expr):
        if not resume:
            return expr
        if callable(expr) and not isinstance(expr, Column):
            return lambda c: F.when(rs, F.col(name)).otherwise(expr(c))
        return F.when(rs, F.col(name)).otherwise(expr)

    def actor_set(c):
        acc = accepted_expr(c)
        return (F.when(acc & (op == "identify"), explicit)
                 .when(acc & (op == "start_session") & explicit.isNotNull(), explicit)
                 .when(op.isin("reset", *PROCESS_OPS), F.lit("")))

    def session_set(c):
        acc = accepted_expr(c)
        return (F.when(acc & (op == "start_session"), F.col("new_session_id"))
                 .when(acc & op.isin("end_session", "reset", *PROCESS_OPS), F.lit("")))

    return [
        Scan("epoch", "sum", snap("snap_epoch", F.when(op == "reset", F.lit(1)).otherwise(F.lit(0)))),
        Scan("last_reset_ts", "last", snap("snap_epoch_start", F.when(op == "reset", ts))),
        Scan("first_ts", "first", snap("snap_first_ts", ts)),
        # What clears the breadcrumbs: their ring is that of one number.
        Scan("ring", "sum", snap("snap_ring", F.when(op.isin("reset", *PROCESS_OPS), F.lit(1)).otherwise(F.lit(0)))),
        Scan("actor_before", "last", snap("snap_actor", actor_set)),
        Scan("session_before", "last", snap("snap_session", session_set)),
        Scan("track_no", "sum_incl", snap("snap_track_no", lambda c: F.when(accepted_expr(c) & (op == "track"), F.lit(1))
                                          .otherwise(F.lit(0)))),
        Scan("next_session_change", "next", lambda c: F.when(
            accepted_expr(c) & op.isin("start_session", "end_session", "reset", *PROCESS_OPS),
            F.struct(ts.alias("ts"), F.col("seq").alias("seq"), op.alias("op")))),
        Scan("next_consent_change_ts", "next", lambda c: F.when(
            ((op == "opt_out") & ~c) | ((op == "opt_in") & c), ts)),
    ]


def scan_state(calls: DataFrame, initial_consent: DataFrame | None = None,
               slice_hours: int = C.DEFAULT_SLICE_HOURS,
               target_rows: int | None = C.DEFAULT_TARGET_ROWS) -> DataFrame:
    """One pass: consent flag, epochs, actor/session setters and lookups.

    ``initial_consent(install_id, opted_out)`` is the persisted flag each
    install starts with (default: opted in). Time buckets of one install
    holding more than ``target_rows`` calls are split further
    (``hot_aware_slice``); ``None`` keeps plain time slices.
    """
    op, ts = F.col("op"), F.col("ts")
    resume = "snap_epoch" in calls.columns
    if target_rows:
        calls = hot_aware_slice(calls, "install_id", "ts", target_rows, slice_hours)
    else:
        calls = calls.withColumn("slice", time_slice("ts", slice_hours))
    df = calls.select(
        "*",
        F.when(op == "start_session", uuid7_from_key(ts, F.col("install_id"), F.col("seq"), F.lit("session")))
        .alias("new_session_id"),
        validation_expr().alias("validation"),
        op.isin(*BYPASS_OPS).alias("bypass"))
    df = df.withColumn("valid", F.col("validation").isNull())
    toggle = F.when(op == "opt_out", F.lit(True)).when(op == "opt_in", F.lit(False))
    if resume:
        toggle = F.when(op == RESUME_OP, F.col("snap_opted_out")).otherwise(toggle)
    df = ordered_scan(df, "install_id", ORDER, state_scans(resume), flag=toggle,
                      flag_name="opted_out_before", flag_initial=initial_consent)
    c = F.col("opted_out_before")
    gate = (F.when(F.col("bypass"), F.lit(None).cast("string"))
             .when(~F.col("enabled"), F.lit("disabled"))
             .when(c, F.lit("opted_out")))
    acc = accepted_expr(c)
    explicit = F.col("explicit_actor")
    epoch = F.col("epoch").cast("long")
    device = uuid7_from_key(F.coalesce(F.col("last_reset_ts"), F.col("first_ts")), F.col("install_id"), epoch,
                            F.lit("device"))
    df = df.select(
        *[x for x in df.columns if x not in ("epoch", "ring", "track_no", "new_session_id", "last_reset_ts", "validation",
                                             "valid", "bypass")],
        F.when(op == "opt_out", F.lit(True)).when(op == "opt_in", F.lit(False))
         .when(op == RESUME_OP, F.col("snap_opted_out") if resume else c).otherwise(c).alias("opted_out_after"),
        epoch.alias("epoch"), F.col("ring").cast("long").alias("ring"), device.alias("device_id"), gate.alias("gate_reason"),
        F.when(gate.isNull(), F.col("validation")).alias("reject_reason"),
        acc.alias("accepted"), F.when(acc, F.col("new_session_id")).alias("new_session_id"),
        F.col("track_no").cast("long").alias("track_no"))
    actor = (F.when(op == "identify", explicit)
              .when(op.isin(*ACTOR_OPS),
                    F.coalesce(explicit, null_if_empty(F.col("actor_before")), F.col("device_id"))))
    session = (F.when(op == "start_session", F.col("new_session_id"))
                .when(op.isin("track", "exception"), null_if_empty(F.col("session_before"))))
    return df.select("*", F.when(F.col("accepted"), actor).alias("actor_id"),
                     F.when(F.col("accepted"), session).alias("session_id"))


def reconstruct(calls: DataFrame, app_config: DataFrame | None = None,
                initial_consent: DataFrame | None = None,
                slice_hours: int = C.DEFAULT_SLICE_HOURS,
                target_rows: int | None = C.DEFAULT_TARGET_ROWS) -> DataFrame:
    """Full per-call state: gate, rejection, epoch, device, actor, session.

    ``calls`` has the call-log schema (``schemas.CALLS``); ``app_config`` the
    raw options per app. One row out per call in.
    """
    if app_config is not None:
        calls = attach_app_config(calls, app_config)
    else:
        calls = (calls.withColumn("source_version", F.lit(None).cast("string"))
                 .withColumn("enabled", F.lit(True))
                 .withColumn("flush_interval_seconds", F.lit(C.FLUSH_INTERVAL_DEFAULT))
                 .withColumn("max_batch_size", F.lit(C.BATCH_SIZE_DEFAULT))
                 .withColumn("max_queue_size_mb", F.lit(C.QUEUE_MB_DEFAULT))
                 .withColumn("max_breadcrumbs", F.lit(C.BREADCRUMBS_DEFAULT)))
    return scan_state(calls, initial_consent, slice_hours, target_rows)
