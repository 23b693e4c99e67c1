"""Sessions: build, stamp, range-join, idle-gap sessions and summaries."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fleetscope import config as C
from fleetscope.functions.core import epoch_micros, iso_millis
from fleetscope.operators.scan import Scan, ordered_scan, slices
from fleetscope.operators.state import PROCESS_OPS


def build_sessions(state: DataFrame) -> DataFrame:
    """One row per accepted ``start_session``.

    A session ends at the next accepted start, end or reset of the same
    install (end reason always ``normal``); with none it stays open
    (``ended_ts`` null). So does one whose process ends first: it gets no end
    record, only the place where it was lost (``lost_ts``, ``lost_seq``), from
    which on no call carries it.
    """
    s = state.filter(F.col("accepted") & (F.col("op") == "start_session"))
    nxt = F.col("next_session_change")
    lost = nxt["op"].isin(*PROCESS_OPS)
    ended = nxt.isNotNull() & ~lost
    return s.select(
        "install_id", "epoch", F.col("new_session_id").alias("session_id"), "actor_id",
        "source_app", "source_version",
        F.col("ts").alias("started_ts"), F.col("seq").alias("start_seq"),
        F.when(ended, nxt["ts"]).alias("ended_ts"), F.when(ended, nxt["seq"]).alias("end_seq"),
        F.when(ended, nxt["op"]).alias("ended_by"), F.when(ended, F.lit(C.END_REASON_NORMAL)).alias("end_reason"),
        F.when(lost, nxt["ts"]).alias("lost_ts"), F.when(lost, nxt["seq"]).alias("lost_seq"),
    )


def assign_session(state: DataFrame) -> DataFrame:
    """Accepted tracks and exceptions with the session open at call time."""
    return (state.filter(F.col("accepted") & F.col("op").isin("track", "exception"))
                 .select("install_id", "ts", "seq", "op", "session_id"))


def events_with_session(events: DataFrame, sessions: DataFrame) -> DataFrame:
    """Range join: each event gets the session whose [start, end) holds it
    (for a session lost with its process, up to that place).

    Sessions of one install never overlap, so this is an as-of lookup: the
    session starts are unioned with the events and the last start before
    each event is carried by the skew-safe ordered scan -- no pair of rows
    of one install is ever compared, and a hot install spreads over slices.
    """
    ev = events.select("install_id", "ts", "seq", F.lit(None).cast("struct<session_id:string,ended_ts:timestamp_ntz,end_seq:long>").alias("marker"),
                       F.lit(True).alias("is_event"))
    st = sessions.select(
        "install_id", F.col("started_ts").alias("ts"), F.col("start_seq").alias("seq"),
        F.struct(F.col("session_id"), F.coalesce("ended_ts", "lost_ts").alias("ended_ts"), F.coalesce("end_seq", "lost_seq").alias("end_seq")).alias("marker"),
        F.lit(False).alias("is_event"))
    u = slices(ev.unionByName(st))
    u = ordered_scan(u, "install_id", ["ts", "seq"], [Scan("open", "last", F.col("marker"))])
    o = F.col("open")
    before_end = (F.col("ts") < o["ended_ts"]) | ((F.col("ts") == o["ended_ts"]) & (F.col("seq") < o["end_seq"]))
    inside = o.isNotNull() & (o["ended_ts"].isNull() | before_end)
    return (u.filter(F.col("is_event"))
             .select("install_id", "ts", "seq", F.when(inside, F.col("open")["session_id"]).alias("session_id")))


def idle_sessions(events: DataFrame, gap_seconds: int, key: str = "install_id") -> DataFrame:
    """Gap sessions: a new session starts when an event comes ``gap`` or more
    after the previous one of the same key (same rule as Spark's
    ``session_window``).

    One sliced pass: inside ``(key, slice)`` the gap test needs only the
    previous row, except for a slice's first row, whose predecessor is the
    last row of the previous non-empty slice. That one value per slice, and
    the count of sessions begun before each slice, come from a window over
    the small per-slice summary joined back on ``(key, slice)``. Per-session
    figures are partial aggregates, so a hot key or a long session is never
    gathered into one task.
    """
    gap = F.lit(gap_seconds * 1_000_000)
    d = slices(events.select(key, "ts", "seq"), key)
    wl = Window.partitionBy(key, "slice").orderBy("ts", "seq")
    d = d.withColumn("prev_ts", F.lag("ts").over(wl))
    d = d.withColumn("local_new", F.when(F.col("prev_ts").isNotNull()
                                         & ((epoch_micros("ts") - epoch_micros("prev_ts")) >= gap), 1).otherwise(0))
    d = d.withColumn("local_no", F.sum("local_new").over(wl.rowsBetween(Window.unboundedPreceding, 0)))
    wc = Window.partitionBy(key).orderBy("slice")
    summ = (d.groupBy(key, "slice")
             .agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.sum("local_new").alias("n_new"))
             .withColumn("prev_last", F.lag("last_ts").over(wc)))
    summ = summ.withColumn("first_new", F.when(F.col("prev_last").isNull() | (
        (epoch_micros("first_ts") - epoch_micros("prev_last")) >= gap), 1).otherwise(0))
    summ = summ.withColumn("carry", F.coalesce(
        F.sum(F.col("first_new") + F.col("n_new")).over(wc.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    j = d.join(summ.select(key, "slice", "carry", "first_new"), [key, "slice"], "left")
    j = j.withColumn("session_no", (F.col("carry") + F.col("first_new") + F.col("local_no")).cast("long"))
    return (j.groupBy(key, "session_no")
             .agg(F.min("ts").alias("start_ts"), F.max("ts").alias("last_ts"), F.count(F.lit(1)).alias("n_events"))
             .select(key, "session_no", iso_millis("start_ts").alias("started_at"),
                     iso_millis("last_ts").alias("last_event_at"), "n_events"))


def session_summary(activity: DataFrame, sessions: DataFrame) -> DataFrame:
    """Per session: events, exceptions, distinct names, first/last time,
    duration and whether it is still open. Partial aggregation by session."""
    a = activity.filter(F.col("session_id").isNotNull())
    agg = (a.groupBy("session_id")
            .agg(F.sum(F.when(F.col("op") == "track", 1).otherwise(0)).cast("long").alias("n_events"),
                 F.sum(F.when(F.col("op") == "exception", 1).otherwise(0)).cast("long").alias("n_exceptions"),
                 F.countDistinct(F.when(F.col("op") == "track", F.col("name"))).alias("n_names"),
                 F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")))
    s = sessions.select("session_id", "install_id", "started_ts", "ended_ts")
    j = s.join(agg, "session_id", "left")
    return j.select(
        "session_id", "install_id",
        F.coalesce("n_events", F.lit(0)).alias("n_events"),
        F.coalesce("n_exceptions", F.lit(0)).alias("n_exceptions"),
        F.coalesce("n_names", F.lit(0)).alias("n_names"),
        iso_millis("first_ts").alias("first_event_at"), iso_millis("last_ts").alias("last_event_at"),
        ((epoch_micros("ended_ts") - epoch_micros("started_ts")) / F.lit(1000)).cast("long").alias("duration_ms"),
        F.col("ended_ts").isNull().alias("is_open"),
    )
