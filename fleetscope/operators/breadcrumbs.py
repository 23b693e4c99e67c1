"""Breadcrumbs (recent accepted tracks) and exception reports.

The client keeps a ring of the last ``n`` accepted tracks per install
(``n`` = the app's ``max_breadcrumbs``, 0 = none); ``reset`` and the end of
the process clear it, an exception report carries a snapshot, oldest first.

On tables: tracks are numbered per install (``track_no``, from the state
scan) and an exception knows how many accepted tracks came before it. Its
breadcrumbs are the tracks of the same ring (between two clears) numbered
``(t - n, t]``. Tracks are bucketed by ``(track_no - 1) div n`` and copied
into their own and the next bucket, so an exception's place finds every
candidate under one equi-join key ``(install, ring, n, bucket)``: at most
``2n`` candidates per place, never all pairs of an install. Exceptions at
the same place share one array, which is built once and joined back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetscope import config as C
from fleetscope.functions.core import iso_millis, null_if_empty, truncate, uuid7_from_key
from fleetscope.functions.props import sanitize_properties

BC_KEY = ["install_id", "ring", "bc_n", "bucket"]


def _tracks(state: DataFrame) -> DataFrame:
    t = state.filter(F.col("accepted") & (F.col("op") == "track") & (F.col("max_breadcrumbs") > 0))
    n = F.col("max_breadcrumbs").cast("long")
    # The crumb (with its cleaned properties) is built once per track, then
    # copied into the track's own bucket and the next one.
    t = t.select(
        "install_id", "ring", n.alias("bc_n"), F.col("track_no").alias("bc_no"),
        F.floor((F.col("track_no") - 1) / n).cast("long").alias("own"),
        F.named_struct(F.lit("no"), F.col("track_no"), F.lit("timestamp"), iso_millis("ts"),
                       F.lit("category"), truncate("category", C.MAX_CATEGORY_LEN),
                       F.lit("name"), truncate("name", C.MAX_NAME_LEN),
                       F.lit("properties"), sanitize_properties(F.col("properties"))).alias("crumb"))
    return t.select("install_id", "ring", "bc_n", F.explode(F.array(F.col("own"), F.col("own") + 1)).alias("bucket"),
                    "bc_no", "crumb")


TRACK_COLS = ["install_id", "ring", "track_no", "ts", "category", "name", "properties", "max_breadcrumbs"]


def candidates(ex: DataFrame, tracks: DataFrame) -> DataFrame:
    """Tracks that may be breadcrumbs of some exception, per distinct
    ``(install, epoch, n, track_no)``. Exceptions without a track between them
    (a crash loop) have the same breadcrumbs, so they are one point here: a
    bucket holds at most ``n`` points and ``2n`` tracks, whatever the number
    of exceptions."""
    n = F.col("max_breadcrumbs").cast("long")
    points = ex.filter(n > 0).select("install_id", "ring", n.alias("bc_n"), "track_no").distinct()
    points = points.withColumn("bucket", F.floor((F.col("track_no") - 1) / F.col("bc_n")).cast("long"))
    return points.join(_tracks(tracks), BC_KEY, "inner")


def breadcrumbs(state: DataFrame, rows: DataFrame | None = None, extra_tracks: DataFrame | None = None) -> DataFrame:
    """``rows`` (default: accepted exceptions of ``state``) with a
    ``breadcrumbs`` array of struct(timestamp, category, name, properties),
    oldest first; null when empty or when the app keeps none.
    ``extra_tracks`` (``TRACK_COLS``) are earlier accepted tracks kept
    outside ``state``, e.g. the ring carried by a stream snapshot.

    ``state`` is read by three branches (exception points, tracks, the final
    attach); pass a staged state (``plans.stage.stage``) when it is a
    freshly computed plan, or Spark recomputes the state scan per branch.
    A crash loop's exceptions meet one array in the final join; AQE splits
    that side when it is skewed."""
    ex = rows if rows is not None else accepted_exceptions(state)
    src = state.filter(F.col("accepted") & (F.col("op") == "track")).select(*TRACK_COLS)
    if extra_tracks is not None:
        src = src.unionByName(extra_tracks.select(*TRACK_COLS))
    j = candidates(ex, src.withColumn("accepted", F.lit(True)).withColumn("op", F.lit("track")))
    # A candidate counts when it is one of the last n tracks before the exception.
    keep = (F.col("bc_no") <= F.col("track_no")) & (F.col("bc_no") > F.col("track_no") - F.col("bc_n"))
    # Grouping keys include the join keys, so the join's partitioning is reused.
    g = (j.filter(keep).groupBy(*BC_KEY, "track_no")
          .agg(F.array_sort(F.collect_list("crumb"),
                            lambda a, b: F.signum(a["no"] - b["no"]).cast("int")).alias("__crumbs"))
          .select("install_id", "ring", F.col("bc_n").alias("__bc_n"), "track_no", "__crumbs"))
    crumbs = F.transform(F.col("__crumbs"), lambda x: F.named_struct(
        F.lit("timestamp"), x["timestamp"], F.lit("category"), x["category"], F.lit("name"), x["name"],
        F.lit("properties"), x["properties"]))
    out = ex.withColumn("__bc_n", F.col("max_breadcrumbs").cast("long")).join(
        g, ["install_id", "ring", "track_no", "__bc_n"], "left")
    return out.select(*ex.columns, crumbs.alias("breadcrumbs"))


def accepted_exceptions(state: DataFrame) -> DataFrame:
    return state.filter(F.col("accepted") & (F.col("op") == "exception"))


def report_core(ex: DataFrame, *more: str) -> DataFrame:
    """Accepted exceptions as reports: id, type, severity (default
    ``non_fatal``), time, actor (device when anonymous), message <= 1000 and
    stack <= 32768 characters (omitted when empty), session, and the columns
    ``more``. Needs no breadcrumbs."""
    return ex.select(
        "install_id", "ts", "seq", "epoch",
        uuid7_from_key(F.col("ts"), F.col("install_id"), F.col("seq"), F.lit("exception")).alias("exception_id"),
        F.col("exc_type").alias("exception_type"),
        F.coalesce(F.col("severity"), F.lit(C.SEVERITY_NON_FATAL)).alias("severity"),
        iso_millis("ts").alias("occurred_at"),
        "actor_id", "source_app", "source_version",
        null_if_empty(truncate("message", C.MAX_MESSAGE_LEN)).alias("message"),
        null_if_empty(truncate("stack_trace", C.MAX_STACK_LEN)).alias("stack_trace"),
        "session_id", *more,
    )


def exception_reports(state: DataFrame, extra_tracks: DataFrame | None = None) -> DataFrame:
    """Reports (``report_core``) with their breadcrumbs. As for
    ``breadcrumbs``, pass a staged state."""
    return report_core(breadcrumbs(state, extra_tracks=extra_tracks), "breadcrumbs")


def exception_payload(reports: DataFrame, out: str = "payload_json") -> DataFrame:
    """Report JSON with alphabetical keys; absent optionals omitted."""
    fields = ["actor_id", "breadcrumbs", "exception_id", "exception_type", "message", "occurred_at",
              "session_id", "severity", "source_app", "source_version", "stack_trace"]
    return reports.withColumn(out, F.to_json(F.struct(*[F.col(c) for c in fields])))
