"""Validation, cleaning, payloads, ids, definitions and rollups of events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetscope import config as C
from fleetscope.functions.core import (actor_error, epoch_millis, is_reserved_category, iso_millis, truncate,
                                       uuid7_from_key, uuid7_is_valid, uuid7_millis)
from fleetscope.functions.props import sanitize_properties
from fleetscope.operators.scan import Scan, ordered_scan, slices

# Log level of every refusal reason.
REASON_LEVELS = {
    "disabled": "ignored",
    "opted_out": "ignored",
    "reserved_category": "warning",
    "actor_empty": "error",
    "actor_too_long": "error",
    "unknown_op": "error",
}


# ----------------------------------------------------------------- validate

def validate_actor(calls: DataFrame) -> DataFrame:
    """Add ``actor_error``: why an explicitly given actor is refused, or null.

    Applies to ``identify`` (its argument is the actor) and to calls that
    pass an explicit actor; calls without one are not checked.
    """
    op, a = F.col("op"), F.col("explicit_actor")
    checked = (op == "identify") | a.isNotNull()
    return calls.withColumn("actor_error", F.when(checked, actor_error(a)))


def reject_reserved_category(calls: DataFrame) -> DataFrame:
    """Add ``reserved``: track categories starting with ``_`` are refused."""
    return calls.withColumn("reserved", (F.col("op") == "track") & is_reserved_category("category"))


def quarantine(state: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split reconstructed calls into (accepted, refused) with reason and level."""
    reason = F.coalesce(F.col("gate_reason"), F.col("reject_reason"))
    level = F.coalesce(*[F.when(reason == k, F.lit(v)) for k, v in REASON_LEVELS.items()], F.lit("error"))
    tagged = state.withColumn("reason", reason).withColumn("level", F.when(reason.isNotNull(), level))
    return tagged.filter(F.col("accepted")), tagged.filter(~F.col("accepted"))


def observe_refusals(state: DataFrame, name: str = "refusals"):
    """Attach running metrics (calls, accepted, refused per level) to
    ``state`` with ``DataFrame.observe``; they are filled by whatever action
    runs the returned DataFrame, with no extra pass over the data.
    Returns (DataFrame, Observation)."""
    from pyspark.sql import Observation
    obs = Observation(name)
    reason = F.coalesce(F.col("gate_reason"), F.col("reject_reason"))
    lvl = lambda v: F.sum(F.when(reason.isin(*[k for k, x in REASON_LEVELS.items() if x == v]), 1)
                          .otherwise(0)).alias(f"refused_{v}")
    df = state.observe(obs, F.count(F.lit(1)).alias("calls"),
                       F.sum(F.when(F.col("accepted"), 1).otherwise(0)).alias("accepted"),
                       lvl("ignored"), lvl("warning"), lvl("error"))
    return df, obs


def reject_summary(state: DataFrame) -> DataFrame:
    """Refusals per reason, level and op (partial aggregation, no collect)."""
    _, refused = quarantine(state)
    return refused.groupBy("reason", "level", "op").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- normalise

def normalize_event(df: DataFrame) -> DataFrame:
    """Cut category to 128 and name to 256 characters."""
    return (df.withColumn("category", truncate("category", C.MAX_CATEGORY_LEN))
              .withColumn("name", truncate("name", C.MAX_NAME_LEN)))


def assign_event_ids(df: DataFrame, key_cols: list[str], ts_col: str = "ts",
                     out: str = "event_id", kind: str = "event") -> DataFrame:
    """Deterministic UUIDv7-shaped ids: time prefix from ``ts_col``, the rest
    from a hash of the key, so reruns (and retries) keep the same id."""
    return df.withColumn(out, uuid7_from_key(F.col(ts_col), *[F.col(k) for k in key_cols], F.lit(kind)))


def track_events(state: DataFrame) -> DataFrame:
    """Accepted ``track`` calls as events (ids, cleaned fields, session)."""
    ev = state.filter(F.col("accepted") & (F.col("op") == "track"))
    ev = assign_event_ids(normalize_event(ev), ["install_id", "seq"])
    return ev.select(
        "install_id", "ts", "seq", "slice", "epoch", "track_no", "event_id", "category", "name",
        iso_millis("ts").alias("timestamp"), "actor_id", "session_id",
        sanitize_properties(F.col("properties")).alias("properties"),
        "source_app", "source_version", "max_batch_size", "max_breadcrumbs", "flush_interval_seconds",
        "first_ts",
    )


PAYLOAD_FIELDS = ["actor_id", "category", "event_id", "name", "properties", "session_id",
                  "source_app", "source_version", "timestamp"]


def event_payload(events: DataFrame, out: str = "payload_json") -> DataFrame:
    """Serialise each event to JSON: keys in alphabetical order, absent
    optionals (session, properties) omitted, ISO time with milliseconds."""
    return events.withColumn(out, F.to_json(F.struct(*[F.col(c) for c in PAYLOAD_FIELDS])))


# ---------------------------------------------------------------- id audit

def audit_event_ids(df: DataFrame, id_col: str = "event_id", key: str = "install_id",
                    order: tuple[str, str] = ("ts", "seq")) -> DataFrame:
    """Check the id contract per row.

    ``valid`` -- 36 chars, hyphens, version 7, variant 8-b; ``dup_count`` --
    rows sharing the id; ``prefix_decreasing`` -- embedded time below the
    previous id's of the same key (skew-safe scan); ``drift_ms`` -- embedded
    time minus the row's own time.
    """
    ts, seq = order
    d = slices(df.select(key, ts, seq, id_col), key, ts, order=order)
    d = d.withColumn("id_ms", F.when(uuid7_is_valid(id_col), uuid7_millis(id_col)))
    d = ordered_scan(d, key, [ts, seq], [Scan("prev_id_ms", "last", F.col("id_ms"))])
    dups = df.groupBy(id_col).agg(F.count(F.lit(1)).alias("dup_count"))
    return (d.join(dups, id_col, "left")
             .select(key, ts, seq, id_col, uuid7_is_valid(id_col).alias("valid"),
                     F.col("dup_count").cast("long").alias("dup_count"),
                     F.coalesce(F.col("id_ms") < F.col("prev_id_ms"), F.lit(False)).alias("prefix_decreasing"),
                     (F.col("id_ms") - epoch_millis(ts)).alias("drift_ms")))


# ------------------------------------------------------------- definitions

def event_definitions(defs: DataFrame, by_app: bool = False) -> DataFrame:
    """Distinct declared (category, name), empties refused, sorted."""
    keys = (["source_app"] if by_app else []) + ["category", "name"]
    ok = (F.coalesce(F.length("category"), F.lit(0)) > 0) & (F.coalesce(F.length("name"), F.lit(0)) > 0)
    return defs.filter(ok).select(*keys).distinct().orderBy(*keys)


def export_manifest_rows(defs: DataFrame, apps: DataFrame) -> DataFrame:
    """One manifest document per app: schema version, app, version and the
    sorted entries, as JSON text (``manifest_json``).

    Entries are distinct definitions of one app, which are few by nature;
    they are deduplicated (shuffle with partial aggregation) before the
    per-app list is built.
    """
    d = event_definitions(defs, by_app=True)
    per_app = (d.groupBy("source_app")
                .agg(F.array_sort(F.collect_list(F.struct("category", "name"))).alias("entries")))
    m = per_app.join(apps.select(F.col("app_key").alias("source_app"),
                                 F.col("app_name"), F.col("app_version")), "source_app", "left")
    doc = F.struct(F.lit(C.MANIFEST_SCHEMA_VERSION).alias("schema_version"),
                   F.col("generated_at").alias("generated_at"),
                   F.coalesce("app_name", "source_app").alias("source_app"),
                   F.col("app_version").alias("source_version"),
                   F.col("entries"))
    return (m.withColumn("generated_at", iso_millis(F.current_timestamp().cast("timestamp_ntz")))
             .select("source_app", F.to_json(doc).alias("manifest_json")))


def check_allowlist(events: DataFrame, defs: DataFrame, target_rows: int = C.DEFAULT_TARGET_ROWS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(declared events, undeclared events, definitions never seen).

    Two stages: the distinct (app, category, name) triples are counted (a
    partial aggregate, written once) and get their verdict from the declared
    ones; the verdict then goes back to the events. Few triples are broadcast
    and no event moves. Many are joined with salts (``semi_join_counted``), so a
    triple that most events share is never one task's.
    """
    from fleetscope.operators.joins import semi_join_counted
    from fleetscope.plans.stage import stage
    keys = ["source_app", "category", "name"]
    d = event_definitions(defs, by_app=True)
    seen = events.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    seen = stage(seen.join(d.withColumn("declared", F.lit(True)), keys, "left")
                     .select(*keys, "n", F.coalesce("declared", F.lit(False)).alias("declared")), "triples")
    spread = ["install_id", "ts", "seq"]
    ok = F.col("declared")
    return (semi_join_counted(events, seen, keys, ok, spread, target_rows), semi_join_counted(events, seen, keys, ~ok, spread, target_rows),
            d.join(seen, keys, "left_anti"))


# ------------------------------------------------------------- exceptions

def exception_rollup(reports: DataFrame) -> DataFrame:
    """Reports per app, version, type and severity (all partial aggregates)."""
    return (reports.groupBy("source_app", "source_version", "exception_type", "severity")
                   .agg(F.count(F.lit(1)).alias("n_reports"),
                        F.countDistinct("actor_id").alias("n_actors"),
                        F.min("occurred_at").alias("first_at"),
                        F.max("occurred_at").alias("last_at")))


__all__ = [n for n in dir() if not n.startswith("_")]
