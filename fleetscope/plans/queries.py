"""Registered queries: one per operator of the inventory.

Each entry is a Spark query ``(spark, sf_dir) -> DataFrame`` over the whole
driver tables, and (where SQL can express it) the DuckDB SQL that must give
the same rows. Outputs use plain types: times as ISO-8601 text, maps and
arrays flattened to rows or JSON text, integers as bigint.
"""

from __future__ import annotations

import os
import uuid as _uuid
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope import fixtures as fx
from fleetscope.config import scratch_path
from fleetscope.functions.core import iso_millis, partition_key
from fleetscope.functions.props import sanitize_properties
from fleetscope.operators import breadcrumbs as bcm
from fleetscope.operators import delivery as dv
from fleetscope.operators import environment as env
from fleetscope.operators import events as evm
from fleetscope.operators import identity as idm
from fleetscope.operators import queue as qm
from fleetscope.operators import sessions as ssm
from fleetscope.operators import stack as stm
from fleetscope.operators.config import attach_app_config, normalize_app_config
from fleetscope.operators.state import reconstruct
from fleetscope.plans import sql as S
from fleetscope.plans.stage import stage
from fleetscope.sources import explode_event_batches, export_manifest, write_event_log

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

IDLE_GAP_SECONDS = 12 * 3600
OLDEST_N = 5
SENT_PER_ROUND = 400


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def _long(c) -> F.Column:
    return (F.col(c) if isinstance(c, str) else c).cast("long")


# Columns of the state read by fan-out consumers (staged narrow).
REPORT_COLS = ["install_id", "ts", "seq", "op", "accepted", "epoch", "ring", "track_no", "category", "name", "properties",
               "max_breadcrumbs", "exc_type", "severity", "message", "stack_trace", "actor_id", "source_app",
               "source_version", "session_id"]
LINK_COLS = ["install_id", "ts", "seq", "op", "accepted", "epoch", "actor_before", "explicit_actor", "device_id",
             "source_app", "source_version"]
SESSION_COLS = ["install_id", "ts", "seq", "op", "accepted", "epoch", "new_session_id", "actor_id", "source_app",
                "source_version", "next_session_change", "session_id", "name"]


_PLANS: dict[tuple, DataFrame] = {}


def forget_plans() -> None:
    """Drop the kept plans, so that a timed query pays for its own."""
    _PLANS.clear()


def _state(spark: SparkSession, sf: str, staged: bool = False, cols: list[str] | None = None) -> DataFrame:
    """Reconstructed per-call state. ``staged`` writes it once (only
    ``cols``) when the query reads it from more than one branch.

    The logical plan (not data) is built once per session and folder:
    DataFrames are immutable and lazy, so reuse only saves plan building.
    """
    key = (id(spark), spark.sparkContext.applicationId, sf)
    if key not in _PLANS:
        _PLANS[key] = reconstruct(fx.calls(spark, sf), fx.app_config_raw(spark, sf), fx.initial_consent(spark, sf))
    st = _PLANS[key]
    if cols:
        st = st.select(*cols)
    return stage(st, "state") if staged else st


def _events(spark: SparkSession, sf: str, staged: bool = False) -> DataFrame:
    ev = evm.track_events(_state(spark, sf))
    return stage(ev, "events") if staged else ev


# ======================================================== 2.1 sources/sinks

@register("call_log", S.with_(fx.CALLS_SQL) + f"""
SELECT install_id, seq, op, {S.iso('ts')} AS ts, category, name, explicit_actor,
  CAST(cardinality(properties) AS BIGINT) AS n_properties, exc_type, severity, message, source_app FROM calls""")
def call_log(spark, sf):
    c = fx.calls(spark, sf)
    return c.select("install_id", "seq", "op", iso_millis("ts").alias("ts"), "category", "name", "explicit_actor",
                    F.when(F.col("properties").isNotNull(), F.size("properties")).cast("long").alias("n_properties"),
                    "exc_type", "severity", "message", "source_app")


@register("call_log_files", S.with_(fx.CALLS_SQL) + f"""
, c AS (SELECT install_id, seq, op, {S.iso('ts')} AS ts, category, name, CAST(cardinality(properties) AS BIGINT) AS n_properties, seq % 50 AS m FROM calls),
r AS (SELECT *, 'parquet' AS fmt, CASE WHEN m = 13 THEN 'missing_field' END AS reason FROM c
  UNION ALL SELECT *, 'json', CASE WHEN m = 7 THEN 'malformed_record' WHEN m = 11 THEN 'missing_field' END FROM c)
SELECT fmt, reason, CASE WHEN reason = 'malformed_record' THEN NULL ELSE install_id END AS install_id,
  CASE WHEN reason = 'malformed_record' THEN NULL ELSE seq END AS seq, CASE WHEN reason = 'malformed_record' THEN NULL ELSE op END AS op,
  CASE WHEN reason IS NULL THEN ts END AS ts, CASE WHEN reason IS NULL THEN n_properties END AS n_properties,
  CASE WHEN reason IS NULL THEN category END AS category, CASE WHEN reason IS NULL THEN name END AS name,
  CASE WHEN reason = 'malformed_record' THEN '{{"install_id":' || install_id || ',"seq":' || seq END AS raw FROM r""")
def call_log_files(spark, sf):
    """The call log written as Parquet (some rows without a time) and as JSON
    lines (some cut off, some without a time) and read back: calls and
    rejects, whose format is that of the file they came from."""
    from fleetscope.sources import JSON_TIME, read_call_log
    base = scratch_path(spark, f"call-log-{_uuid.uuid4().hex}")
    calls, m = fx.calls(spark, sf), F.col("seq") % 50
    calls.withColumn("ts", F.when(m != 13, F.col("ts"))).write.parquet(f"{base}/columns.parquet")
    whole = F.struct(*[(F.when(m != 11, F.col("ts")).alias("ts") if c == "ts" else F.col(c)) for c in calls.columns])
    cut = F.concat(F.lit('{"install_id":'), F.col("install_id").cast("string"), F.lit(',"seq":'), F.col("seq").cast("string"))
    line = F.when(m == 7, cut).otherwise(F.to_json(whole, {"timestampNTZFormat": JSON_TIME}))
    calls.select(line.alias("value")).write.text(f"{base}/lines.json")
    both = [read_call_log(spark, f"{base}/{name}", fmt) for name, fmt in (("columns.parquet", "parquet"), ("lines.json", "json"))]
    fmt = F.regexp_extract("source_file", r"/(?:columns|lines)\.(\w+)/", 1).alias("fmt")
    none = F.lit(None)
    good = [c.select(fmt, none.cast("string").alias("reason"), "install_id", "seq", "op", iso_millis("ts").alias("ts"),
                     F.when(F.col("properties").isNotNull(), F.size("properties")).cast("long").alias("n_properties"), "category", "name",
                     none.cast("string").alias("raw")) for c, _ in both]
    bad = [r.select(fmt, "reason", "install_id", "seq", "op", iso_millis("ts").alias("ts"), none.cast("long").alias("n_properties"),
                    none.cast("string").alias("category"), none.cast("string").alias("name"), "raw") for _, r in both]
    return good[0].unionByName(good[1]).unionByName(bad[0]).unionByName(bad[1])


_QUEUE_RN = """
qrn AS (SELECT q.*, row_number() OVER (PARTITION BY install_id ORDER BY id) AS rn, coalesce(g.max_batch_size, 25) AS b,
  CAST(coalesce(g.max_queue_size_mb, 10) AS BIGINT) * 1048576 AS cap FROM queue q LEFT JOIN cfg g ON g.app_key = q.app)"""
# Two installs only, so that their queues outgrow the smallest cap.
_FULL_QUEUE_SQL = fx.QUEUE_SQL.replace("o_custkey % 20", "o_custkey % 2")
_QUEUE = (fx.APP_CONFIG_SQL, S.CFG_SQL, fx.QUEUE_SQL, _QUEUE_RN)


def _limited(spark: SparkSession, sf: str, installs: int = 20) -> DataFrame:
    """The durable queue with the batch size and byte cap of each row's app."""
    q = fx.queue(spark, sf, installs).withColumnRenamed("app", "source_app")
    q = attach_app_config(q, fx.app_config_raw(spark, sf))
    return q.withColumn("cap", F.col("max_queue_size_mb").cast("long") * 1048576)


def _batches(spark: SparkSession, sf: str, rows: DataFrame | None = None) -> DataFrame:
    q = _limited(spark, sf) if rows is None else rows
    return qm.form_batches(q, "max_batch_size")


@register("explode_batches", S.with_(*_QUEUE) + f"""
SELECT install_id, CAST((rn - 1) // b AS BIGINT) AS batch_no, CAST((rn - 1) % b AS BIGINT) AS pos,
  json_extract_string(payload_json, '$.event_id') AS event_id, json_extract_string(payload_json, '$.category') AS category,
  json_extract_string(payload_json, '$.name') AS name, json_extract_string(payload_json, '$.actor_id') AS actor_id,
  json_extract_string(payload_json, '$.timestamp') AS "timestamp" FROM qrn""")
def explode_batches(spark, sf):
    b = _batches(spark, sf)
    ok, _bad = explode_event_batches(b.select("install_id", "batch_no", "body"), key=["install_id", "batch_no"])
    return ok.select("install_id", "batch_no", _long("pos").alias("pos"), "event_id", "category", "name", "actor_id",
                     "timestamp")


@register("batch_quarantine", S.with_(*_QUEUE) + f"""
, bodies AS (SELECT install_id, CAST((rn - 1) // b AS BIGINT) AS batch_no, '[' || string_agg(payload_json, ',' ORDER BY id) || ']' AS body FROM qrn GROUP BY ALL)
SELECT install_id, batch_no, CAST(NULL AS BIGINT) AS pos, 'body_not_json_array' AS reason, left(body, length(body) - 1) AS raw FROM bodies WHERE batch_no % 5 = 1
UNION ALL SELECT install_id, batch_no, 0, 'element_not_object', '5' FROM bodies WHERE batch_no % 5 = 2
UNION ALL SELECT install_id, batch_no, 0, 'element_without_event_id', '{{"category":"x"}}' FROM bodies WHERE batch_no % 5 = 3""")
def batch_quarantine(spark, sf):
    """Damaged bodies and elements, with their text (fixture: one in five
    bodies is cut short, one holds a number, one an element without an id)."""
    b = _batches(spark, sf).select("install_id", "batch_no", "body")
    rest = F.substr("body", F.lit(2))
    kind = F.col("batch_no") % 5
    b = b.withColumn("body", F.when(kind == 1, F.left("body", F.length("body") - 1)).when(kind == 2, F.concat(F.lit("[5,"), rest))
                     .when(kind == 3, F.concat(F.lit('[{"category":"x"},'), rest)).otherwise(F.col("body")))
    _ok, bad = explode_event_batches(b, key=["install_id", "batch_no"])
    return bad.select("install_id", "batch_no", _long("pos").alias("pos"), "reason", "raw")


@register("event_log", S.with_(fx.QUEUE_SQL) + f"""
SELECT install_id, id, json_extract_string(payload_json, '$.event_id') AS event_id, {S.iso('queued_at')} AS queued_at,
  CAST(0 AS BIGINT) AS retry_count, 'shop' AS app_key, strftime(queued_at, '%Y-%m') AS event_period FROM queue""")
def event_log(spark, sf):
    q = fx.queue(spark, sf)
    rows = qm.spill_rows(q).withColumn("source_app", F.get_json_object("payload_json", "$.source_app"))
    path = scratch_path(spark, f"event_log-{_uuid.uuid4().hex}")
    write_event_log(rows, path, granularity="month")
    back = spark.read.option("basePath", path).schema(
        "install_id long, id long, event_id string, payload_json string, queued_at string, retry_count int, "
        "source_app string, app_key string, event_period string").parquet(path)
    return back.select("install_id", "id", "event_id", "queued_at", _long("retry_count").alias("retry_count"),
                       "app_key", "event_period")


@register("oldest_n", S.with_(*_QUEUE) + f"""
SELECT install_id, id, payload_json FROM qrn WHERE rn <= {OLDEST_N}""")
def oldest_n(spark, sf):
    return qm.read_oldest(fx.queue(spark, sf), OLDEST_N).select("install_id", "id", "payload_json")


@register("ack_anti_join", S.with_(fx.QUEUE_SQL) + """
SELECT q.install_id, q.id FROM queue q
WHERE NOT EXISTS (SELECT 1 FROM queue a WHERE a.o_orderstatus = 'F' AND a.install_id = q.install_id AND a.id = q.id)""")
def ack_anti_join(spark, sf):
    q = fx.queue(spark, sf)
    acked = q.filter(F.col("o_orderstatus") == "F")
    return qm.ack_delivered(q, acked).select("install_id", "id")


def _snapshot_rounds_sql() -> str:
    """Three rounds of enqueue, acknowledge and cap, as the client runs them."""
    out, held = ", w0 AS (SELECT * FROM qrn WHERE FALSE)", "w0"
    for r in range(3):
        out += f"""
, e{r} AS (SELECT * FROM {held} UNION ALL SELECT * FROM qrn WHERE id % 3 = {r}),
a{r} AS (SELECT * EXCLUDE (place) FROM (SELECT *, row_number() OVER (PARTITION BY install_id ORDER BY id) AS place FROM e{r})
  WHERE NOT (place <= {SENT_PER_ROUND} AND o_orderstatus = 'F')),
p{r} AS (SELECT *, row_number() OVER v AS place, sum(strlen(payload_json)) OVER v AS prefix,
  sum(strlen(payload_json)) OVER (PARTITION BY install_id) AS total, count(*) OVER (PARTITION BY install_id) AS cnt
  FROM a{r} WINDOW v AS (PARTITION BY install_id ORDER BY id ROWS UNBOUNDED PRECEDING)),
c{r} AS (SELECT install_id, min(place) AS cut FROM p{r} WHERE (place % 100 = 0 OR place = cnt) AND total - prefix < cap GROUP BY install_id),
w{r + 1} AS (SELECT p{r}.* EXCLUDE (place, prefix, total, cnt) FROM p{r} LEFT JOIN c{r} ON c{r}.install_id = p{r}.install_id
  WHERE NOT (p{r}.total >= p{r}.cap AND p{r}.place <= coalesce(c{r}.cut, p{r}.cnt)))"""
        held = f"w{r + 1}"
    rounds = " UNION ALL ".join(f"SELECT CAST({r} AS BIGINT) AS round, * FROM w{r + 1}" for r in range(3))
    return out + f"""
SELECT round, install_id, id, json_extract_string(payload_json, '$.event_id') AS event_id, {S.iso('queued_at')} AS queued_at FROM ({rounds})"""


@register("queue_snapshots", S.with_(fx.APP_CONFIG_SQL, S.CFG_SQL, _FULL_QUEUE_SQL, _QUEUE_RN) + _snapshot_rounds_sql())
def queue_snapshots(spark, sf):
    """The queue kept as published snapshots: in three rounds a third of the
    rows arrives, the oldest rows are sent (fixture: those of status F are
    acknowledged) and each install is held to its app's cap. Rows of the
    snapshot that each round ends with."""
    from fleetscope.streaming.queue_store import QueueStore
    store = QueueStore(spark, scratch_path(spark, f"queue-{_uuid.uuid4().hex}"), keep=9)
    limited = _limited(spark, sf, 2)
    caps = stage(limited.groupBy("install_id").agg(F.max("cap").alias("cap")), "caps")
    delivered = limited.filter("o_orderstatus = 'F'").select("install_id", "id")
    rows = qm.spill_rows(limited)
    ends = []
    for r in range(3):
        store.enqueue(3 * r, rows.filter(F.col("id") % 3 == r))
        store.ack(3 * r + 1, store.oldest(SENT_PER_ROUND).join(delivered, ["install_id", "id"], "left_semi"))
        store.cap(3 * r + 2, caps)
        ends.append(store.snapshot().select(F.lit(r).cast("long").alias("round"), "install_id", "id", "event_id", "queued_at"))
    return ends[0].unionByName(ends[1]).unionByName(ends[2])


@register("delivery_order", S.with_(*S.BASE_STATE, fx.QUEUE_SQL) + """
, u AS (
  SELECT install_id, 'durable' AS origin, 0 AS r, queued_at AS ts, id AS seq FROM queue
  UNION ALL SELECT install_id, 'memory', 1, ts, seq FROM state WHERE accepted AND op = 'track')
SELECT install_id, origin, seq, CAST(row_number() OVER (PARTITION BY install_id ORDER BY r, ts, seq) AS BIGINT) AS delivery_pos FROM u""")
def delivery_order(spark, sf):
    q = fx.queue(spark, sf).select("install_id", F.col("queued_at").alias("ts"), F.col("id").alias("seq"))
    m = _state(spark, sf).filter("accepted AND op = 'track'").select("install_id", "ts", "seq")
    return qm.delivery_order(q, m).select("install_id", "origin", "seq", "delivery_pos")


@register("manifest", S.with_(fx.APP_CONFIG_SQL, S.CFG_SQL, fx.DEFINITIONS_SQL) + """
, d AS (SELECT DISTINCT source_app, category, name FROM declared WHERE length(category) > 0 AND length(name) > 0)
SELECT coalesce(c.app_name, d.source_app) AS source_app, '1' AS schema_version, c.app_version AS source_version,
  CAST(row_number() OVER (PARTITION BY d.source_app ORDER BY d.category, d.name) - 1 AS BIGINT) AS pos, d.category, d.name
FROM d LEFT JOIN cfg c ON c.app_key = d.source_app""")
def manifest(spark, sf):
    m = evm.export_manifest_rows(fx.declared_definitions(spark, sf), normalize_app_config(fx.app_config_raw(spark, sf)))
    # Through the sink: one JSON document per app folder, read back as text.
    path = scratch_path(spark, f"manifest-{_uuid.uuid4().hex}")
    export_manifest(m, path)
    doc = F.from_json("value", "schema_version string, source_app string, source_version string, "
                               "entries array<struct<category:string,name:string>>")
    p = spark.read.text(path).select(doc.alias("d"))
    return p.select(F.col("d.source_app").alias("source_app"), F.col("d.schema_version").alias("schema_version"),
                    F.col("d.source_version").alias("source_version"),
                    F.posexplode("d.entries").alias("pos", "e")).select(
        "source_app", "schema_version", "source_version", _long("pos").alias("pos"),
        F.col("e.category").alias("category"), F.col("e.name").alias("name"))


@register("partition_keys", """
SELECT page_id, translate(url, '/\\:*?"<>|', '_________') AS app_key FROM pages""")
def partition_keys(spark, sf):
    return fx.app_names(spark, sf).select("page_id", partition_key("app_name").alias("app_key"))


# ============================================ 2.2 projection / validation

@register("gate_calls", S.with_(*S.BASE_STATE) + """
SELECT install_id, seq, op, opted_out_before, gate_reason FROM state""")
def gate_calls(spark, sf):
    return _state(spark, sf).select("install_id", "seq", "op", "opted_out_before", "gate_reason")


@register("validate_actor", S.with_(fx.CALLS_SQL) + f"""
SELECT install_id, seq, op, {S.actor_err('explicit_actor')} AS actor_error FROM calls
WHERE op = 'identify' OR explicit_actor IS NOT NULL""")
def validate_actor(spark, sf):
    v = evm.validate_actor(fx.calls(spark, sf))
    return v.filter((F.col("op") == "identify") | F.col("explicit_actor").isNotNull()) \
            .select("install_id", "seq", "op", "actor_error")


@register("reserved_category", S.with_(fx.CALLS_SQL) + """
SELECT install_id, seq, category, coalesce(starts_with(category, '_'), FALSE) AS reserved FROM calls WHERE op = 'track'""")
def reserved_category(spark, sf):
    r = evm.reject_reserved_category(fx.calls(spark, sf))
    return r.filter(F.col("op") == "track").select("install_id", "seq", "category", "reserved")


@register("reject_summary", S.with_(*S.BASE_STATE) + """
, r AS (SELECT op, coalesce(gate_reason, reject_reason) AS reason FROM state WHERE NOT accepted)
SELECT reason, CASE WHEN reason IN ('disabled', 'opted_out') THEN 'ignored' WHEN reason = 'reserved_category' THEN 'warning'
  ELSE 'error' END AS level, op, CAST(count(*) AS BIGINT) AS n FROM r GROUP BY ALL""")
def reject_summary(spark, sf):
    return evm.reject_summary(_state(spark, sf))


@register("normalize_event", """
SELECT doc_id, left(text, 128) AS category, left(text, 256) AS name FROM documents""")
def normalize_event(spark, sf):
    d = fx.table(spark, sf, "documents").select("doc_id", F.col("text").alias("category"), F.col("text").alias("name"))
    return evm.normalize_event(d)


@register("sanitize_properties", S.with_(fx.DOC_PROPS_SQL) + f"""
, p0 AS (SELECT doc_id, {S.sanitized_entries('properties')} AS pe FROM doc_props),
p1 AS (SELECT doc_id, {S.dedup_entries('pe')} AS pe FROM p0),
p2 AS (SELECT doc_id, unnest(pe) AS e FROM p1)
SELECT doc_id, e.key AS key, e.value AS value FROM p2""")
def sanitize_properties_q(spark, sf):
    d = fx.document_properties(spark, sf)
    # The cleaned map is no column of its own: Spark would filter on its size
    # below the explode and clean every map once more for that.
    return d.select("doc_id", F.explode(sanitize_properties(F.col("properties"))).alias("key", "value"))


@register("event_payload", S.with_(*S.BASE_STATE, S.EVENTS_SQL) + f"""
SELECT install_id, seq, '{{"actor_id":' || to_json(actor_id) || ',"category":' || to_json(category) ||
  ',"event_id":' || to_json(event_id) || ',"name":' || to_json(name) ||
  coalesce(',"properties":' || {S.json_obj_from_entries('props')}, '') ||
  coalesce(',"session_id":' || to_json(session_id), '') ||
  ',"source_app":' || to_json(source_app) || coalesce(',"source_version":' || to_json(source_version), '') ||
  ',"timestamp":' || to_json("timestamp") || '}}' AS payload_json
FROM events_t""")
def event_payload(spark, sf):
    return evm.event_payload(_events(spark, sf)).select("install_id", "seq", "payload_json")


@register("assign_ids", S.with_(*S.BASE_STATE, S.EVENTS_SQL) + """
SELECT install_id, seq, event_id FROM events_t""")
def assign_ids(spark, sf):
    return _events(spark, sf).select("install_id", "seq", "event_id")


_UUID_RE = "^[0-9a-f]{8}-[0-9a-f]{4}-7[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$"


@register("audit_ids", S.with_(*S.BASE_STATE, S.EVENTS_SQL) + f"""
, a AS (SELECT install_id, ts, seq, event_id, coalesce(regexp_matches(event_id, '{_UUID_RE}'), FALSE) AS valid,
   CASE WHEN coalesce(regexp_matches(event_id, '{_UUID_RE}'), FALSE)
        THEN CAST(('0x' || substr(event_id, 1, 8) || substr(event_id, 10, 4)) AS BIGINT) END AS id_ms FROM events_t)
SELECT install_id, seq, event_id, valid, CAST(count(*) OVER (PARTITION BY event_id) AS BIGINT) AS dup_count,
  coalesce(id_ms < last_value(id_ms IGNORE NULLS) OVER (PARTITION BY install_id ORDER BY ts, seq
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), FALSE) AS prefix_decreasing,
  id_ms - epoch_us(ts) // 1000 AS drift_ms FROM a""")
def audit_ids(spark, sf):
    return evm.audit_event_ids(_events(spark, sf, staged=True)).select(
        "install_id", "seq", "event_id", "valid", "dup_count", "prefix_decreasing", "drift_ms")


@register("app_config", S.with_(fx.APP_CONFIG_SQL, S.CFG_SQL) + """
SELECT * FROM cfg""")
def app_config(spark, sf):
    return normalize_app_config(fx.app_config_raw(spark, sf))


# ===================================================================== joins

@register("attach_config", S.with_(fx.CALLS_SQL, fx.APP_CONFIG_SQL, S.CFG_SQL) + """
SELECT c.install_id, c.seq, coalesce(g.app_name, left(c.source_app, 128)) AS source_app, g.app_version AS source_version,
  coalesce(g.enabled, FALSE) AS enabled, coalesce(g.flush_interval_seconds, 60) AS flush_interval_seconds,
  coalesce(g.max_batch_size, 25) AS max_batch_size, coalesce(g.max_breadcrumbs, 25) AS max_breadcrumbs
FROM calls c LEFT JOIN cfg g ON c.source_app = g.app_key""")
def attach_config(spark, sf):
    a = attach_app_config(fx.calls(spark, sf), fx.app_config_raw(spark, sf))
    return a.select("install_id", "seq", "source_app", "source_version", "enabled", "flush_interval_seconds",
                    "max_batch_size", "max_breadcrumbs")


_DECLARED = """
, dd AS (SELECT DISTINCT source_app, category, name FROM declared WHERE length(category) > 0 AND length(name) > 0)"""


@register("undeclared_events", S.with_(*S.BASE_STATE, S.EVENTS_SQL, fx.DEFINITIONS_SQL) + _DECLARED + """
SELECT install_id, seq, source_app, category, name FROM events_t e
WHERE NOT EXISTS (SELECT 1 FROM dd WHERE dd.source_app = e.source_app AND dd.category = e.category AND dd.name = e.name)""")
def undeclared_events(spark, sf):
    _, undeclared, _ = evm.check_allowlist(_events(spark, sf), fx.declared_definitions(spark, sf))
    return undeclared.select("install_id", "seq", "source_app", "category", "name")


@register("unused_definitions", S.with_(*S.BASE_STATE, S.EVENTS_SQL, fx.DEFINITIONS_SQL) + _DECLARED + """
SELECT source_app, category, name FROM dd
WHERE NOT EXISTS (SELECT 1 FROM events_t e WHERE dd.source_app = e.source_app AND dd.category = e.category AND dd.name = e.name)""")
def unused_definitions(spark, sf):
    _, _, unused = evm.check_allowlist(_events(spark, sf), fx.declared_definitions(spark, sf))
    return unused.select("source_app", "category", "name")


_LINKS_SQL = f"""
, l0 AS (SELECT install_id, ts, seq, device_id AS anonymous_actor_id, explicit_actor AS identified_actor_id,
   source_app, source_version FROM state
   WHERE accepted AND op = 'identify' AND coalesce(actor_before, '') <> explicit_actor),
links AS (SELECT *, identified_actor_id <> first_value(identified_actor_id) OVER (PARTITION BY anonymous_actor_id ORDER BY ts, seq
   ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS conflict FROM l0)"""


@register("identity_links", S.with_(*S.BASE_STATE) + _LINKS_SQL + f"""
SELECT install_id, seq, anonymous_actor_id, identified_actor_id, {S.iso('ts')} AS identified_at, source_app,
  source_version, conflict FROM links""")
def identity_links(spark, sf):
    return idm.identity_links(_state(spark, sf, staged=True, cols=LINK_COLS)).select(
        "install_id", "seq", "anonymous_actor_id", "identified_actor_id", "identified_at", "source_app",
        "source_version", "conflict")


@register("stitched_events", S.with_(*S.BASE_STATE, S.EVENTS_SQL) + _LINKS_SQL + """
, won AS (SELECT DISTINCT anonymous_actor_id, identified_actor_id FROM links WHERE NOT conflict)
SELECT e.install_id, e.seq, e.actor_id, coalesce(w.identified_actor_id, e.actor_id) AS stitched_actor_id
FROM events_t e LEFT JOIN won w ON e.actor_id = w.anonymous_actor_id""")
def stitched_events(spark, sf):
    st = _state(spark, sf, staged=True)
    s = idm.stitch_identity(evm.track_events(st), idm.identity_links(st))
    return s.select("install_id", "seq", "actor_id", "stitched_actor_id")


@register("session_range_join", S.with_(*S.BASE_STATE, S.SESSIONS_SQL) + """
SELECT e.install_id, e.seq, s.session_id FROM state e LEFT JOIN sessions s
  ON e.install_id = s.install_id AND (s.started_ts < e.ts OR (s.started_ts = e.ts AND s.start_seq < e.seq))
 AND (s.ended_ts IS NULL OR e.ts < s.ended_ts OR (e.ts = s.ended_ts AND e.seq < s.end_seq))
 AND (s.lost_ts IS NULL OR e.ts < s.lost_ts OR (e.ts = s.lost_ts AND e.seq < s.lost_seq))
WHERE e.accepted AND e.op IN ('track', 'exception')""")
def session_range_join(spark, sf):
    st = _state(spark, sf, staged=True, cols=SESSION_COLS)
    ev = st.filter("accepted AND op IN ('track', 'exception')")
    return ssm.events_with_session(ev, ssm.build_sessions(st)).select("install_id", "seq", "session_id")


# ============================================================= aggregations

@register("queue_depth", S.with_(fx.QUEUE_SQL) + """
SELECT install_id, CAST(count(*) AS BIGINT) AS n_pending, CAST(sum(strlen(payload_json)) AS BIGINT) AS bytes
FROM queue GROUP BY install_id""")
def queue_depth(spark, sf):
    return qm.queue_depth(fx.queue(spark, sf))


@register("event_definitions", S.with_(fx.DEFINITIONS_SQL) + """
SELECT DISTINCT category, name FROM declared WHERE length(category) > 0 AND length(name) > 0""")
def event_definitions(spark, sf):
    return evm.event_definitions(fx.declared_definitions(spark, sf))


@register("session_summary", S.with_(*S.BASE_STATE, S.SESSIONS_SQL) + f"""
, a AS (SELECT session_id, CAST(sum(CASE WHEN op = 'track' THEN 1 ELSE 0 END) AS BIGINT) AS n_events,
   CAST(sum(CASE WHEN op = 'exception' THEN 1 ELSE 0 END) AS BIGINT) AS n_exceptions,
   CAST(count(DISTINCT CASE WHEN op = 'track' THEN name END) AS BIGINT) AS n_names, min(ts) AS first_ts, max(ts) AS last_ts
   FROM state WHERE accepted AND op IN ('track', 'exception') AND session_id IS NOT NULL GROUP BY session_id)
SELECT s.session_id, s.install_id, coalesce(a.n_events, 0) AS n_events, coalesce(a.n_exceptions, 0) AS n_exceptions,
  coalesce(a.n_names, 0) AS n_names, {S.iso('a.first_ts')} AS first_event_at, {S.iso('a.last_ts')} AS last_event_at,
  (epoch_us(s.ended_ts) - epoch_us(s.started_ts)) // 1000 AS duration_ms, s.ended_ts IS NULL AS is_open
FROM sessions s LEFT JOIN a ON a.session_id = s.session_id""")
def session_summary(spark, sf):
    st = _state(spark, sf, staged=True, cols=SESSION_COLS)
    act = st.filter("accepted AND op IN ('track', 'exception')").select("session_id", "op", "name", "ts")
    return ssm.session_summary(act, ssm.build_sessions(st)).withColumn("n_names", _long("n_names"))


_REPORTS_SQL = f"""
, bcagg AS (SELECT install_id, seq, count(*) AS n_bc, string_agg(name, ',' ORDER BY no) AS bc_names FROM bc GROUP BY ALL),
reports AS (
  SELECT e.install_id, e.seq, {S.uuid('e.ts', 'e.install_id', 'e.seq', "'exception'")} AS exception_id,
    e.exc_type AS exception_type, coalesce(e.severity, 'non_fatal') AS severity, {S.iso('e.ts')} AS occurred_at,
    e.actor_id, e.source_app, e.source_version, nullif(left(e.message, 1000), '') AS message,
    nullif(left(e.stack_trace, 32768), '') AS stack_trace, e.session_id,
    CAST(coalesce(b.n_bc, 0) AS BIGINT) AS n_breadcrumbs, b.bc_names AS breadcrumb_names
  FROM exc e LEFT JOIN bcagg b ON b.install_id = e.install_id AND b.seq = e.seq)"""


@register("exception_rollup", S.with_(*S.BASE_STATE, S.BREADCRUMBS_SQL) + _REPORTS_SQL + """
SELECT source_app, source_version, exception_type, severity, CAST(count(*) AS BIGINT) AS n_reports,
  CAST(count(DISTINCT actor_id) AS BIGINT) AS n_actors, min(occurred_at) AS first_at, max(occurred_at) AS last_at
FROM reports GROUP BY ALL""")
def exception_rollup(spark, sf):
    return evm.exception_rollup(bcm.report_core(bcm.accepted_exceptions(_state(spark, sf))))


# ========================================================= stateful (2.5)

@register("consent_state", S.with_(*S.BASE_STATE) + """
SELECT install_id, seq, op, opted_out_before, opted_out_after FROM state""")
def consent_state(spark, sf):
    return _state(spark, sf).select("install_id", "seq", "op", "opted_out_before", "opted_out_after")


@register("consent_intervals", S.with_(*S.BASE_STATE) + f"""
SELECT install_id, seq, {S.iso('ts')} AS opted_out_at, {S.iso('next_consent_change_ts')} AS opted_in_at
FROM state WHERE op = 'opt_out' AND NOT opted_out_before""")
def consent_intervals(spark, sf):
    s = _state(spark, sf).filter((F.col("op") == "opt_out") & ~F.col("opted_out_before"))
    return s.select("install_id", "seq", iso_millis("ts").alias("opted_out_at"),
                    iso_millis("next_consent_change_ts").alias("opted_in_at"))


@register("device_epochs", S.with_(*S.BASE_STATE) + """
SELECT install_id, seq, epoch, device_id FROM state""")
def device_epochs(spark, sf):
    return _state(spark, sf).select("install_id", "seq", "epoch", "device_id")


@register("resolve_actor", S.with_(*S.BASE_STATE) + """
SELECT install_id, seq, op, actor_id FROM state
WHERE accepted AND op IN ('track', 'exception', 'start_session', 'identify')""")
def resolve_actor(spark, sf):
    return (_state(spark, sf).filter("accepted AND op IN ('track', 'exception', 'start_session', 'identify')")
            .select("install_id", "seq", "op", "actor_id"))


@register("assign_session", S.with_(*S.BASE_STATE) + """
SELECT install_id, seq, op, session_id FROM state WHERE accepted AND op IN ('track', 'exception')""")
def assign_session(spark, sf):
    return ssm.assign_session(_state(spark, sf)).select("install_id", "seq", "op", "session_id")


@register("sessions", S.with_(*S.BASE_STATE, S.SESSIONS_SQL) + f"""
SELECT install_id, session_id, actor_id, {S.iso('started_ts')} AS started_at, {S.iso('ended_ts')} AS ended_at,
  ended_by, end_reason, {S.iso('lost_ts')} AS lost_at FROM sessions""")
def sessions(spark, sf):
    s = ssm.build_sessions(_state(spark, sf))
    return s.select("install_id", "session_id", "actor_id", iso_millis("started_ts").alias("started_at"),
                    iso_millis("ended_ts").alias("ended_at"), "ended_by", "end_reason", iso_millis("lost_ts").alias("lost_at"))


@register("breadcrumbs", S.with_(*S.BASE_STATE, S.BREADCRUMBS_SQL) + f"""
SELECT install_id, seq, CAST(row_number() OVER (PARTITION BY install_id, seq ORDER BY no) - 1 AS BIGINT) AS pos,
  "timestamp", category, name, {S.json_obj_from_entries('props')} AS properties_json FROM bc""")
def breadcrumbs(spark, sf):
    b = bcm.breadcrumbs(_state(spark, sf, staged=True, cols=REPORT_COLS)).filter(F.col("breadcrumbs").isNotNull())
    e = b.select("install_id", "seq", F.posexplode("breadcrumbs").alias("pos", "c"))
    return e.select("install_id", "seq", _long("pos").alias("pos"), F.col("c.timestamp").alias("timestamp"),
                    F.col("c.category").alias("category"), F.col("c.name").alias("name"),
                    F.to_json(F.col("c.properties")).alias("properties_json"))


@register("exception_reports", S.with_(*S.BASE_STATE, S.BREADCRUMBS_SQL) + _REPORTS_SQL + """
SELECT * FROM reports""")
def exception_reports(spark, sf):
    return _report_columns(bcm.exception_reports(_state(spark, sf, staged=True, cols=REPORT_COLS)))


def _report_columns(r: DataFrame) -> DataFrame:
    return r.select("install_id", "seq", "exception_id", "exception_type", "severity", "occurred_at", "actor_id",
                    "source_app", "source_version", "message", "stack_trace", "session_id",
                    F.coalesce(F.size("breadcrumbs"), F.lit(0)).cast("long").alias("n_breadcrumbs"),
                    F.array_join(F.transform("breadcrumbs", lambda x: x["name"]), ",").alias("breadcrumb_names"))


@register("idle_sessions", S.with_(fx.CALLS_SQL) + f"""
, g AS (SELECT install_id, ts, seq, CASE WHEN lag(ts) OVER (PARTITION BY install_id ORDER BY ts, seq) IS NULL
   OR epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY install_id ORDER BY ts, seq)) >= {IDLE_GAP_SECONDS * 1_000_000}
   THEN 1 ELSE 0 END AS is_new FROM calls),
n AS (SELECT *, sum(is_new) OVER (PARTITION BY install_id ORDER BY ts, seq ROWS UNBOUNDED PRECEDING) AS session_no FROM g)
SELECT install_id, CAST(session_no AS BIGINT) AS session_no, {S.iso('min(ts)')} AS started_at,
  {S.iso('max(ts)')} AS last_event_at, CAST(count(*) AS BIGINT) AS n_events FROM n GROUP BY install_id, session_no""")
def idle_sessions(spark, sf):
    return ssm.idle_sessions(fx.calls(spark, sf), IDLE_GAP_SECONDS)


# ===================================================== sort / limit / retention

@register("form_batches", S.with_(*_QUEUE) + f"""
SELECT install_id, CAST((rn - 1) // b AS BIGINT) AS batch_no, CAST(count(*) AS BIGINT) AS n_events, min(id) AS first_id,
  '[' || string_agg(payload_json, ',' ORDER BY id) || ']' AS body FROM qrn GROUP BY ALL""")
def form_batches(spark, sf):
    return _batches(spark, sf)


@register("cap_queue", S.with_(fx.APP_CONFIG_SQL, S.CFG_SQL, _FULL_QUEUE_SQL, _QUEUE_RN) + """
, p AS (SELECT install_id, id, cap, row_number() OVER w AS rn, sum(strlen(payload_json)) OVER w AS prefix,
   sum(strlen(payload_json)) OVER (PARTITION BY install_id) AS total, count(*) OVER (PARTITION BY install_id) AS cnt
   FROM qrn WINDOW w AS (PARTITION BY install_id ORDER BY id ROWS UNBOUNDED PRECEDING)),
c AS (SELECT install_id, min(rn) AS cut FROM p WHERE (rn % 100 = 0 OR rn = cnt) AND total - prefix < cap GROUP BY install_id)
SELECT p.install_id, p.id, p.rn <= CASE WHEN p.total < p.cap THEN 0 ELSE coalesce(c.cut, p.cnt) END AS evicted
FROM p LEFT JOIN c ON c.install_id = p.install_id""")
def cap_queue(spark, sf):
    return qm.cap_queue(_limited(spark, sf, 2), "cap").select("install_id", "id", "evicted")


# ==================================================== delivery log analytics

@register("classify_attempts", S.with_(fx.ATTEMPTS_SQL, S.ATT_CLASS_SQL) + """
SELECT install_id, batch_id, attempt_no, attempt_class, attempt_class = 'retryable' AS retryable,
  attempt_class IN ('permanent', 'halt', 'payment') AS permanent, retry_after_s FROM att3""")
def classify_attempts(spark, sf):
    return dv.classify_attempts(fx.attempts(spark, sf)).select(
        "install_id", "batch_id", "attempt_no", "attempt_class", "retryable", "permanent", "retry_after_s")


@register("retry_schedule", S.with_(fx.ATTEMPTS_SQL, S.ATT_CLASS_SQL) + """
, r AS (SELECT *, lag(retry_after_s) OVER (PARTITION BY install_id, batch_id ORDER BY attempt_no) AS prev_hint,
   CAST(least(1000 * CAST(pow(2, least(attempt_no - 1, 16)) AS BIGINT), 60000) AS BIGINT) AS base,
   attempt_no = 0 OR (origin = 'memory' AND attempt_no <= 3 AND coalesce(bool_and(attempt_class = 'retryable')
     OVER (PARTITION BY install_id, batch_id ORDER BY attempt_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), TRUE)) AS planned FROM att3),
d AS (SELECT *, CASE WHEN NOT planned THEN NULL WHEN attempt_no = 0 THEN 0 WHEN prev_hint IS NOT NULL THEN CAST(prev_hint AS BIGINT) * 1000 ELSE base END AS delay_ms,
   CAST(floor(base * 0.2) AS BIGINT) AS band FROM r)
SELECT install_id, batch_id, attempt_no, delay_ms,
  CASE WHEN planned AND attempt_no > 0 AND prev_hint IS NULL THEN greatest(1, base - band) ELSE delay_ms END AS delay_min_ms,
  CASE WHEN planned AND attempt_no > 0 AND prev_hint IS NULL THEN base + band ELSE delay_ms END AS delay_max_ms,
  CAST(CASE WHEN planned THEN sum(delay_ms) OVER (PARTITION BY install_id, batch_id ORDER BY attempt_no ROWS UNBOUNDED PRECEDING) END AS BIGINT) AS planned_offset_ms
FROM d""")
def retry_schedule(spark, sf):
    return dv.retry_schedule(fx.attempts(spark, sf)).select(
        "install_id", "batch_id", "attempt_no", "delay_ms", "delay_min_ms", "delay_max_ms", "planned_offset_ms")


@register("batch_disposition", S.with_(fx.ATTEMPTS_SQL, S.ATT_CLASS_SQL, S.DISPOSITION_SQL) + """
SELECT install_id, batch_id, origin, decided_at_attempt, deciding_status, deciding_class, disposition, status_after FROM disp""")
def batch_disposition(spark, sf):
    return dv.batch_disposition(fx.attempts(spark, sf)).select(
        "install_id", "batch_id", "origin", "decided_at_attempt", "deciding_status", "deciding_class", "disposition",
        "status_after")


_BOUNDARIES_SQL = """
, bounds AS (SELECT DISTINCT o_custkey % 50 AS install_id, CAST(o_orderdate AS TIMESTAMP) AS ts FROM orders WHERE o_orderpriority = '5-LOW' AND o_orderkey % 40 = 7)"""


def _boundaries(spark, sf):
    """Process boundaries of the delivery installs (fixture: some low-priority orders)."""
    o = fx.table(spark, sf, "orders").filter((F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderkey") % 40 == 7))
    return o.select((F.col("o_custkey") % 50).alias("install_id"), F.col("o_orderdate").cast("timestamp_ntz").alias("ts"))


@register("halted_batches", S.with_(fx.ATTEMPTS_SQL, S.ATT_CLASS_SQL, S.DISPOSITION_SQL) + _BOUNDARIES_SQL + """
SELECT d.install_id, d.batch_id, EXISTS (SELECT 1 FROM disp h WHERE h.install_id = d.install_id AND h.deciding_class = 'halt'
    AND (h.first_attempt_at < d.first_attempt_at OR (h.first_attempt_at = d.first_attempt_at AND h.batch_id < d.batch_id))
    AND NOT EXISTS (SELECT 1 FROM bounds b WHERE b.install_id = d.install_id AND b.ts > h.first_attempt_at AND b.ts <= d.first_attempt_at)) AS held
FROM disp d""")
def halted_batches(spark, sf):
    held = dv.apply_halt(dv.batch_disposition(fx.attempts(spark, sf)), _boundaries(spark, sf))
    return held.select("install_id", "batch_id", "held")


_STARTS_SQL = """
, starts AS (SELECT o_custkey % 50 AS install_id, CAST(o_orderdate AS TIMESTAMP) AS ts, o_orderkey AS seq
   FROM orders WHERE o_orderpriority = '1-URGENT')"""


def _session_starts(spark, sf):
    """Session starts for the delivery installs (fixture: urgent orders)."""
    o = fx.table(spark, sf, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    return o.select((F.col("o_custkey") % 50).alias("install_id"), F.col("o_orderdate").cast("timestamp_ntz").alias("ts"),
                    F.col("o_orderkey").alias("seq"))


@register("environment_batches", S.with_(fx.ATTEMPTS_SQL, S.ATT_CLASS_SQL, S.DISPOSITION_SQL) + _BOUNDARIES_SQL + _STARTS_SQL + """
, u AS (SELECT install_id, first_attempt_at AS ts, 1 AS turn, batch_id AS seq, deciding_class = 'success' AS ok, TRUE AS is_batch FROM disp
   UNION ALL SELECT install_id, ts, 1, seq, FALSE, FALSE FROM starts UNION ALL SELECT install_id, ts, 0, 0, FALSE, FALSE FROM bounds),
s AS (SELECT *, last_value(CASE WHEN is_batch AND ok THEN {'ts': ts, 'turn': turn, 'seq': seq} END IGNORE NULLS) OVER w AS last_ok,
   last_value(CASE WHEN NOT is_batch THEN {'ts': ts, 'turn': turn, 'seq': seq} END IGNORE NULLS) OVER w AS last_start FROM u
   WINDOW w AS (PARTITION BY install_id ORDER BY ts, turn, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT install_id, seq AS batch_id, last_ok IS NULL OR (last_start IS NOT NULL AND last_start > last_ok) AS with_environment
FROM s WHERE is_batch""")
def environment_batches(spark, sf):
    d = dv.batch_disposition(fx.attempts(spark, sf))
    return dv.environment_batches(d, _session_starts(spark, sf), _boundaries(spark, sf)).select("install_id", "batch_id", "with_environment")


@register("flush_status", S.with_(*S.BASE_STATE, fx.ATTEMPTS_SQL, S.ATT_CLASS_SQL, S.DISPOSITION_SQL) + f"""
, ini AS (SELECT DISTINCT c_custkey % 500 AS install_id, TRUE AS opted_out FROM customer WHERE c_custkey % 11 = 3),
known AS (SELECT install_id, bool_or(enabled) AS enabled, min(ts) AS first_ts FROM c1 GROUP BY install_id
   UNION ALL SELECT DISTINCT install_id, TRUE, CAST(NULL AS TIMESTAMP) FROM disp WHERE install_id NOT IN (SELECT install_id FROM c1)),
inst AS (SELECT k.install_id, k.enabled, coalesce(i.opted_out, FALSE) AS opted_out FROM known k LEFT JOIN ini i ON i.install_id = k.install_id),
-- Consent calls that change the flag, from the consent each install starts with.
toggles AS (SELECT c.install_id, c.ts, c.seq, c.op = 'opt_out' AS now,
   coalesce(lag(c.op = 'opt_out') OVER (PARTITION BY c.install_id ORDER BY c.ts, c.seq), n.opted_out) AS was
   FROM c1 c JOIN inst n ON n.install_id = c.install_id WHERE c.op IN ('opt_out', 'opt_in')),
u AS (SELECT install_id, 1 AS turn, decided_at AS ts, batch_id AS seq, status_after, CAST(NULL AS BOOLEAN) AS toggle FROM disp
   UNION ALL SELECT install_id, 1, ts, seq, CASE WHEN now THEN 'OptedOut' ELSE 'NotConnected' END, now FROM toggles WHERE now <> was
   UNION ALL SELECT install_id, 0, TIMESTAMP '0001-01-01', -1, CASE WHEN NOT enabled THEN 'Disabled' WHEN opted_out THEN 'OptedOut' ELSE 'NotConnected' END, opted_out FROM inst),
f AS (SELECT u.*, NOT n.enabled AND turn = 1 AND toggle IS NULL AS data_error, last_value(toggle IGNORE NULLS) OVER (PARTITION BY u.install_id ORDER BY turn, ts, seq
   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS opted FROM u JOIN inst n ON n.install_id = u.install_id),
g AS (SELECT *, last_value(CASE WHEN data_error OR (status_after = 'Connected' AND opted) THEN NULL ELSE status_after END IGNORE NULLS)
   OVER (PARTITION BY install_id ORDER BY turn, ts, seq ROWS UNBOUNDED PRECEDING) AS status FROM f)
SELECT install_id, arg_max(status, {{'turn': turn, 'ts': ts, 'seq': seq}}) AS status, CAST(count(*) FILTER (turn = 1) AS BIGINT) AS n_changes,
  CAST(count(*) FILTER (data_error) AS BIGINT) AS n_data_errors, {S.iso('max(CASE WHEN turn = 1 THEN ts END)')} AS last_change_at
FROM g GROUP BY install_id""")
def flush_status(spark, sf):
    """Every install of the call log or the deliveries has a status. Some
    installs start opted out (fixture: customers)."""
    d = stage(dv.batch_disposition(fx.attempts(spark, sf)).select("install_id", "batch_id", "decided_at", "status_after"), "dispositions")
    ini = fx.initial_consent(spark, sf)
    calls = fx.calls(spark, sf).select("install_id", "ts", "seq", "op", "source_app")
    calls = stage(attach_app_config(calls, fx.app_config_raw(spark, sf)).select("install_id", "ts", "seq", "op", "enabled"), "consent-calls")
    known = calls.groupBy("install_id").agg(F.max("enabled").alias("enabled"), F.min("ts").alias("first_ts"))
    more = (d.select("install_id").distinct().join(known, "install_id", "left_anti")
            .select("install_id", F.lit(True).alias("enabled"), F.lit(None).cast("timestamp_ntz").alias("first_ts")))
    installs = known.unionByName(more).join(ini, "install_id", "left").withColumn("opted_out", F.coalesce("opted_out", F.lit(False)))
    installs = stage(installs, "installs")
    changes = stage(dv.consent_changes(calls.filter(F.col("op").isin("opt_out", "opt_in")), installs), "consent-changes")
    return dv.current_status(dv.flush_status(d, changes, installs))


@register("delivery_lag", S.with_(fx.QUEUE_SQL) + """
, l AS (SELECT install_id, (epoch_us(queued_at) - epoch_us(strptime(json_extract_string(payload_json, '$.timestamp'), '%Y-%m-%dT%H:%M:%S.%gZ'))) / 1000000 AS lag_s FROM queue)
SELECT install_id, CAST(count(lag_s) AS BIGINT) AS n, CAST(count(*) - count(lag_s) AS BIGINT) AS n_bad, min(lag_s) AS min_lag_s, max(lag_s) AS max_lag_s FROM l GROUP BY install_id""")
def delivery_lag(spark, sf):
    return qm.delivery_lag(fx.queue(spark, sf), key="install_id").select("install_id", "n", "n_bad", "min_lag_s", "max_lag_s")


_LAG_BUCKETS_SQL = """
, ms AS (SELECT app AS source_app, CAST(floor((epoch_us(queued_at) - epoch_us(strptime(json_extract_string(payload_json, '$.timestamp'), '%Y-%m-%dT%H:%M:%S.%gZ'))) / 1000) AS BIGINT) AS ms FROM queue),
b AS (SELECT source_app, sign(ms) * (abs(ms) - abs(ms) % CAST(pow(2, greatest(length(bin(abs(ms))) - 7, 0)) AS BIGINT)) AS low, count(*) AS n FROM ms WHERE ms IS NOT NULL GROUP BY ALL),
c AS (SELECT *, sum(n) OVER (PARTITION BY source_app ORDER BY low) AS upto, sum(n) OVER (PARTITION BY source_app) AS total FROM b)"""


@register("lag_quantiles", S.with_(fx.QUEUE_SQL) + _LAG_BUCKETS_SQL + """
SELECT source_app, CAST(sum(n) AS BIGINT) AS n, CAST(min(CASE WHEN upto * 100 >= 50 * total THEN low END) AS BIGINT) AS p50_lag_ms,
  CAST(min(CASE WHEN upto * 100 >= 99 * total THEN low END) AS BIGINT) AS p99_lag_ms FROM c GROUP BY source_app""")
def lag_quantiles(spark, sf):
    """Median and 99th percentile of the spill delay per app, from the daily
    sketches of two runs merged (at most 1/64 below the true delay)."""
    q = fx.queue(spark, sf).withColumnRenamed("app", "source_app")
    runs = [qm.lag_sketch(q.filter(F.col("id") % 2 == i)) for i in (0, 1)]
    return qm.sketch_quantiles(qm.merge_sketches(*runs), [50, 99])


# ============================================================== environment

_ENV_SQL = """
, latest AS (SELECT c_custkey % 500 AS install_id, max(c_custkey) AS k, count(*) AS n FROM customer GROUP BY 1),
env AS (SELECT l.install_id, strftime(TIMESTAMP '2024-01-01 00:00:00' + to_seconds(c.c_custkey), '%Y-%m-%dT%H:%M:%S.%gZ') AS reported_at,
   CAST(l.n AS BIGINT) AS n_headers, CAST(c.c_custkey % 16 + 1 AS INTEGER) AS cpu_core_count, 'en_US' AS locale,
   sha256(c.c_name) AS machine_name_hash,
   CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 'Windows' WHEN 'BUILDING' THEN 'Linux' WHEN 'FURNITURE' THEN 'macOS'
     WHEN 'HOUSEHOLD' THEN 'Linux' WHEN 'MACHINERY' THEN 'Windows' ELSE 'Unknown' END AS os_name,
   '10.' || CAST(c.c_nationkey % 5 AS VARCHAR) AS os_version, CAST((c.c_custkey * 37) % 65536 AS BIGINT) AS total_ram_mb
   FROM latest l JOIN customer c ON c.c_custkey = l.k),
envb AS (SELECT *, CASE WHEN total_ram_mb < 2048 THEN '< 2 GB' WHEN total_ram_mb < 4096 THEN '2-4 GB'
   WHEN total_ram_mb < 8192 THEN '4-8 GB' WHEN total_ram_mb < 16384 THEN '8-16 GB' WHEN total_ram_mb < 32768 THEN '16-32 GB'
   ELSE '> 32 GB' END AS total_ram_mb_bucket FROM env)"""


def _env_dim(spark, sf):
    return env.environment_dim(fx.environment_headers(spark, sf))


@register("environment_dim", "WITH dummy AS (SELECT 1)" + _ENV_SQL + """
SELECT install_id, reported_at, n_headers, cpu_core_count, locale, machine_name_hash, os_name, os_version, total_ram_mb,
  total_ram_mb_bucket FROM envb""")
def environment_dim(spark, sf):
    d = _env_dim(spark, sf)
    return d.select("install_id", iso_millis("reported_at").alias("reported_at"), _long("n_headers").alias("n_headers"),
                    "cpu_core_count", "locale", "machine_name_hash", "os_name", "os_version", "total_ram_mb",
                    "total_ram_mb_bucket")


@register("ram_buckets", "WITH dummy AS (SELECT 1)" + _ENV_SQL + """
SELECT total_ram_mb_bucket, os_name, CAST(count(*) AS BIGINT) AS n_installs FROM envb GROUP BY ALL""")
def ram_buckets(spark, sf):
    return env.ram_bucket_counts(_env_dim(spark, sf))


@register("machine_hashes", """
SELECT c_custkey, sha256(c_name) AS machine_name_hash FROM customer""")
def machine_hashes(spark, sf):
    c = fx.table(spark, sf, "customer").select("c_custkey", F.col("c_name").alias("host"))
    return env.machine_hashes(c)


# ============================================================= stack frames

_WIN, _MAC, _LIN = (r"'^\[(\d+)\] (.*?)(?: \((.+):(\d+)\))?$'", r"'^(\d+)\s+(\S.*?)\s+(0x[0-9a-fA-F]+) (.+?) \+ (\d+)$'",
                    r"'^(.+?)(?:\(([^()+]*)(?:\+(0x[0-9a-fA-F]+))?\))? ?\[(0x[0-9a-fA-F]+)\]$'")


def _frame_part(win: int = 0, mac: int = 0, lin: int = 0) -> str:
    """SQL of one field: its group in each form, null where it has none."""
    part = [f"WHEN form = '{f}' THEN nullif(regexp_extract(raw, {p}, {i}), '')" for f, p, i in (("win", _WIN, win), ("mac", _MAC, mac), ("lin", _LIN, lin)) if i]
    return f"CASE {' '.join(part)} END"


_FRAMES_SQL = rf"""
, lines AS (SELECT conv_id, unnest(generate_series(0, len(string_split(stack_trace, chr(10))) - 1)) AS pos,
   unnest(string_split(left(stack_trace, 32768), chr(10))) AS raw FROM traces),
forms AS (SELECT conv_id, CAST(pos AS BIGINT) AS pos, raw, CASE WHEN regexp_matches(raw, {_WIN}) THEN 'win'
   WHEN regexp_matches(raw, {_MAC}) THEN 'mac' WHEN regexp_matches(raw, {_LIN}) THEN 'lin' END AS form FROM lines WHERE length(raw) > 0),
fr AS (SELECT conv_id, pos, raw, form, CAST({_frame_part(1, 1)} AS INTEGER) AS frame_index,
   CASE WHEN form = 'win' THEN regexp_extract(raw, {_WIN}, 2) ELSE {_frame_part(0, 4, 2)} END AS symbol,
   {_frame_part(3)} AS file, CAST({_frame_part(4)} AS INTEGER) AS line,
   {_frame_part(0, 2, 1)} AS module, {_frame_part(0, 3, 4)} AS address, {_frame_part(0, 5, 3)} AS "offset" FROM forms)"""


@register("report_frames", S.with_(*S.BASE_STATE) + """
, rtraces AS (SELECT install_id AS conv_id, seq, stack_trace FROM state WHERE accepted AND op = 'exception')"""
          + _FRAMES_SQL.replace("SELECT conv_id,", "SELECT conv_id, seq,").replace("FROM traces", "FROM rtraces") + """
SELECT conv_id AS install_id, seq, pos, frame_index, symbol, file, line, module, address, "offset" FROM fr""")
def report_frames(spark, sf):
    """Frames of the stack traces carried by the exception reports."""
    r = bcm.report_core(bcm.accepted_exceptions(_state(spark, sf)))
    return stm.stack_frames(r, ["install_id", "seq"]).drop("raw")


@register("stack_frames", S.with_(fx.TRACES_SQL) + _FRAMES_SQL + """
SELECT conv_id, pos, raw, frame_index, symbol, file, line, module, address, "offset" FROM fr""")
def stack_frames(spark, sf):
    return stm.stack_frames(fx.stack_traces(spark, sf), ["conv_id"])


@register("top_frames", S.with_(fx.TRACES_SQL) + _FRAMES_SQL + """
SELECT symbol, CAST(count(*) AS BIGINT) AS n FROM fr WHERE frame_index = 0 OR (form = 'lin' AND pos = 0) GROUP BY symbol""")
def top_frames(spark, sf):
    return stm.top_frames(stm.stack_frames(fx.stack_traces(spark, sf), ["conv_id"]))


# ====================================================== streaming (batch form)

@register("dedupe_events", S.with_(fx.QUEUE_SQL) + """
SELECT DISTINCT install_id, json_extract_string(payload_json, '$.event_id') AS event_id,
  json_extract_string(payload_json, '$.category') AS category, json_extract_string(payload_json, '$.name') AS name FROM queue""")
def dedupe_events(spark, sf):
    """At-least-once delivery: batches of open orders are delivered twice
    (a lost reply), all others once; duplicates go by ``event_id``."""
    from fleetscope.streaming import dedupe_batch
    q = _limited(spark, sf)
    first = _batches(spark, sf, q)
    again = _batches(spark, sf, q.filter(F.col("o_orderstatus") == "O"))
    ev1, _ = explode_event_batches(first.select("install_id", "batch_no", "body"), key=["install_id", "batch_no"])
    ev2, _ = explode_event_batches(again.select("install_id", "batch_no", "body"), key=["install_id", "batch_no"])
    both = ev1.unionByName(ev2).select("install_id", "event_id", "category", "name")
    return dedupe_batch(both)


@register("flush_window_counts", S.with_(*S.BASE_STATE, S.EVENTS_SQL) + f"""
SELECT source_app, {S.iso('time_bucket(INTERVAL 60 SECOND, ts)')} AS window_start, CAST(count(*) AS BIGINT) AS n
FROM events_t GROUP BY ALL""")
def flush_window_counts(spark, sf):
    from fleetscope.streaming import window_counts
    return window_counts(_events(spark, sf), "60 seconds")


def _as_stream(spark: SparkSession, df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` as files in a fresh shared folder, read by the file source."""
    base = scratch_path(spark, f"{name}-{_uuid.uuid4().hex}")
    df.write.parquet(f"{base}/in")
    return spark.readStream.schema(df.schema).parquet(f"{base}/in"), base


def _run_to_end(stream: DataFrame, base: str, mode: str = "append") -> DataFrame:
    """All available input processed; the rows of every micro-batch, each
    written to a folder of its own so that a retried one replaces itself."""
    def sink(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{base}/out/batch_id={batch_id}")

    q = (stream.writeStream.outputMode(mode).foreachBatch(sink).option("checkpointLocation", f"{base}/ckpt")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return stream.sparkSession.read.schema(stream.schema.add("batch_id", "long")).parquet(f"{base}/out")


# The logs span years and their files come in any order, so state is kept for
# all of it.
LOG_SPAN = "36500 days"


@register("dedupe_events_stream", S.with_(*S.BASE_STATE, S.EVENTS_SQL) + """
SELECT install_id, event_id, category, name FROM events_t""")
def dedupe_events_stream(spark, sf):
    """Events arrive in four time ranges, each delivered twice, and a range
    later all of them once more. The index keeps two ranges; an event that it
    could no longer judge would be a fault of this arrival order, so it fails."""
    from fleetscope.streaming.redelivery import redelivery_stream
    ev = stage(_events(spark, sf).select("install_id", "ts", "event_id", "category", "name"), "deliveries")
    base = scratch_path(spark, f"dedupe-{_uuid.uuid4().hex}")
    cond, span = _arrivals(ev, "ts")
    for i, now in enumerate(cond):
        part = ev.filter(now)
        again = part if i == 0 else part.unionByName(ev.filter(cond[i - 1]))
        part.unionByName(again).write.parquet(f"{base}/in/part{i}")
        src = spark.readStream.schema(ev.schema).option("recursiveFileLookup", "true").parquet(f"{base}/in")
        # Monthly buckets: the events of a small table span years.
        redelivery_stream(src, f"{base}/index", f"{base}/out", f"{base}/ckpt", hours=720, keep_hours=int(2 * span.total_seconds() // 3600) + 720,
                          availableNow=True).awaitTermination()
    if spark.read.option("recursiveFileLookup", "true").schema(ev.schema).parquet(f"{base}/out/expired").limit(1).count():
        raise RuntimeError("an event came after its bucket had gone")
    return spark.read.parquet(f"{base}/out/events").select("install_id", "event_id", "category", "name")


def _arrivals(rows: DataFrame, ts: str, parts: int = 4):
    """Conditions of ``parts`` equal time ranges, and their width."""
    lo, hi = rows.agg(F.min(ts), F.max(ts)).first()
    step = (hi - lo) / parts
    edges = [lo + step * i for i in range(1, parts)]
    conds = []
    for i in range(parts):
        c = F.lit(True)
        if i:
            c = c & (F.col(ts) >= F.lit(edges[i - 1]))
        if i < parts - 1:
            c = c & (F.col(ts) < F.lit(edges[i]))
        conds.append(c)
    return conds, step


@register("validate_stream", S.with_(fx.CALLS_SQL) + f"""
SELECT install_id, seq, CASE WHEN op = 'track' AND starts_with(category, '_') THEN 'reserved_category'
  WHEN op = 'identify' OR explicit_actor IS NOT NULL THEN {S.actor_err('explicit_actor')} END AS reject_reason FROM calls""")
def validate_stream(spark, sf):
    """Both sinks of the validation stream: valid rows and refused ones."""
    from fleetscope.streaming import start_validation_stream
    src, base = _as_stream(spark, fx.calls(spark, sf), "validate")
    start_validation_stream(src, f"{base}/valid", f"{base}/refused", f"{base}/ckpt", availableNow=True).awaitTermination()
    schema = "install_id long, seq long, reject_reason string"
    valid, refused = (spark.read.schema(schema).parquet(f"{base}/{x}") for x in ("valid", "refused"))
    return valid.unionByName(refused).select("install_id", "seq", "reject_reason")


@register("idle_sessions_stream", S.with_(fx.CALLS_SQL) + f"""
, g AS (SELECT install_id, ts, seq, CASE WHEN lag(ts) OVER (PARTITION BY install_id ORDER BY ts, seq) IS NULL
   OR epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY install_id ORDER BY ts, seq)) >= {IDLE_GAP_SECONDS * 1_000_000}
   THEN 1 ELSE 0 END AS is_new FROM calls),
n AS (SELECT *, sum(is_new) OVER (PARTITION BY install_id ORDER BY ts, seq ROWS UNBOUNDED PRECEDING) AS session_no FROM g)
SELECT install_id, {S.iso('min(ts)')} AS started_at, {S.iso('max(ts)')} AS last_event_at, CAST(count(*) AS BIGINT) AS n_events
FROM n GROUP BY install_id, session_no
HAVING epoch_us(max(ts)) + {IDLE_GAP_SECONDS * 1_000_000} <= (SELECT epoch_us(max(ts)) FROM calls)""")
def idle_sessions_stream(spark, sf):
    """Sessions that the stream closed: idle for the gap by the end of the log."""
    from fleetscope.streaming import idle_sessions_stream as run
    src, base = _as_stream(spark, fx.calls(spark, sf).select("install_id", "ts"), "idle")
    return _run_to_end(run(src, f"{IDLE_GAP_SECONDS} seconds", "0 seconds"), base).drop("batch_id")


@register("flush_window_counts_stream", ORACLES["flush_window_counts"])
def flush_window_counts_stream(spark, sf):
    """Update mode: a window's count of a later micro-batch replaces the former."""
    from fleetscope.streaming import window_counts_stream
    src, base = _as_stream(spark, _events(spark, sf).select("source_app", "ts"), "windows")
    rows = _run_to_end(window_counts_stream(src, "60 seconds", LOG_SPAN), base, "update")
    return rows.groupBy("source_app", "window_start").agg(F.max_by("n", "batch_id").alias("n"))


@register("queue_window_counts_stream", S.with_(fx.QUEUE_SQL) + f"""
, e AS (SELECT app AS source_app, strptime(json_extract_string(payload_json, '$.timestamp'), '%Y-%m-%dT%H:%M:%S.%gZ') AS ts FROM queue)
SELECT source_app, {S.iso("time_bucket(INTERVAL 3600 SECOND, ts)")} AS window_start, CAST(count(*) AS BIGINT) AS n FROM e WHERE ts IS NOT NULL GROUP BY ALL""")
def queue_window_counts_stream(spark, sf):
    """Events per app and hour of their own time, from queue rows that arrive
    in spill order. The watermark's delay comes from the measured lag, so a
    window stays open for every row that is still to come."""
    from fleetscope.streaming import window_counts_stream
    q = stage(fx.queue(spark, sf).withColumnRenamed("app", "source_app"), "queue")
    delay = qm.delay_from_sketch(qm.lag_sketch(q))
    ts = F.get_json_object("payload_json", "$.timestamp").try_cast("timestamp_ntz")
    rows = q.select("source_app", "queued_at", ts.alias("ts")).filter("ts IS NOT NULL")
    base = scratch_path(spark, f"lag-windows-{_uuid.uuid4().hex}")
    out = None
    for i, now in enumerate(_arrivals(rows, "queued_at")[0]):
        rows.filter(now).write.parquet(f"{base}/in/part{i}")
        src = spark.readStream.schema(rows.schema).option("recursiveFileLookup", "true").parquet(f"{base}/in")
        out = _run_to_end(window_counts_stream(src, "3600 seconds", delay), base, "update")
    return out.groupBy("source_app", "window_start").agg(F.max_by("n", "batch_id").alias("n"))


def _streamed(spark: SparkSession, sf: str, files: int = 2) -> str:
    """Run the per-install state machine as a stream; returns the folder of
    its outputs. The call log arrives in four time ranges of ``files`` files;
    after each, the stream runs until all new files are processed (one
    micro-batch) and resumes from the saved rows. Calls that it had to set
    aside as late would be a fault of this arrival order, so they fail."""
    from fleetscope.streaming.stateful import stateful_stream as run
    calls = fx.calls(spark, sf)
    base = scratch_path(spark, f"stateful-{_uuid.uuid4().hex}")
    lo, hi = calls.agg(F.min("ts"), F.max("ts")).first()
    parts = 4
    step = (hi - lo) / parts
    for i in range(parts):
        a, b = lo + step * i, lo + step * (i + 1)
        cond = (F.col("ts") >= a) & ((F.col("ts") < b) if i < parts - 1 else F.lit(True))
        calls.filter(cond).repartition(files).write.parquet(f"{base}/in/part{i}")
        src = spark.readStream.schema(calls.schema).option("recursiveFileLookup", "true").parquet(f"{base}/in")
        q = run(src, fx.app_config_raw(spark, sf), f"{base}/state", f"{base}/out", f"{base}/ckpt", fx.initial_consent(spark, sf), availableNow=True)
        q.awaitTermination()
    late = spark.read.option("recursiveFileLookup", "true").schema(calls.schema).parquet(f"{base}/out/late_calls").limit(1).count()
    if late:
        raise RuntimeError("calls arrived after their install's saved position")
    return f"{base}/out"


@register("stateful_stream", S.with_(*S.BASE_STATE) + """
SELECT install_id, seq, opted_out_before, epoch, device_id, gate_reason, reject_reason, accepted, actor_id,
  session_id, track_no FROM state""")
def stateful_stream(spark, sf):
    """The state of every call, from the stream."""
    return spark.read.parquet(f"{_streamed(spark, sf)}/state").select(
        "install_id", "seq", "opted_out_before", "epoch", "device_id", "gate_reason", "reject_reason", "accepted", "actor_id", "session_id",
        "track_no")


@register("stream_identity_links", ORACLES["identity_links"])
def stream_identity_links(spark, sf):
    """Identity links from the stream: the first link of a device wins, in
    whichever micro-batch it came."""
    return spark.read.parquet(f"{_streamed(spark, sf)}/identity_links").select(
        "install_id", "seq", "anonymous_actor_id", "identified_actor_id", "identified_at", "source_app", "source_version", "conflict")


@register("stream_sessions", ORACLES["sessions"])
def stream_sessions(spark, sf):
    """Sessions from the stream, with ends that later micro-batches found."""
    from fleetscope.streaming.stateful import stream_sessions as joined
    s = joined(spark, _streamed(spark, sf))
    return s.select("install_id", "session_id", "actor_id", iso_millis("started_ts").alias("started_at"), iso_millis("ended_ts").alias("ended_at"),
                    "ended_by", "end_reason", iso_millis("lost_ts").alias("lost_at"))


@register("stream_exception_reports", ORACLES["exception_reports"])
def stream_exception_reports(spark, sf):
    """Exception reports from the stream; breadcrumbs reach back into earlier
    micro-batches."""
    return _report_columns(spark.read.parquet(f"{_streamed(spark, sf)}/exception_reports"))
