"""SQL fragments for the DuckDB oracle: the same rules as the Spark code,
written as plain window/join SQL on the raw tables (no slicing, no
buckets). Used only to check results."""

from __future__ import annotations

from fleetscope import fixtures as fx


def iso(x: str) -> str:
    return f"strftime({x}, '%Y-%m-%dT%H:%M:%S.%gZ')"


def us(x: str) -> str:
    return f"epoch_us({x})"


def uuid(ts: str, *keys: str) -> str:
    """The deterministic UUIDv7 expression of ``functions.core.uuid7_from_key``."""
    k = ", ".join(f"CAST({x} AS VARCHAR)" for x in keys)
    h = f"sha256(concat_ws('|', {k}))"
    ms = f"lower(lpad(hex({us(ts)} // 1000), 12, '0'))"
    return (f"(substr({ms}, 1, 8) || '-' || substr({ms}, 9, 4) || '-7' || substr({h}, 1, 3) || '-' || "
            f"translate(substr({h}, 4, 1), '0123456789abcdef', '89ab89ab89ab89ab') || substr({h}, 5, 3) || '-' || "
            f"substr({h}, 8, 12))")


def actor_err(a: str) -> str:
    return (f"(CASE WHEN {a} IS NULL OR length({a}) = 0 THEN 'actor_empty' "
            f"WHEN length({a}) > 512 THEN 'actor_too_long' END)")


def sanitized_entries(m: str) -> str:
    """Sorted, filtered, cut (not yet de-duplicated) entries of a map."""
    return (f"list_transform(list_sort(list_filter(map_entries({m}), lambda e: e.value <> ''))[1:20], "
            f"lambda e: {{'key': left(e.key, 64), 'value': left(e.value, 256)}})")


def dedup_entries(lst: str) -> str:
    """Drop an entry when the next one has the same (cut) key."""
    return f"list_filter({lst}, lambda e, i: i = len({lst}) OR {lst}[i + 1].key <> e.key)"


def json_obj_from_entries(lst: str) -> str:
    return (f"CASE WHEN len({lst}) > 0 THEN '{{' || array_to_string(list_transform({lst}, "
            f"lambda e: to_json(e.key) || ':' || to_json(e.value)), ',') || '}}' END")


CFG_SQL = r"""
cfg AS (
  SELECT app_name AS app_key, left(app_name, 128) AS app_name, left(app_version, 256) AS app_version,
    regexp_replace(coalesce(api_base_url, ''), '/+$', '') AS api_base_url,
    coalesce(enabled, TRUE) AND coalesce(length(api_key), 0) > 0
      AND (starts_with(coalesce(api_base_url, ''), 'http://') OR starts_with(coalesce(api_base_url, ''), 'https://'))
      AND coalesce(length(app_name), 0) > 0 AND coalesce(length(app_version), 0) > 0 AS enabled,
    concat_ws(',',
      CASE WHEN coalesce(length(api_key), 0) = 0 THEN 'api_key' END,
      CASE WHEN NOT (starts_with(coalesce(api_base_url, ''), 'http://') OR starts_with(coalesce(api_base_url, ''), 'https://')) THEN 'api_base_url' END,
      CASE WHEN coalesce(length(app_name), 0) = 0 THEN 'app_name' END,
      CASE WHEN coalesce(length(app_version), 0) = 0 THEN 'app_version' END) AS invalid_fields,
    CAST(greatest(1, least(3600, coalesce(flush_interval_seconds, 60))) AS INTEGER) AS flush_interval_seconds,
    CAST(greatest(1, least(1000, coalesce(max_batch_size, 25))) AS INTEGER) AS max_batch_size,
    CAST(greatest(1, least(1000, coalesce(max_queue_size_mb, 10))) AS INTEGER) AS max_queue_size_mb,
    CAST(greatest(0, least(200, coalesce(max_breadcrumbs, 25))) AS INTEGER) AS max_breadcrumbs
  FROM (SELECT *, row_number() OVER (PARTITION BY app_name ORDER BY list_transform(regexp_extract_all(coalesce(app_version, ''), '\d+'), lambda d: lpad(d, 256, '0')) DESC, coalesce(app_version, '') DESC, coalesce(api_key, '') DESC) AS rank
        FROM app_config_raw) WHERE rank = 1
)"""

_W = """WINDOW w AS (PARTITION BY install_id ORDER BY ts, seq),
         wb AS (PARTITION BY install_id ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         wu AS (PARTITION BY install_id ORDER BY ts, seq ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""

STATE_SQL = rf"""
c1 AS (
  SELECT c.install_id, c.ts, c.seq, c.op, c.category, c.name, c.explicit_actor, c.properties, c.exc_type,
    c.severity, c.message, c.stack_trace, i.opted_out AS starts_out,
    coalesce(g.app_name, left(c.source_app, 128)) AS source_app, g.app_version AS source_version,
    coalesce(g.enabled, FALSE) AS enabled, coalesce(g.flush_interval_seconds, 60) AS flush_interval_seconds,
    coalesce(g.max_batch_size, 25) AS max_batch_size, coalesce(g.max_queue_size_mb, 10) AS max_queue_size_mb,
    coalesce(g.max_breadcrumbs, 25) AS max_breadcrumbs
  FROM calls c LEFT JOIN cfg g ON c.source_app = g.app_key LEFT JOIN starts_opted_out i ON i.install_id = c.install_id
),
c2 AS (
  SELECT *,
    coalesce(last_value(CASE WHEN op = 'opt_out' THEN TRUE WHEN op = 'opt_in' THEN FALSE END IGNORE NULLS) OVER wb, starts_out, FALSE) AS opted_out_before,
    CAST(coalesce(sum(CASE WHEN op = 'reset' THEN 1 ELSE 0 END) OVER wb, 0) AS BIGINT) AS epoch,
    last_value(CASE WHEN op = 'reset' THEN ts END IGNORE NULLS) OVER wb AS last_reset_ts,
    first_value(ts) OVER wu AS first_ts,
    CAST(coalesce(sum(CASE WHEN op IN ('reset', 'start', 'exit') THEN 1 ELSE 0 END) OVER wb, 0) AS BIGINT) AS ring
  FROM c1 {_W}
),
c3 AS (
  SELECT *, CASE WHEN op IN ('opt_out', 'opt_in', 'reset', 'start', 'exit') THEN NULL WHEN NOT enabled THEN 'disabled'
                 WHEN opted_out_before THEN 'opted_out' END AS gate_reason
  FROM c2
),
c4 AS (
  SELECT *, CASE WHEN gate_reason IS NOT NULL THEN NULL
      WHEN op NOT IN ('track', 'exception', 'identify', 'start_session', 'end_session', 'opt_out', 'opt_in', 'reset', 'flush', 'start', 'exit') THEN 'unknown_op'
      WHEN op = 'track' AND coalesce(starts_with(category, '_'), FALSE) THEN 'reserved_category'
      WHEN op = 'identify' THEN {actor_err('explicit_actor')}
      WHEN op IN ('track', 'exception', 'start_session') AND explicit_actor IS NOT NULL THEN {actor_err('explicit_actor')}
    END AS reject_reason
  FROM c3
),
c5 AS (
  SELECT *, gate_reason IS NULL AND reject_reason IS NULL AS accepted,
    {uuid('ts', 'install_id', 'seq', "'session'")} AS sid,
    {uuid('coalesce(last_reset_ts, first_ts)', 'install_id', 'epoch', "'device'")} AS device_id
  FROM c4
),
c6 AS (
  SELECT *,
    last_value(CASE WHEN accepted AND op = 'identify' THEN explicit_actor
                    WHEN accepted AND op = 'start_session' AND explicit_actor IS NOT NULL THEN explicit_actor
                    WHEN op IN ('reset', 'start', 'exit') THEN '' END IGNORE NULLS) OVER wb AS actor_before,
    last_value(CASE WHEN accepted AND op = 'start_session' THEN sid
                    WHEN accepted AND op IN ('end_session', 'reset', 'start', 'exit') THEN '' END IGNORE NULLS) OVER wb AS session_before,
    CAST(sum(CASE WHEN accepted AND op = 'track' THEN 1 ELSE 0 END) OVER wu AS BIGINT) AS track_no,
    lead(CASE WHEN accepted AND op IN ('start_session', 'end_session', 'reset', 'start', 'exit') THEN {{'ts': ts, 'seq': seq, 'op': op}} END IGNORE NULLS) OVER w AS next_session_change,
    lead(CASE WHEN (op = 'opt_out' AND NOT opted_out_before) OR (op = 'opt_in' AND opted_out_before) THEN ts END IGNORE NULLS) OVER w AS next_consent_change_ts
  FROM c5 {_W}
),
state AS (
  SELECT *,
    CASE WHEN op = 'opt_out' THEN TRUE WHEN op = 'opt_in' THEN FALSE ELSE opted_out_before END AS opted_out_after,
    CASE WHEN accepted AND op = 'start_session' THEN sid END AS new_session_id,
    CASE WHEN accepted THEN CASE WHEN op = 'identify' THEN explicit_actor
         WHEN op IN ('track', 'exception', 'start_session') THEN coalesce(explicit_actor, nullif(actor_before, ''), device_id) END END AS actor_id,
    CASE WHEN accepted THEN CASE WHEN op = 'start_session' THEN sid
         WHEN op IN ('track', 'exception') THEN nullif(session_before, '') END END AS session_id
  FROM c6
)"""

EVENTS_SQL = rf"""
ev0 AS (
  SELECT install_id, ts, seq, epoch, track_no, left(category, 128) AS category, left(name, 256) AS name,
    {iso('ts')} AS "timestamp", actor_id, session_id, {sanitized_entries('properties')} AS pe,
    source_app, source_version, max_batch_size, max_breadcrumbs, flush_interval_seconds, first_ts,
    {uuid('ts', 'install_id', 'seq', "'event'")} AS event_id
  FROM state WHERE accepted AND op = 'track'
),
events_t AS (
  SELECT * EXCLUDE (pe), {dedup_entries('pe')} AS props FROM ev0
)"""

SESSIONS_SQL = r"""
sessions AS (
  SELECT install_id, epoch, new_session_id AS session_id, actor_id, source_app, source_version,
    ts AS started_ts, seq AS start_seq, CASE WHEN NOT lost THEN next_session_change.ts END AS ended_ts,
    CASE WHEN NOT lost THEN next_session_change.seq END AS end_seq, CASE WHEN NOT lost THEN next_session_change.op END AS ended_by,
    CASE WHEN NOT lost THEN 'normal' END AS end_reason, CASE WHEN lost THEN next_session_change.ts END AS lost_ts,
    CASE WHEN lost THEN next_session_change.seq END AS lost_seq
  FROM (SELECT *, next_session_change.op IN ('start', 'exit') AS lost FROM state WHERE accepted AND op = 'start_session')
)"""

BREADCRUMBS_SQL = rf"""
exc AS (
  SELECT * FROM state WHERE accepted AND op = 'exception'
),
bc0 AS (
  SELECT e.install_id, e.seq, t.track_no AS no, {iso('t.ts')} AS "timestamp", left(t.category, 128) AS category,
    left(t.name, 256) AS name, {sanitized_entries('t.properties')} AS pe
  FROM exc e JOIN state t ON t.install_id = e.install_id AND t.ring = e.ring AND t.accepted AND t.op = 'track'
    AND e.max_breadcrumbs > 0 AND t.track_no <= e.track_no AND t.track_no > e.track_no - e.max_breadcrumbs
),
bc AS (
  SELECT install_id, seq, no, "timestamp", category, name, {dedup_entries('pe')} AS props FROM bc0
)"""

ATT_CLASS_SQL = r"""
att AS (
  SELECT *,
    CASE WHEN NOT coalesce(is_network_error, FALSE) AND status_code >= 200 AND status_code < 300 THEN 'success'
         WHEN NOT coalesce(is_network_error, FALSE) AND status_code = 401 THEN 'halt'
         WHEN NOT coalesce(is_network_error, FALSE) AND status_code = 402 THEN 'payment'
         WHEN NOT coalesce(is_network_error, FALSE) AND status_code >= 400 AND status_code < 500 AND status_code <> 429 THEN 'permanent'
         WHEN coalesce(is_network_error, FALSE) OR status_code = 429 OR status_code >= 500 THEN 'retryable'
         ELSE 'other' END AS attempt_class,
    regexp_extract(retry_after, '^\s*([+-]?\d+)', 1) AS ra_digits
  FROM attempts
),
att2 AS (
  SELECT *, regexp_replace(regexp_replace(ra_digits, '^[+-]', ''), '^0+(\d)', '\1') AS ra_body FROM att
),
att3 AS (
  SELECT * EXCLUDE (ra_digits, ra_body),
    CASE WHEN ra_digits IS NULL OR length(ra_digits) = 0 THEN NULL
         WHEN length(ra_body) > 10 THEN NULL
         WHEN starts_with(ra_digits, '-') AND CAST(ra_body AS BIGINT) > 2147483648 THEN NULL
         WHEN NOT starts_with(ra_digits, '-') AND CAST(ra_body AS BIGINT) > 2147483647 THEN NULL
         WHEN starts_with(ra_digits, '-') AND CAST(ra_body AS BIGINT) > 0 THEN NULL
         ELSE CAST(least(CAST(ra_body AS BIGINT), 300) AS INTEGER) END AS retry_after_s
  FROM att2
)"""

DISPOSITION_SQL = r"""
disp0 AS (
  SELECT install_id, batch_id, origin,
    min(CASE WHEN origin <> 'memory' OR attempt_class <> 'retryable' OR attempt_no >= 3
             THEN {'attempt_no': attempt_no, 'attempt_class': attempt_class, 'status_code': status_code, 'attempted_at': attempted_at} END) AS d,
    min(attempted_at) AS first_attempt_at, count(*) AS n_attempts
  FROM att3 GROUP BY install_id, batch_id, origin
),
disp AS (
  SELECT install_id, batch_id, origin, d.attempt_no AS decided_at_attempt, d.status_code AS deciding_status,
    coalesce(d.attempt_class, 'exhausted') AS deciding_class,
    CASE WHEN d IS NULL THEN 'spilled'
         WHEN d.attempt_class = 'success' THEN 'delivered'
         WHEN d.attempt_class = 'halt' THEN CASE WHEN origin = 'memory' THEN 'halt_lost' ELSE 'halt_kept' END
         WHEN d.attempt_class = 'payment' THEN CASE WHEN origin = 'memory' THEN 'spilled' ELSE 'kept' END
         WHEN d.attempt_class = 'permanent' THEN CASE WHEN origin = 'memory' THEN 'discarded' ELSE 'deleted' END
         ELSE CASE WHEN origin = 'memory' THEN 'spilled' ELSE 'kept' END END AS disposition,
    CASE WHEN d.attempt_class = 'success' THEN 'Connected' WHEN d.attempt_class = 'permanent' THEN NULL ELSE 'Offline' END AS status_after,
    coalesce(d.attempted_at, first_attempt_at) AS decided_at, first_attempt_at, n_attempts
  FROM disp0
)"""


def with_(*frags: str) -> str:
    return "WITH " + ",\n".join(f.strip() for f in frags)


BASE_STATE = (fx.CALLS_SQL, fx.INITIAL_CONSENT_SQL, fx.APP_CONFIG_SQL, CFG_SQL, STATE_SQL)
