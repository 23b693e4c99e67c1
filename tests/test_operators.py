"""Operators on small hand-made tables, checked against brute force."""

import datetime as dt
import json
import random

from pyspark.sql import functions as F

from fleetscope import schemas
from fleetscope.operators import delivery as dv
from fleetscope.operators import environment as env
from fleetscope.operators import queue as qm
from fleetscope.operators import stack as stm
from fleetscope.operators.config import normalize_app_config
from fleetscope.operators.events import event_definitions, event_payload
from fleetscope.operators.sessions import idle_sessions
from fleetscope.sources import explode_event_batches

T0 = dt.datetime(2024, 1, 1)


def queue_rows(rng, installs=3, per=350):
    rows = []
    i = 0
    for inst in range(installs):
        for _ in range(per):
            payload = json.dumps({"event_id": f"e{i}", "pad": "x" * rng.randint(10, 400)})
            rows.append((inst, i, payload, T0 + dt.timedelta(seconds=i), 0))
            i += 1
    return rows


def brute_cap(rows, cap):
    """Evict the oldest 100 rows at a time while the queue holds cap or more."""
    out = {}
    by = {}
    for r in rows:
        by.setdefault(r[0], []).append(r)
    for inst, rs in by.items():
        rs = sorted(rs, key=lambda r: r[1])
        size = sum(len(r[2].encode()) for r in rs)
        start = 0
        while size >= cap and start < len(rs):
            blk = rs[start:start + 100]
            size -= sum(len(r[2].encode()) for r in blk)
            start += len(blk)
        for j, r in enumerate(rs):
            out[(inst, r[1])] = j < start
    return out


def test_cap_queue_matches_eviction_loop(spark):
    rows = queue_rows(random.Random(7))
    q = spark.createDataFrame(rows, schemas.QUEUE)
    for cap in (10_000, 45_000, 80_000, 10 ** 9):
        got = {(r.install_id, r.id): r.evicted for r in qm.cap_queue(q, cap).collect()}
        assert got == brute_cap(rows, cap), cap


def test_read_oldest_and_ack(spark):
    rows = queue_rows(random.Random(1), installs=2, per=30)
    q = spark.createDataFrame(rows, schemas.QUEUE)
    got = sorted((r.install_id, r.id) for r in qm.read_oldest(q, 3).collect())
    assert got == [(0, 0), (0, 1), (0, 2), (1, 30), (1, 31), (1, 32)]
    acked = q.filter(F.col("id") % 2 == 0)
    left = {r.id for r in qm.ack_delivered(q, acked).collect()}
    assert left == {r[1] for r in rows if r[1] % 2 == 1}


def test_batches_round_trip(spark):
    rows = queue_rows(random.Random(2), installs=2, per=60)
    q = spark.createDataFrame(rows, schemas.QUEUE)
    b = qm.form_batches(q, 25).orderBy("install_id", "batch_no").collect()
    assert [r.n_events for r in b] == [25, 25, 10, 25, 25, 10]
    batches = spark.createDataFrame([(r.install_id, r.batch_no, r.body) for r in b] + [(9, 0, "not json")],
                                    "install_id long, batch_no long, body string")
    ok, bad = explode_event_batches(batches, key=["install_id", "batch_no"])
    assert ok.count() == 120 and [r.reason for r in bad.collect()] == ["body_not_json_array"]
    first = ok.filter("install_id = 0 AND batch_no = 1 AND pos = 0").first()
    assert first.event_id == "e25"


def test_queue_depth(spark):
    q = spark.createDataFrame([(0, 1, "ab", T0, 0), (0, 2, "é", T0, 0), (1, 3, "x", T0, 0)], schemas.QUEUE)
    got = {r.install_id: (r.n_pending, r.bytes) for r in qm.queue_depth(q).collect()}
    assert got == {0: (2, 4), 1: (1, 1)}


def attempts(spark, rows):
    return spark.createDataFrame(
        [(inst, b, n, origin, st, net, ra, T0 + dt.timedelta(minutes=b, seconds=n))
         for (inst, b, n, origin, st, net, ra) in rows], schemas.ATTEMPTS)


def test_disposition_table(spark):
    rows = [
        (0, 1, 0, "memory", 200, False, None),                       # delivered
        (0, 2, 0, "memory", 401, False, None),                       # halt, batch lost
        (0, 3, 0, "durable", 401, False, None),                      # halt, kept
        (0, 4, 0, "memory", 402, False, None),                       # spilled
        (0, 5, 0, "durable", 402, False, None),                      # kept
        (0, 6, 0, "memory", 404, False, None),                       # discarded
        (0, 7, 0, "durable", 400, False, None),                      # deleted
        (0, 8, 0, "memory", 500, False, None), (0, 8, 1, "memory", 503, False, None),
        (0, 8, 2, "memory", 429, False, "2"), (0, 8, 3, "memory", 0, True, None),  # exhausted -> spilled
        (0, 9, 0, "memory", 500, False, None), (0, 9, 1, "memory", 200, False, None),  # retried, delivered
        (0, 10, 0, "durable", 500, False, None), (0, 10, 1, "durable", 200, False, None),  # no retry in cycle
        (0, 11, 0, "memory", 304, False, None),                      # other -> spilled at once
    ]
    d = {r.batch_id: (r.disposition, r.status_after) for r in dv.batch_disposition(attempts(spark, rows)).collect()}
    assert d == {1: ("delivered", "Connected"), 2: ("halt_lost", "Offline"), 3: ("halt_kept", "Offline"),
                 4: ("spilled", "Offline"), 5: ("kept", "Offline"), 6: ("discarded", None),
                 7: ("deleted", None), 8: ("spilled", "Offline"), 9: ("delivered", "Connected"),
                 10: ("kept", "Offline"), 11: ("spilled", "Offline")}
    held = {r.batch_id: r.held for r in dv.apply_halt(dv.batch_disposition(attempts(spark, rows))).collect()}
    assert held[1] is False and held[2] is False and all(held[b] for b in range(3, 12))


def test_retry_schedule(spark):
    rows = [(0, 1, n, "memory", 500, False, None) for n in range(4)] + \
           [(0, 2, 0, "memory", 429, False, "7"), (0, 2, 1, "memory", 429, False, "999"), (0, 2, 2, "memory", 200, False, None)]
    s = {(r.batch_id, r.attempt_no): (r.delay_ms, r.delay_min_ms, r.delay_max_ms, r.planned_offset_ms)
         for r in dv.retry_schedule(attempts(spark, rows)).collect()}
    assert s[(1, 0)] == (0, 0, 0, 0)
    assert s[(1, 1)] == (1000, 800, 1200, 1000)
    assert s[(1, 2)] == (2000, 1600, 2400, 3000)
    assert s[(1, 3)] == (4000, 3200, 4800, 7000)
    assert s[(2, 1)][0] == 7000 and s[(2, 2)][0] == 300_000
    jit = dv.retry_schedule(attempts(spark, rows), jitter=True).filter("batch_id = 1 AND attempt_no > 0").collect()
    assert all(r.delay_min_ms <= r.delay_ms <= r.delay_max_ms for r in jit)


def test_environment_batches_rearm(spark):
    disp = spark.createDataFrame([
        (0, 1, T0 + dt.timedelta(minutes=1), "retryable"), (0, 2, T0 + dt.timedelta(minutes=2), "success"),
        (0, 3, T0 + dt.timedelta(minutes=3), "success"), (0, 4, T0 + dt.timedelta(minutes=5), "success"),
        (0, 5, T0 + dt.timedelta(minutes=6), "success")],
        "install_id long, batch_id long, first_attempt_at timestamp_ntz, deciding_class string")
    starts = spark.createDataFrame([(0, T0 + dt.timedelta(minutes=4), 100)], "install_id long, ts timestamp_ntz, seq long")
    got = {r.batch_id: r.with_environment for r in dv.environment_batches(disp, starts).collect()}
    assert got == {1: True, 2: True, 3: False, 4: True, 5: False}


def test_app_config_rules(spark):
    cfg = spark.createDataFrame([
        ("A", "k", "https://h///", "1", True, 0, 5000, 0, 500),
        ("B", "", "http://h", "1", True, None, None, None, None),
        ("C" * 200, "k", "ftp://h", "v" * 300, True, 60, 25, 10, 25)], schemas.APP_CONFIG)
    got = {r.app_key[:1]: r for r in normalize_app_config(cfg).collect()}
    a, b, c = got["A"], got["B"], got["C"]
    assert a.enabled and a.api_base_url == "https://h" and (a.flush_interval_seconds, a.max_batch_size,
                                                            a.max_queue_size_mb, a.max_breadcrumbs) == (1, 1000, 1, 200)
    assert not b.enabled and b.invalid_fields == "api_key" and b.max_breadcrumbs == 25
    assert not c.enabled and c.invalid_fields == "api_base_url" and len(c.app_name) == 128 and len(c.app_version) == 256


def test_definitions_sorted_distinct(spark):
    d = spark.createDataFrame([("inventory", "item_added"), ("app", "launched"), ("app", "closed"),
                               ("app", "launched"), ("", "x"), ("y", "")], "category string, name string")
    assert [(r.category, r.name) for r in event_definitions(d).collect()] == [
        ("app", "closed"), ("app", "launched"), ("inventory", "item_added")]


def test_event_payload_omits_absent(spark):
    ev = spark.createDataFrame([("u", "c", "id", "n", None, None, "app", "1.0", "2026-03-13T00:00:00.000Z")],
                               schemas.EVENT)
    p = json.loads(event_payload(ev).first().payload_json)
    assert list(p) == ["actor_id", "category", "event_id", "name", "source_app", "source_version", "timestamp"]


def test_environment_decode(spark):
    import base64
    good = base64.b64encode(json.dumps({"os_name": "Linux", "total_ram_mb": 3000, "cpu_core_count": 8}).encode()).decode()
    h = spark.createDataFrame([(1, T0, good), (1, T0 + dt.timedelta(hours=1), "!!notbase64"),
                               (2, T0, base64.b64encode(b"not json").decode())],
                              "install_id long, reported_at timestamp_ntz, env_header string")
    d = {(r.install_id, r.reported_at): r for r in env.decode_environment(h).collect()}
    assert d[(1, T0)].env_valid and d[(1, T0)].env.total_ram_mb_bucket == "2-4 GB"
    assert not d[(1, T0 + dt.timedelta(hours=1))].env_valid and not d[(2, T0)].env_valid
    dim = env.environment_dim(h).collect()
    assert [(r.install_id, r.os_name, r.n_headers) for r in dim] == [(1, "Linux", 1)]


def test_stack_frames(spark):
    trace = "[0] main (app.cpp:12)\n[1] run\nlibc.so(+0x1234) [0xdead]\n" + "[2] f (a:1)\n" * 3000
    r = spark.createDataFrame([(1, trace)], "id long, stack_trace string")
    fr = stm.stack_frames(r, ["id"]).orderBy("pos").collect()
    assert (fr[0].frame_index, fr[0].symbol, fr[0].file, fr[0].line) == (0, "main", "app.cpp", 12)
    assert (fr[1].symbol, fr[1].file) == ("run", None)
    assert fr[2].frame_index is None and fr[2].raw.startswith("libc")
    assert (fr[2].module, fr[2].symbol, fr[2].offset, fr[2].address) == ("libc.so", None, "0x1234", "0xdead")
    # The 32768-character cap may cut the last line.
    assert sum(len(x.raw) + 1 for x in fr) <= 32768 + 1


def test_stack_frames_of_other_platforms(spark):
    lines = ["./prog(_ZN3fooEv+0x1a) [0x55d0]", "/lib/libc.so.6() [0x7f]", "0   MyApp   0x000000010abc _ZN3barEv + 26", "[99999999999] f (a.cpp:99999999999)",
             "no frame at all"]
    r = spark.createDataFrame([(1, "\n".join(lines)), (2, lines[0])], "id long, stack_trace string")
    frames = stm.stack_frames(r, ["id"])
    fr = frames.filter("id = 1").orderBy("pos").collect()
    assert (fr[0].module, fr[0].symbol, fr[0].offset, fr[0].address) == ("./prog", "_ZN3fooEv", "0x1a", "0x55d0")
    assert (fr[1].module, fr[1].symbol, fr[1].address) == ("/lib/libc.so.6", None, "0x7f")
    assert (fr[2].frame_index, fr[2].module, fr[2].symbol, fr[2].offset) == (0, "MyApp", "_ZN3barEv", "26")
    assert (fr[3].frame_index, fr[3].line, fr[3].symbol, fr[3].file) == (None, None, "f", "a.cpp")
    assert (fr[4].module, fr[4].symbol, fr[4].raw) == (None, None, lines[4])
    assert {(x.symbol, x.n) for x in stm.top_frames(frames).collect()} == {("_ZN3fooEv", 2), ("_ZN3barEv", 1)}


def test_bad_elements_do_not_take_neighbours(spark):
    body = '[{"event_id":"a","category":"c"},5,{"category":"x"},null,{"event_id":"b"}]'
    rows = [(1, body), (2, body[:-1]), (3, None), (4, "{}"), (5, "[]")]
    ok, bad = explode_event_batches(spark.createDataFrame(rows, "id long, body string"), key=["id"])
    assert sorted((r.id, r.pos, r.event_id) for r in ok.collect()) == [(1, 0, "a"), (1, 4, "b")]
    got = {(r.id, r.pos): (r.reason, r.raw) for r in bad.collect()}
    assert got == {(1, 1): ("element_not_object", "5"), (1, 2): ("element_without_event_id", '{"category":"x"}'), (1, 3): ("element_not_object", None),
                   (2, None): ("body_not_json_array", body[:-1]), (3, None): ("body_not_json_array", None), (4, None): ("body_not_json_array", "{}")}


def test_configs_never_multiply_calls(spark):
    from fleetscope.operators.config import attach_app_config
    cfg = spark.createDataFrame([("a", "k", "http://h", v, True, 1, 1, 1, 1) for v in ("1.0", "1.2", "1.1")], schemas.APP_CONFIG)
    calls = spark.createDataFrame([(1, "a"), (2, "a"), (3, "unknown")], "install_id long, source_app string")
    got = {r.install_id: (r.source_version, r.enabled) for r in attach_app_config(calls, cfg).collect()}
    assert got == {1: ("1.2", True), 2: ("1.2", True), 3: (None, False)}


def test_lag_counts_bad_times(spark):
    q = spark.createDataFrame([("s", '{"timestamp":"2024-01-01T00:00:00.000Z"}', dt.datetime(2024, 1, 1, 0, 0, 5)), ("s", '{"timestamp":"2024-13-99"}', T0), ("s", "x", T0)],
                              "source_app string, payload_json string, queued_at timestamp_ntz")
    r = qm.delivery_lag(q).first()
    assert (r.n, r.n_bad, r.min_lag_s, r.max_lag_s) == (1, 2, 5.0, 5.0)


def test_idle_sessions_gap_rule(spark):
    ts = [T0, T0 + dt.timedelta(minutes=10), T0 + dt.timedelta(minutes=40), T0 + dt.timedelta(minutes=70)]
    ev = spark.createDataFrame([(1, t, i) for i, t in enumerate(ts)], "install_id long, ts timestamp_ntz, seq long")
    got = sorted((r.session_no, r.n_events) for r in idle_sessions(ev, 30 * 60).collect())
    assert got == [(1, 2), (2, 1), (3, 1)]      # a gap of exactly 30 minutes starts a new session
