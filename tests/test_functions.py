"""Column functions at the boundaries the client's own tests pin."""

import datetime as dt
import hashlib

from pyspark.sql import functions as F

from fleetscope.functions import (actor_error, attempt_class, backoff_ms, iso_millis, parse_retry_after,
                                  partition_key, pseudonymize, ram_bucket, sanitize_properties, truncate,
                                  uuid7_from_key, uuid7_is_valid, uuid7_millis)


def one(spark, expr, schema, value):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first().r


def test_actor_validation(spark):
    df = spark.createDataFrame([("",), ("a" * 512,), ("a" * 513,), ("user-1",), (None,)], "a string")
    got = [r.e for r in df.select(actor_error("a").alias("e")).collect()]
    assert got == ["actor_empty", None, "actor_too_long", None, "actor_empty"]


def test_truncation(spark):
    df = spark.createDataFrame([("c" * 200, "n" * 300), ("é" * 130, "short")], "c string, n string")
    rows = df.select(truncate("c", 128).alias("c"), truncate("n", 256).alias("n")).collect()
    assert [len(r.c) for r in rows] == [128, 128] and [len(r.n) for r in rows] == [256, 5]
    assert rows[1].c == "é" * 128          # characters, never a split byte sequence


def props(spark, d):
    return one(spark, sanitize_properties(F.col("p")), "p map<string,string>", d)


def test_sanitize_limits(spark):
    thirty = {f"k{i:02d}": f"v{i}" for i in range(30)}
    got = props(spark, thirty)
    assert len(got) == 20 and sorted(got) == sorted(thirty)[:20]
    assert props(spark, {"a": "", "b": ""}) is None
    # Empty values are skipped and do not count towards 20.
    mixed = {**{f"e{i:02d}": "" for i in range(10)}, **{f"k{i:02d}": "v" for i in range(25)}}
    assert len(props(spark, mixed)) == 20


def test_sanitize_key_value_boundaries(spark):
    d = {"a" * 64: "x", "b" * 65: "y", "c": "v" * 256, "d": "w" * 257, "e": "v" * 500}
    got = props(spark, d)
    assert "a" * 64 in got and "b" * 64 in got and "b" * 65 not in got
    assert len(got["c"]) == 256 and len(got["d"]) == 256 and len(got["e"]) == 256


def test_sanitize_colliding_keys(spark):
    d = {"z" * 64 + "a": "first", "z" * 64 + "b": "second", "k": "v"}
    got = props(spark, d)
    assert got == {"k": "v", "z" * 64: "second"}


def test_attempt_classes(spark):
    rows = [(200, False), (204, False), (400, False), (401, False), (402, False), (403, False), (404, False),
            (429, False), (500, False), (502, False), (503, False), (0, True), (304, False), (100, False)]
    df = spark.createDataFrame(rows, "s int, n boolean")
    got = [r.c for r in df.select(attempt_class("s", "n").alias("c")).collect()]
    assert got == ["success", "success", "permanent", "halt", "payment", "permanent", "permanent", "retryable",
                   "retryable", "retryable", "retryable", "retryable", "other", "other"]


def test_retry_after(spark):
    vals = ["120", " 7", "301", "99999", "-5", "-0", "abc", "12abc", "", None, "+3", "9999999999", "0005"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = [r.s for r in df.select(parse_retry_after("v").alias("s")).collect()]
    assert got == [120, 7, 300, 300, None, 0, None, 12, None, None, 3, None, 5]


def test_backoff(spark):
    df = spark.range(0, 9).select(backoff_ms(F.col("id")).alias("b"))
    assert [r.b for r in df.collect()] == [1000, 2000, 4000, 8000, 16000, 32000, 60000, 60000, 60000]


def test_ram_buckets(spark):
    mb = [1024, 2048, 3000, 6000, 12000, 24000, 32768, 64000]
    df = spark.createDataFrame([(m,) for m in mb], "m long")
    got = [r.b for r in df.select(ram_bucket("m").alias("b")).collect()]
    assert got == ["< 2 GB", "2-4 GB", "2-4 GB", "4-8 GB", "8-16 GB", "16-32 GB", "> 32 GB", "> 32 GB"]


def test_pseudonymize_and_path_key(spark):
    h = one(spark, pseudonymize("h"), "h string", "my-host")
    assert h == hashlib.sha256(b"my-host").hexdigest() and len(h) == 64
    assert one(spark, partition_key("a"), "a string", "My:App/v2\\test") == "My_App_v2_test"
    assert one(spark, partition_key("a"), "a string", 'a*b?c"d<e>f|g') == "a_b_c_d_e_f_g"


def test_uuid7_contract(spark):
    ts = dt.datetime(2026, 3, 13, 0, 0, 0, 123456)
    df = spark.createDataFrame([(ts, i) for i in range(200)], "ts timestamp_ntz, i long")
    ids = df.select(uuid7_from_key(F.col("ts"), F.col("i")).alias("u")).select(
        "u", uuid7_is_valid("u").alias("ok"), uuid7_millis("u").alias("ms"))
    rows = ids.collect()
    assert all(len(r.u) == 36 and r.u[14] == "7" and r.u[19] in "89ab" and r.ok for r in rows)
    assert len({r.u for r in rows}) == 200
    want_ms = int(dt.datetime(2026, 3, 13, 0, 0, 0, 123000, tzinfo=dt.timezone.utc).timestamp() * 1000)
    assert {r.ms for r in rows} == {want_ms}
    # Same key, same id (reruns and retries keep ids).
    again = df.select(uuid7_from_key(F.col("ts"), F.col("i")).alias("u")).collect()
    assert [r.u for r in again] == [r.u for r in rows]


def test_iso_millis_truncates(spark):
    ts = dt.datetime(2024, 1, 1, 0, 0, 7, 179575)
    assert one(spark, iso_millis("t"), "t timestamp_ntz", ts) == "2024-01-01T00:00:07.179Z"
