"""Slices cut at quantiles of the whole order key."""

import datetime as dt
import random

from pyspark.sql import functions as F

from fleetscope import schemas
from fleetscope.operators import queue as qm
from fleetscope.operators.scan import Scan, cut_slices, hot_aware_slice, ordered_scan

NOON = dt.datetime(2024, 5, 1, 12)


def sizes(df, key="install_id"):
    return {(r[0], r[1]): r["count"] for r in df.groupBy(key, "slice").count().collect()}


def test_a_million_calls_at_one_timestamp_split_evenly(spark):
    n, target = 1_000_000, 50_000
    burst = spark.range(n).select(F.lit(1).cast("long").alias("install_id"), F.lit(NOON).cast("timestamp_ntz").alias("ts"), F.col("id").alias("seq"))
    got = sizes(hot_aware_slice(burst, "install_id", "ts", target))
    assert sum(got.values()) == n and len(got) >= 16 and max(got.values()) <= 1.4 * target, got
    done = ordered_scan(hot_aware_slice(burst, "install_id", "ts", target), "install_id", ["ts", "seq"], [Scan("rn", "sum_incl", F.lit(1))])
    assert done.filter(F.col("rn") != F.col("seq") + 1).isEmpty()


def test_slices_follow_the_order_and_cold_keys_stay_whole(spark):
    rng = random.Random(11)
    rows = [(1, rng.choice([5, 6, 7]) * 10 ** 12 + rng.randrange(50) ** 4, f"{i:05d}") for i in range(5000)] + [(2, 7, "a"), (2, 8, "b"), (None, 1, "n")]
    df = spark.createDataFrame(rows, "install_id long, a long, b string")
    cut = cut_slices(df, "install_id", ["a", "b"], None, 100)
    got = sorted((r.a, r.b, r.slice) for r in cut.filter("install_id = 1").collect())
    parts = [s for _, _, s in got]
    assert parts == sorted(parts) and set(parts) == set(range(50))            # exact below the sample's rate
    assert all(parts.count(p) == 100 for p in set(parts))
    assert {r.slice for r in cut.filter("install_id = 2 OR install_id IS NULL").collect()} == {0}
    assert cut.columns == ["install_id", "a", "b", "slice"] and cut.count() == len(rows)


def test_more_cuts_than_one_group_holds(spark):
    df = spark.range(3000).select(F.lit(4).cast("long").alias("install_id"), F.col("id").alias("a"))
    got = {r.a: r.slice for r in cut_slices(df, "install_id", ["a"], None, 5).collect()}
    assert got == {a: a // 5 for a in range(3000)}


def test_null_order_values_and_empty_tables(spark):
    df = spark.createDataFrame([(1, None)] * 3 + [(1, i) for i in range(40)], "install_id long, a long")
    got = [r.slice for r in cut_slices(df, "install_id", ["a"], None, 10).orderBy(F.col("a").asc_nulls_first()).collect()]
    assert got == sorted(got) and len(set(got)) >= 4
    assert cut_slices(df.limit(0), "install_id", ["a"], None, 10).collect() == []


def test_queue_operators_over_sparse_ids(spark):
    """Ids far apart (as time-based or hashed ids are) and one hot queue."""
    rng = random.Random(3)
    ids = sorted(rng.sample(range(1 << 60), 900))
    rows = [(1 if i % 10 else 2, x, "p" * rng.randrange(50, 400)) for i, x in enumerate(ids)]
    q = spark.createDataFrame(rows, "install_id long, id long, payload_json string")
    for target in (40, 10 ** 6):
        b = qm.form_batches(q, 25, target_rows=target).collect()
        by_install = {i: [r for r in rows if r[0] == i] for i in (1, 2)}
        want = {(i, k // 25): (len(rs[k:k + 25]), rs[k][1]) for i, rs in by_install.items() for k in range(0, len(rs), 25)}
        assert {(r.install_id, r.batch_no): (r.n_events, r.first_id) for r in b} == want
        capped = {(r.install_id, r.id): r.evicted for r in qm.cap_queue(q, 60_000, target_rows=target).collect()}
        for i, rs in by_install.items():
            start = 0
            while sum(len(r[2]) for r in rs[start:]) >= 60_000:
                start += 100
            assert [capped[(i, r[1])] for r in rs] == [k < start for k in range(len(rs))]
    d = q.select("install_id", F.lit(NOON).cast("timestamp_ntz").alias("ts"), F.col("id").alias("seq"))
    got = qm.delivery_order(d.filter("install_id = 1"), d, target_rows=30).filter("install_id = 1").orderBy("delivery_pos").collect()
    assert [r.delivery_pos for r in got] == list(range(1, len(got) + 1))
    mine = [r[1] for r in rows if r[0] == 1]
    assert [(r.origin, r.seq) for r in got] == [("durable", x) for x in mine] + [("memory", x) for x in mine]


def test_cap_joins_a_queue_by_its_slices(spark):
    q = spark.range(6000).select(F.lit(1).cast("long").alias("install_id"), "id", F.lit("x" * 100).alias("payload_json"))
    held = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    for k, v in held.items():
        spark.conf.set(k, v)
    try:
        capped = qm.cap_queue(q, 250_000, target_rows=300)
        parts = capped.groupBy(F.spark_partition_id()).agg(F.count("id").alias("n"), F.count_if("evicted").alias("gone")).collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(r["n"] for r in parts) == 6000 and sum(r["gone"] for r in parts) == 3600
    assert max(r["n"] for r in parts) < 3000, parts
