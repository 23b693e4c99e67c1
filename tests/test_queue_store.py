"""Published queue snapshots against a plain list kept in Python."""

import random
import tempfile

import pytest
from pyspark.sql import functions as F

from fleetscope.streaming.queue_store import QueueStore

ROW = "install_id long, id long, payload_json string"
SIZE = 40


def table(spark, rows):
    return spark.createDataFrame([(i, n, "x" * SIZE) for i, n in rows], ROW)


def keys(df):
    return sorted((r.install_id, r.id) for r in df.select("install_id", "id").collect())


def capped(queue, limit):
    """The client's loop: blocks of 100 oldest rows go until below the limit."""
    for install in {i for i, _ in queue}:
        own = sorted(n for i, n in queue if i == install)
        if len(own) * SIZE >= limit:
            while own and len(own) * SIZE >= limit:
                own = own[100:]
        queue = [(i, n) for i, n in queue if i != install or n in set(own)]
    return sorted(queue)


def store(spark, **kw):
    return QueueStore(spark, tempfile.mkdtemp(prefix="fs-queue-") + "/q", ROW, buckets=4, **kw)


@pytest.mark.parametrize("compact_after", [1, 2, 50])
def test_rounds_of_enqueue_read_ack_and_cap(spark, compact_after):
    rng, s, queue, version, next_id = random.Random(compact_after), store(spark, compact_after=compact_after, keep=20), [], 0, 1
    for _ in range(3):
        new = []
        for _ in range(400):
            new.append((1 if rng.random() < 0.7 else rng.randrange(2, 9), next_id))      # install 1 is hot
            next_id += rng.randrange(1, 4)
        s.enqueue(version, table(spark, new))
        queue = sorted(queue + new)
        assert keys(s.snapshot()) == queue
        oldest = [k for i in range(1, 9) for k in [k for k in queue if k[0] == i][:25]]
        assert keys(s.oldest(25)) == sorted(oldest)
        s.ack(version + 1, table(spark, oldest[::2] + oldest[:3] + [(1, 10 ** 9), (77, 1)]))
        queue = sorted(set(queue) - set(oldest[::2]) - set(oldest[:3]))
        assert keys(s.snapshot()) == queue
        before = list(queue)
        s.cap(version + 2, 300 * SIZE, target_rows=50)
        queue = capped(queue, 300 * SIZE)
        assert keys(s.snapshot()) == queue
        assert keys(s.snapshot(version + 1)) == before                                   # older snapshots stay whole
        version += 3
    assert len(queue) < len(before)
    assert max(map(len, s.before(99).buckets.values())) <= max(compact_after, 1) or compact_after == 50


def test_a_retry_replaces_its_own_files_and_a_failure_leaves_no_trace(spark):
    s = store(spark, compact_after=1, keep=9)
    rows = [(i % 3, n) for n, i in enumerate(range(60))]
    s.enqueue(0, table(spark, rows))
    failing = table(spark, rows[:9]).withColumn("id", F.when(F.col("id") == 4, F.raise_error(F.lit("lost")).cast("long")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="lost"):
        s.ack(1, failing)
    assert s.pointers() == [0] and keys(s.snapshot()) == sorted(rows)
    for _ in range(2):
        s.ack(1, table(spark, rows[:9]))
        assert keys(s.snapshot()) == sorted(rows[9:])
    s.enqueue(2, table(spark, rows[:2]))                                                 # in the queue again
    assert keys(s.snapshot()) == sorted(rows[9:] + rows[:2])
    assert keys(s.snapshot(1)) == sorted(rows[9:])


def test_an_ack_writes_keys_only_and_touches_their_buckets_only(spark):
    s = store(spark)
    s.enqueue(0, table(spark, [(i, n) for i in range(40) for n in range(5)]))
    start = s.before(1)
    s.ack(1, table(spark, [(7, 0), (7, 1)]))
    now = s.before(2)
    (touched,) = [b for b in now.buckets if now.buckets[b] != start.buckets[b]]
    assert now.buckets[touched] == [0, 1]
    written = s._files(now, [touched]).filter("v = 1").collect()
    assert [(r.install_id, r.id, r.payload_json, r.gone) for r in sorted(written)] == [(7, 0, None, True), (7, 1, None, True)]


def test_old_versions_expire_with_their_files(spark):
    s = store(spark, compact_after=1, keep=2)
    for v in range(6):
        s.enqueue(v, table(spark, [(i, v * 100 + i) for i in range(20)]))
    assert s.pointers() == [4, 5]
    assert keys(s.snapshot()) == sorted((i, v * 100 + i) for v in range(6) for i in range(20))
    assert keys(s.snapshot(4)) == sorted((i, v * 100 + i) for v in range(5) for i in range(20))
    with pytest.raises(ValueError):
        s.snapshot(1)


def test_odd_rows(spark):
    s = store(spark, keep=20)
    assert keys(s.snapshot()) == [] and keys(s.oldest(3)) == []
    empty = table(spark, [(1, 1)]).limit(0)
    s.enqueue(0, empty)
    s.ack(1, empty)
    s.cap(2, 10)
    assert keys(s.snapshot()) == []
    odd = spark.createDataFrame([(1, 5, "a", "z"), (1, 5, "b", "z"), (None, 1, "c", "z"), (1, None, "d", "z"), (2, 9, None, "z"), (2, 10, "", "z")],
                                ROW + ", gone string")                                  # an extra column with a clashing name
    s.enqueue(3, odd)
    assert keys(s.snapshot()) == [(1, 5), (1, 5), (2, 9), (2, 10)]
    assert sorted(r.payload_json for r in s.refused(3).collect()) == ["c", "d"] and s.refused(2).count() == 0
    s.ack(4, spark.createDataFrame([(1, 5), (None, 9), (2, None)], "install_id long, id long"))
    assert keys(s.snapshot()) == [(2, 9), (2, 10)]
    s.cap(5, spark.createDataFrame([(2, 0), (3, 0)], "install_id long, cap long"))       # a limit of none: all goes
    assert keys(s.snapshot()) == []


def test_caps_per_install(spark):
    s = store(spark, keep=9)
    rows = [(i, n) for i in (1, 2, 3) for n in range(250)]
    s.enqueue(0, table(spark, rows))
    s.cap(1, spark.createDataFrame([(1, 100 * SIZE), (2, 10 ** 9)], "install_id long, cap long"))
    left = s.snapshot().groupBy("install_id").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    assert sorted(tuple(r) for r in left.collect()) == [(1, 50, 200), (2, 250, 0), (3, 250, 0)]
