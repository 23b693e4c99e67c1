"""Redelivery index: weeks-old repeats, retries, hot buckets, expiry, odd ids."""

import datetime as dt
import random
import tempfile

import pytest
from pyspark.sql import functions as F

from fleetscope.functions.core import uuid7_from_key
from fleetscope.streaming.redelivery import UNTIMED, IdIndex, drop_redelivered

DAY0 = dt.datetime(2024, 3, 1)


def events(spark, picks):
    """(day, number) pairs -> events whose ids carry the day."""
    rows = [(DAY0 + dt.timedelta(days=d), n) for d, n in picks]
    df = spark.createDataFrame(rows, "ts timestamp_ntz, n long")
    return df.withColumn("event_id", uuid7_from_key("ts", F.col("n")))


def passed(spark, out, name="events"):
    return sorted(r.n for r in spark.read.option("recursiveFileLookup", "true").schema("ts timestamp_ntz, n long, event_id string").parquet(f"{out}/{name}").collect())


def test_repeats_after_weeks_and_retries(spark):
    rng = random.Random(2)
    base = tempfile.mkdtemp(prefix="fs-redelivery-")
    index = IdIndex(spark, f"{base}/index", compact_after=2)
    seen: set[tuple[int, int]] = set()
    for batch in range(6):
        new = [(batch * 9 + rng.randrange(9), 1000 * batch + i) for i in range(40)]
        old = rng.sample(sorted(seen), min(len(seen), 30))            # up to 54 days old
        rows = new + old + new[:7]
        drop_redelivered(events(spark, rows), batch, index, f"{base}/out")
        if batch in (2, 4):                                           # the same micro-batch again
            drop_redelivered(events(spark, rows), batch, index, f"{base}/out")
        seen |= set(new)
        assert passed(spark, f"{base}/out") == sorted(n for _, n in seen)
    pointer = index.before(6)
    assert sorted(r.id for r in index.ids(pointer, sorted(pointer.buckets)).collect()) == sorted(r.event_id for r in events(spark, sorted(seen)).collect())
    assert max(map(len, pointer.buckets.values())) <= 4               # compacted
    assert passed(spark, f"{base}/out", "expired") == []


def test_a_micro_batch_reads_its_own_buckets_only(spark):
    base = tempfile.mkdtemp(prefix="fs-redelivery-")
    index = IdIndex(spark, f"{base}/index")
    drop_redelivered(events(spark, [(d, d) for d in range(60)]), 0, index, f"{base}/out")
    day = int((DAY0 - dt.datetime(1970, 1, 1)).days)
    files = index.ids(index.before(1), [day + 7]).inputFiles()
    assert files and all(f"bucket={day + 7}/" in f for f in files)
    drop_redelivered(events(spark, [(7, 7), (7, 700)]), 1, index, f"{base}/out")
    assert {b: v for b, v in index.before(2).buckets.items() if len(v) > 1} == {day + 7: [0, 1]}


def test_buckets_expire_and_late_repeats_are_set_aside(spark):
    base = tempfile.mkdtemp(prefix="fs-redelivery-")
    index = IdIndex(spark, f"{base}/index", keep_hours=24 * 10, keep=1)
    drop_redelivered(events(spark, [(d, d) for d in range(12)]), 0, index, f"{base}/out")
    drop_redelivered(events(spark, [(20, 20)]), 1, index, f"{base}/out")
    drop_redelivered(events(spark, [(3, 3), (15, 15), (11, 11), (21, 21)]), 2, index, f"{base}/out")
    assert passed(spark, f"{base}/out", "expired") == [0, 3]          # day 0 lay outside from the first batch on
    assert passed(spark, f"{base}/out") == sorted([*range(1, 12), 20, 15, 21])
    day = int((DAY0 - dt.datetime(1970, 1, 1)).days)
    assert min(index.before(3).buckets) >= day + 11


def test_ids_without_time_nulls_and_empty_batches(spark):
    base = tempfile.mkdtemp(prefix="fs-redelivery-")
    index = IdIndex(spark, f"{base}/index", keep_hours=24)
    odd = spark.createDataFrame([(DAY0, 1, "ord-1"), (DAY0, 1, "ord-1"), (DAY0, 2, ""), (DAY0, 3, None), (DAY0, 4, None)], "ts timestamp_ntz, n long, event_id string")
    drop_redelivered(odd.limit(0), 0, index, f"{base}/out")
    drop_redelivered(odd, 1, index, f"{base}/out")
    drop_redelivered(odd.unionByName(events(spark, [(900, 5)])), 2, index, f"{base}/out")
    assert passed(spark, f"{base}/out") == [1, 2, 3, 3, 4, 4, 5]
    assert all(-UNTIMED <= b < 0 for b in index.before(2).buckets)


def test_a_failed_micro_batch_leaves_no_trace(spark, monkeypatch):
    base = tempfile.mkdtemp(prefix="fs-redelivery-")
    index = IdIndex(spark, f"{base}/index")
    drop_redelivered(events(spark, [(1, 1)]), 0, index, f"{base}/out")
    monkeypatch.setattr(index, "publish", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        drop_redelivered(events(spark, [(1, 1), (1, 2)]), 1, index, f"{base}/out")
    monkeypatch.undo()
    drop_redelivered(events(spark, [(1, 1), (1, 2)]), 1, index, f"{base}/out")
    assert passed(spark, f"{base}/out") == [1, 2]
