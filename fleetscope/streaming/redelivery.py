"""Redelivered events dropped by an index of ids in time buckets.

An event id carries its own millisecond, so an event that comes again after
weeks names the very bucket that its first delivery was entered in. The index
is a table of ids under ``index_dir/v=<batch>/bucket=<b>``, one bucket per
``hours`` of id time. A micro-batch reads the buckets of its own ids alone
and writes the ids that are new; nothing is held in memory between
micro-batches, and the work follows the buckets touched, not the age of the
index. Pointer files publish versions as in ``stateful.StateStore``: the retry
of a batch id starts from the version before and replaces its own files, and
a bucket of many deltas is rewritten whole.

With ``keep_hours`` the index is bounded too: buckets that end more than that
before the newest id go, and events whose bucket is gone cannot be judged any
more; they are set aside under ``expired`` and never dropped or passed.

Outputs under ``out_dir/<name>/batch_id=<id>``: ``events`` and ``expired``.

Defined cases: ids that are no version-7 ids have no time and share 64 hash
buckets that never expire; rows without an id are all passed on; of equal ids in
one micro-batch one row stays (redeliveries are equal rows).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope.functions.core import uuid7_is_valid, uuid7_millis
from fleetscope.streaming.stateful import Pointer, StateStore

UNTIMED = 64


class IdIndex(StateStore):
    """Ids seen, by time bucket."""

    def __init__(self, spark: SparkSession, path: str, hours: int = 24, keep_hours: int | None = None, compact_after: int = 8, keep: int = 3):
        super().__init__(spark, path, hours, compact_after, keep)
        self.hours, self.keep_hours = hours, keep_hours

    def id_bucket(self, key: str) -> Column:
        """Number of the id's time bucket; below zero for ids without a time."""
        untimed = -1 - F.pmod(F.xxhash64(key), F.lit(UNTIMED))
        return F.when(uuid7_is_valid(key), F.floor(uuid7_millis(key) / F.lit(self.hours * 3_600_000))).otherwise(untimed).cast("long")

    def ids(self, pointer: Pointer, buckets: list[int]) -> DataFrame:
        paths = self.paths(pointer, buckets)
        if not paths:
            return self.spark.createDataFrame([], "id string, bucket long")
        return self.spark.read.schema("id string, v long, bucket long").option("basePath", self.path).parquet(*paths).select("id", "bucket")

    def oldest_kept(self, pointer: Pointer, buckets: list[int]) -> int | None:
        """First time bucket that is kept, given the buckets of a micro-batch."""
        timed = [b for b in (*pointer.buckets, *buckets) if b >= 0]
        return max(timed) - -(-self.keep_hours // self.hours) if self.keep_hours is not None and timed else None

    def enter(self, version: int, start: Pointer, new: DataFrame, buckets: list[int], oldest: int | None) -> Pointer:
        """Write the new ids (id, bucket), whole buckets where deltas are many,
        and publish. A large bucket is split over several tasks and files."""
        held = {b: list(v) for b, v in start.buckets.items() if oldest is None or b < 0 or b >= oldest}
        full = [b for b in buckets if len(held.get(b, [])) > self.compact_after]
        rows = new.unionByName(self.ids(start, full)) if full else new
        (rows.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/v={version}"))
        for b in buckets:
            held[b] = [version] if b in full else held.get(b, []) + [version]
        pointer = Pointer(held)
        self.publish(version, pointer)
        return pointer


def drop_redelivered(events: DataFrame, batch_id: int, index: IdIndex, out_dir: str, key: str = "event_id") -> None:
    """One micro-batch: events whose id is new are written, and entered."""
    spark = events.sparkSession
    start = index.before(batch_id)
    e = events.withColumn("__bucket", index.id_bucket(key))
    # One number per time bucket of the batch, as partition pruning lists them.
    touched = sorted(r["__bucket"] for r in e.filter(F.col(key).isNotNull()).select("__bucket").distinct().collect())
    oldest = index.oldest_kept(start, touched)
    gone = F.lit(False) if oldest is None else (F.col("__bucket") >= 0) & (F.col("__bucket") < oldest)
    named = F.col(key).isNotNull()
    e.filter(named & gone).drop("__bucket").write.mode("overwrite").parquet(f"{out_dir}/expired/batch_id={batch_id}")
    kept = [b for b in touched if oldest is None or b < 0 or b >= oldest]
    known = index.ids(start, kept).select(F.col("id").alias(key), F.col("bucket").alias("__bucket"))
    new = e.filter(named & ~gone).dropDuplicates(["__bucket", key]).join(known, ["__bucket", key], "left_anti")
    fresh = new.unionByName(e.filter(~named)).select(*[F.col(f"`{c}`") for c in events.columns])
    path = f"{out_dir}/events/batch_id={batch_id}"
    fresh.write.mode("overwrite").parquet(path)
    entered = (spark.read.schema(fresh.schema).parquet(path).filter(named)
                    .select(F.col(key).alias("id"), index.id_bucket(key).alias("bucket")))
    grown = sorted(r["bucket"] for r in entered.select("bucket").distinct().collect())
    index.enter(batch_id, start, entered, grown, oldest)
    index.expire()


def redelivery_stream(events: DataFrame, index_dir: str, out_dir: str, checkpoint: str, key: str = "event_id", hours: int = 24,
                      keep_hours: int | None = None, **trigger):
    """Start the stream; ``trigger`` as for ``DataStreamWriter``."""
    def batch(rows: DataFrame, batch_id: int) -> None:
        drop_redelivered(rows, batch_id, IdIndex(rows.sparkSession, index_dir, hours, keep_hours), out_dir, key)

    w = events.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (w.trigger(**trigger) if trigger else w).start()
