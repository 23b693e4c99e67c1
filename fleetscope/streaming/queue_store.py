"""Published snapshots of the durable queue.

Producers enqueue, the sender reads the oldest rows and acknowledges them, and
a byte cap evicts the oldest. Each of these is one version of the store: its
rows go to ``path/v=<version>/bucket=<b>`` and a pointer file, written last and
renamed, publishes it (``stateful.StateStore``). A reader takes the newest
pointer, so it sees a whole snapshot whatever is being written; the retry of a
version starts from the version before and replaces its own files.

An acknowledgement or eviction writes the keys that go, never the rows that
stay: the work follows the rows touched, also where one install holds a third of
the queue. Reading drops the rows whose key went in the same or a later
version, by one join on (install, id), which no hot install skews. A bucket
named by more than ``compact_after`` versions is rewritten whole by the next
version that touches it, over as many tasks and files as its size needs.

Defined cases: rows without an install or id cannot be acknowledged and are
refused (``refused``); equal keys within the queue are all kept and go by one
acknowledgement; a key enqueued again after it went is in the queue again;
acknowledged keys that are not in the queue, and null ones, change nothing;
empty inputs publish a version equal to the one before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope import config as C
from fleetscope.operators.queue import cap_queue, read_oldest
from fleetscope.plans.stage import stage
from fleetscope.streaming.stateful import BUCKETS, COMPACT_AFTER, KEEP, Pointer, StateStore

ROW = "install_id long, id long, event_id string, payload_json string, queued_at string, retry_count int"
KEY = ["install_id", "id"]
REFUSED = -1


class QueueStore(StateStore):
    """The durable queue of all installs; ``row`` is the schema of its rows."""

    def __init__(self, spark: SparkSession, path: str, row: str = ROW, buckets: int = BUCKETS,
                 compact_after: int = COMPACT_AFTER, keep: int = KEEP):
        super().__init__(spark, path, buckets, compact_after, keep)
        self.row = row
        self.columns = spark.createDataFrame([], row).columns
        self.files = f"{row}, bytes long, gone boolean, v long, bucket int"

    def _files(self, pointer: Pointer, buckets: list[int] | None = None) -> DataFrame:
        paths = self.paths(pointer, sorted(pointer.buckets) if buckets is None else buckets)
        if not paths:
            return self.spark.createDataFrame([], self.files)
        return self.spark.read.schema(self.files).option("basePath", self.path).parquet(*paths)

    def _live(self, pointer: Pointer, buckets: list[int] | None = None) -> DataFrame:
        """Rows in the queue, with their ``bytes`` and ``bucket``."""
        files = self._files(pointer, buckets)
        went = files.filter("gone").groupBy(*KEY).agg(F.max("v").alias("__went"))
        rows = files.filter("NOT gone").alias("q")
        gone = (F.col("q.install_id") == went["install_id"]) & (F.col("q.id") == went["id"]) & (went["__went"] >= F.col("q.v"))
        return rows.join(went, gone, "left_anti").select(*self.columns, "bytes", "bucket")

    def snapshot(self, version: int | None = None) -> DataFrame:
        """The queue as the given version published it; else the newest."""
        published = self.pointers()
        if version is not None and version not in published:
            raise ValueError(f"version {version} is not published, or expired")
        if not published:
            return self.spark.createDataFrame([], self.row)
        return self._live(self.pointer(published[-1] if version is None else version)).select(*self.columns)

    def oldest(self, n: int, version: int | None = None) -> DataFrame:
        """The first ``n`` rows by id of every install."""
        return read_oldest(self.snapshot(version), n)

    def refused(self, version: int) -> DataFrame:
        """Rows of an enqueued version without an install or id."""
        path = f"{self.path}/v={version}/bucket={REFUSED}"
        if not self.fs.exists(self._path(f"v={version}/bucket={REFUSED}")):
            return self.spark.createDataFrame([], self.row)
        return self.spark.read.schema(self.row).parquet(path)

    def _advance(self, version: int, start: Pointer, delta: DataFrame) -> Pointer:
        """Write and publish the delta, touched buckets of many versions whole."""
        path = f"{self.path}/v={version}"
        (delta.select(*self.columns, "bytes", "gone", "bucket").hint("rebalance", "bucket")
              .write.mode("overwrite").partitionBy("bucket").parquet(path))
        folders = [s.getPath().getName() for s in self.fs.listStatus(self._path(f"v={version}")) if s.isDirectory()]
        touched = sorted(int(f[7:]) for f in folders if f.startswith("bucket=") and f != f"bucket={REFUSED}")
        held = {b: list(v) for b, v in start.buckets.items()}
        for b in touched:
            held[b] = held.get(b, []) + [version]
        full = [b for b in touched if len(held[b]) > self.compact_after]
        if full:
            whole = self._live(Pointer({b: held[b] for b in full})).withColumn("gone", F.lit(False))
            # Beside the delta: the version is still unpublished, and a retry replaces both.
            (whole.hint("rebalance", "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{path}/whole/v={version}"))
            for b in full:
                held[b] = self._take_whole(version, b)
        pointer = Pointer({b: v for b, v in held.items() if v})
        self.publish(version, pointer)
        self.expire()
        return pointer

    def _take_whole(self, version: int, bucket: int) -> list[int]:
        """Put a rewritten bucket in the place of the version's delta."""
        new, place = self._path(f"v={version}/whole/v={version}/bucket={bucket}"), self._path(f"v={version}/bucket={bucket}")
        self.fs.delete(place, True)
        if not self.fs.exists(new):          # nothing is left in the bucket
            return []
        if not self.fs.rename(new, place):
            raise OSError(f"{place} was not written")
        return [version]

    def enqueue(self, version: int, rows: DataFrame) -> Pointer:
        """Append rows; those without an install or id are refused."""
        named = F.col("install_id").isNotNull() & F.col("id").isNotNull()
        r = rows.select(*[F.col(f"`{c}`") for c in self.columns])
        r = (r.withColumn("bytes", F.octet_length("payload_json").cast("long")).withColumn("gone", F.lit(False))
              .withColumn("bucket", F.when(named, self.bucket()).otherwise(F.lit(REFUSED))))
        return self._advance(version, self.before(version), r)

    def _remove(self, version: int, start: Pointer, keys: DataFrame) -> Pointer:
        types = {f.name: f.dataType for f in self.spark.createDataFrame([], self.row).schema}
        blank = [F.lit(None).cast(types[c]).alias(c) for c in self.columns if c not in KEY]
        gone = keys.select(*KEY, *blank, F.lit(None).cast("long").alias("bytes"), F.lit(True).alias("gone"), self.bucket().alias("bucket"))
        return self._advance(version, start, gone)

    def ack(self, version: int, acked: DataFrame) -> Pointer:
        """Take acknowledged keys (``install_id``, ``id``) out of the queue."""
        keys = acked.select(*KEY).dropna().distinct()
        start = self.before(version)
        held = self._live(start).select(*KEY).distinct()
        return self._remove(version, start, keys.join(held, KEY, "left_semi"))

    def cap(self, version: int, max_bytes: int | DataFrame, target_rows: int = C.DEFAULT_TARGET_ROWS) -> Pointer:
        """Evict the oldest rows of installs whose payloads reach the cap: one
        for all, or a table (``install_id``, ``cap``) with one row per install;
        installs that it does not name are not capped. Payloads are not read
        (their sizes are stored), and only full installs are numbered."""
        start = self.before(version)
        q = self._live(start).select(*KEY, "bytes")
        totals = q.groupBy("install_id").agg(F.sum("bytes").alias("__all"))
        if isinstance(max_bytes, int):
            totals = totals.withColumn("__limit", F.lit(max_bytes).cast("long"))
        else:
            totals = totals.join(max_bytes.select("install_id", F.col("cap").cast("long").alias("__limit")), "install_id")
        # Written once, so that Spark knows its size: few installs may hold all rows.
        full = stage(totals.filter("__all >= __limit").select("install_id", "__limit"), "full")
        judged = cap_queue(q.join(full, "install_id"), "__limit", target_rows=target_rows, size="bytes")
        return self._remove(version, start, judged.filter("evicted").select(*KEY).distinct())
