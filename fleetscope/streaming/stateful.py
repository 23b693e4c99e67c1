"""Per-install state across micro-batches (``foreachBatch``).

Each micro-batch runs the batch operators over its new calls. For every
install that it touches, one ``__resume`` row carries the saved state
(consent, actor, session, device epoch and its start, clock start, accepted
tracks, breadcrumb ring number) into the same skew-safe scans; the saved
breadcrumbs come as extra track rows, and the saved first link of the device
decides conflicts. Results are exactly those of one batch run over all calls.

**Store.** One row per install, under ``state_dir/v=<batch>/bucket=<b>``: a
micro-batch writes rows of the installs it touched only. A pointer file per
version lists, for each bucket, the versions that hold it: a whole one and the
deltas since. A micro-batch reads the touched buckets alone, the newest row of
each install counts, and a touched bucket with ``compact_after`` deltas is
rewritten whole. So the work follows the active installs, not all of them. The
pointer file is written last, under a temporary name and renamed: a failed
micro-batch leaves no trace, and its retry reads the version before and
replaces its own files. Versions that no pointer of the last ``keep`` names go.

**Ring.** Accepted tracks are numbered without gaps per install, so the last
``n`` breadcrumbs are the tracks numbered above ``track_no - n`` of the current
ring. Each slice of an install keeps its own last ``n`` first (a group limit
within the slice), so no task sees a whole install, and at most ``n`` (200)
rows meet in the saved row.

Outputs per micro-batch, under ``out_dir/<name>/batch_id=<id>``: ``state``,
``exception_reports``, ``session_starts``, ``session_ends`` (also of sessions
begun in earlier micro-batches), ``identity_links`` and ``late_calls``. Calls
older than their install's saved position cannot be replayed into a state that
has moved on; they go to ``late_calls`` (never dropped).
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetscope.functions.core import iso_millis
from fleetscope.operators.breadcrumbs import TRACK_COLS, exception_reports
from fleetscope.operators.config import attach_app_config
from fleetscope.operators.sessions import build_sessions
from fleetscope.operators.state import PROCESS_OPS, RESUME_OP, SNAPSHOT_COLS, scan_state

CRUMB = "struct<track_no:bigint,ts:timestamp_ntz,category:string,name:string,properties:map<string,string>>"
SAVED = ("install_id long, source_app string, last_ts timestamp_ntz, last_seq long, opted_out boolean, actor string, session string, "
         "epoch long, epoch_start timestamp_ntz, first_ts timestamp_ntz, track_no long, ring long, max_breadcrumbs int, "
         f"device_link string, crumbs array<{CRUMB}>")
BUCKETS, COMPACT_AFTER, KEEP = 64, 8, 3

STATE_OUT = ["install_id", "ts", "seq", "op", "opted_out_before", "opted_out_after", "epoch", "device_id",
             "gate_reason", "reject_reason", "accepted", "actor_id", "session_id", "track_no"]
OUTPUTS = ("state", "exception_reports", "session_starts", "session_ends", "identity_links", "late_calls")


@dataclass
class Pointer:
    """Which versions hold each bucket: a whole one first, then deltas."""
    buckets: dict[int, list[int]] = field(default_factory=dict)

    def versions(self) -> set[int]:
        return {v for held in self.buckets.values() for v in held}


class StateStore:
    """Saved rows of all installs in Parquet files, and the pointer files."""

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS, compact_after: int = COMPACT_AFTER, keep: int = KEEP):
        self.spark, self.path = spark, path.rstrip("/")
        self.buckets, self.compact_after, self.keep = buckets, compact_after, keep
        self.jvm = spark.sparkContext._jvm
        self.fs = self._path("").getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def bucket(self, install: str = "install_id"):
        return F.pmod(F.xxhash64(install), F.lit(self.buckets)).cast("int")

    def pointers(self) -> list[int]:
        """Published versions, ascending."""
        folder = self._path("pointers")
        if not self.fs.exists(folder):
            return []
        names = [s.getPath().getName() for s in self.fs.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and not n.startswith("_"))

    def pointer(self, version: int) -> Pointer:
        stream = self.fs.open(self._path(f"pointers/{version}.json"))
        try:
            text = self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        saved = json.loads(text)
        if saved["n_buckets"] != self.buckets:
            raise ValueError(f"the store has {saved['n_buckets']} buckets, not {self.buckets}")
        return Pointer({int(b): v for b, v in saved["held"].items()})

    def before(self, version: int) -> Pointer:
        """The state that micro-batch ``version`` starts from."""
        earlier = [v for v in self.pointers() if v < version]
        return self.pointer(earlier[-1]) if earlier else Pointer()

    def publish(self, version: int, pointer: Pointer) -> None:
        text = json.dumps({"n_buckets": self.buckets, "held": pointer.buckets}, sort_keys=True)
        part, name = self._path(f"pointers/_{version}.part"), self._path(f"pointers/{version}.json")
        stream = self.fs.create(part, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        self.fs.delete(name, False)
        if not self.fs.rename(part, name):
            raise OSError(f"{name} was not published")

    def expire(self) -> None:
        """Remove what the last ``keep`` pointers do not name."""
        published = self.pointers()
        old, recent = published[:-self.keep], published[-self.keep:]
        if not old:
            return
        live = set().union(*(self.pointer(v).versions() for v in recent))
        for version in sorted(set(old) | set().union(*(self.pointer(v).versions() for v in old))):
            if version not in live and version not in recent:
                self.fs.delete(self._path(f"v={version}"), True)
        for version in old:
            self.fs.delete(self._path(f"pointers/{version}.json"), False)

    def paths(self, pointer: Pointer, buckets: list[int]) -> list[str]:
        return [f"{self.path}/v={v}/bucket={b}" for b in buckets for v in pointer.buckets.get(b, [])]

    def read(self, pointer: Pointer, buckets: list[int]) -> DataFrame:
        """Newest saved row of every install of the buckets (an aggregate of
        at most one row per install and version)."""
        paths = self.paths(pointer, buckets)
        if not paths:
            return self.spark.createDataFrame([], SAVED)
        rows = self.spark.read.schema(SAVED + ", v long, bucket int").option("basePath", self.path).parquet(*paths)
        columns = [F.col(c) for c in rows.columns if c not in ("install_id", "v", "bucket")]
        newest = rows.groupBy("install_id").agg(F.max_by(F.struct(*columns), "v").alias("s"))
        return newest.select("install_id", "s.*")

    def save(self, version: int, start: Pointer, changed: DataFrame, touched: list[int]) -> Pointer:
        """Write the changed rows as deltas, and buckets with many deltas as a
        whole; publish and return the new pointer."""
        whole = [b for b in touched if len(start.buckets.get(b, [])) > self.compact_after or b not in start.buckets]
        grown = [b for b in whole if b in start.buckets]
        rows = changed
        if grown:
            rest = self.read(start, grown).join(changed.select("install_id"), "install_id", "left_anti")
            rows = rows.unionByName(rest)
        # One file a bucket: a bucket's rows are a bounded share of the installs.
        (rows.withColumn("bucket", self.bucket()).repartition("bucket")
             .write.mode("overwrite").partitionBy("bucket").parquet(f"{self.path}/v={version}"))
        held = {b: list(v) for b, v in start.buckets.items()}
        for b in touched:
            held[b] = [version] if b in whole else held[b] + [version]
        pointer = Pointer(held)
        self.publish(version, pointer)
        return pointer


def _late(calls: DataFrame, saved: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Calls at or before their install's saved position, and the others."""
    c = calls.join(saved.select("install_id", "last_ts", "last_seq"), "install_id", "left")
    late = F.coalesce((F.col("ts") < F.col("last_ts")) | ((F.col("ts") == F.col("last_ts")) & (F.col("seq") <= F.col("last_seq"))), F.lit(False))
    return c.filter(late).drop("last_ts", "last_seq"), c.filter(~late).drop("last_ts", "last_seq")


def resume_rows(saved: DataFrame) -> DataFrame:
    """One row per install that carries its saved state into the scans."""
    return saved.select(
        "install_id", F.col("last_ts").alias("ts"), F.col("last_seq").alias("seq"), F.lit(RESUME_OP).alias("op"), "source_app",
        F.col("opted_out").alias("snap_opted_out"), F.col("actor").alias("snap_actor"), F.col("session").alias("snap_session"),
        F.col("epoch").alias("snap_epoch"), F.col("epoch_start").alias("snap_epoch_start"), F.col("first_ts").alias("snap_first_ts"),
        F.col("track_no").alias("snap_track_no"), F.col("ring").alias("snap_ring"))


def saved_tracks(saved: DataFrame) -> DataFrame:
    """The saved breadcrumbs as accepted tracks."""
    s = saved.select("install_id", "ring", "max_breadcrumbs", F.explode("crumbs").alias("c"))
    return s.select("install_id", "ring", "max_breadcrumbs", "c.*").select(*TRACK_COLS)


def links(state: DataFrame, saved: DataFrame) -> DataFrame:
    """Identity links of a micro-batch. A device's first link wins: that of an
    earlier micro-batch (saved with the install while its device lasts), else
    the first one here."""
    new = state.filter(F.col("accepted") & (F.col("op") == "identify")
                       & (F.coalesce(F.col("actor_before"), F.lit("")) != F.col("explicit_actor")))
    new = new.select("install_id", "ts", "seq", "epoch", F.col("device_id").alias("anonymous_actor_id"),
                     F.col("explicit_actor").alias("identified_actor_id"), "source_app", "source_version")
    first = new.groupBy("install_id", "epoch").agg(F.min_by("identified_actor_id", F.struct("ts", "seq")).alias("here"))
    earlier = saved.filter("device_link IS NOT NULL").select("install_id", "epoch", F.col("device_link").alias("earlier"))
    won = first.join(earlier, ["install_id", "epoch"], "left").select("install_id", "epoch", F.coalesce("earlier", "here").alias("winner"))
    return (new.join(won, ["install_id", "epoch"])
               .select("install_id", "ts", "seq", "epoch", "anonymous_actor_id", "identified_actor_id", iso_millis("ts").alias("identified_at"),
                       "source_app", "source_version", (F.col("identified_actor_id") != F.col("winner")).alias("conflict"), "winner"))


def last_tracks(state: DataFrame, saved: DataFrame, now: DataFrame) -> DataFrame:
    """The breadcrumbs of each install: (install_id, crumbs). ``now`` holds
    each install's track count, ring and limit after the micro-batch."""
    own = state.filter(F.col("accepted") & (F.col("op") == "track") & (F.col("max_breadcrumbs") > 0)).select("slice", *TRACK_COLS)
    w = Window.partitionBy("install_id", "slice").orderBy(F.col("track_no").desc())
    # 200 is the most that any app keeps; Spark limits each slice's groups
    # before and after its exchange.
    own = own.withColumn("rn", F.row_number().over(w)).filter("rn <= 200").filter(F.col("rn") <= F.col("max_breadcrumbs")).drop("rn", "slice")
    both = own.unionByName(saved_tracks(saved)).drop("max_breadcrumbs")
    last = now.select("install_id", "ring", F.col("track_no").alias("upto"), "max_breadcrumbs")
    kept = both.join(last, ["install_id", "ring"]).filter(F.col("track_no") > F.col("upto") - F.col("max_breadcrumbs"))
    return kept.groupBy("install_id").agg(F.collect_list(F.struct("track_no", "ts", "category", "name", "properties")).alias("crumbs"))


def next_saved(state: DataFrame, saved: DataFrame, new_links: DataFrame) -> DataFrame:
    """Saved rows of all installs of a micro-batch: partial aggregates of the
    last values, never a window over a whole install."""
    op, acc, ex = F.col("op"), F.col("accepted"), F.col("explicit_actor")
    rs = op == RESUME_OP
    place = [F.col("ts"), F.col("seq"), (~rs).alias("new")]

    def last(x):
        return F.max(F.when(x.isNotNull(), F.struct(*place, x.alias("v"))))["v"]

    clears = op.isin("reset", *PROCESS_OPS)
    actor = (F.when(rs, F.col("snap_actor")).when(acc & (op == "identify"), ex)
              .when(acc & (op == "start_session") & ex.isNotNull(), ex).when(clears, F.lit("")))
    session = (F.when(rs, F.col("snap_session")).when(acc & (op == "start_session"), F.col("new_session_id"))
                .when(acc & (op == "end_session") | clears, F.lit("")))
    count = lambda snap, hit: (F.coalesce(F.max(snap), F.lit(0)) + F.count_if(hit)).cast("long")
    now = state.groupBy("install_id").agg(
        F.max(F.struct(*place, "source_app", "max_breadcrumbs")).alias("p"),
        F.coalesce(last(F.col("opted_out_after")), F.lit(False)).alias("opted_out"),
        F.coalesce(last(actor), F.lit("")).alias("actor"), F.coalesce(last(session), F.lit("")).alias("session"),
        count("snap_epoch", op == "reset").alias("epoch"), count("snap_ring", clears).alias("ring"),
        last(F.when(rs, F.col("snap_epoch_start")).when(op == "reset", F.col("ts"))).alias("epoch_start"),
        F.min(F.when(rs, F.col("snap_first_ts")).otherwise(F.col("ts"))).alias("first_ts"),
        F.max("track_no").alias("track_no"))
    now = now.select("install_id", F.col("p.new").alias("new"), F.col("p.source_app").alias("source_app"), F.col("p.ts").alias("last_ts"), F.col("p.seq").alias("last_seq"),
                     "opted_out", "actor", "session", "epoch", "epoch_start", "first_ts", F.col("track_no").cast("long").alias("track_no"),
                     "ring", F.col("p.max_breadcrumbs").alias("max_breadcrumbs"))
    # Installs whose calls were all late stay as they are saved.
    now = now.filter("new").drop("new")
    # The link of the device that the install has now.
    link = (new_links.select("install_id", "epoch", "winner").unionByName(
                saved.filter("device_link IS NOT NULL").select("install_id", "epoch", F.col("device_link").alias("winner")))
            .groupBy("install_id", "epoch").agg(F.min("winner").alias("device_link")))
    crumbs = last_tracks(state.filter(~rs), saved, now)
    return now.join(link, ["install_id", "epoch"], "left").join(crumbs, "install_id", "left").select(*_names(SAVED))


def _names(schema: str) -> list[str]:
    return T.StructType.fromDDL(schema).fieldNames()


def process_batch(calls: DataFrame, batch_id: int, app_config: DataFrame, state_dir: str, out_dir: str,
                  initial_consent: DataFrame | None = None, store: StateStore | None = None) -> None:
    """One micro-batch: resume, reconstruct, write outputs and saved rows.

    ``initial_consent(install_id, opted_out)`` is the flag an install starts
    with; it counts until the install's first saved row."""
    spark = calls.sparkSession
    store = store or StateStore(spark, state_dir)

    def out(df: DataFrame, name: str) -> None:
        df.write.mode("overwrite").parquet(f"{out_dir}/{name}/batch_id={batch_id}")

    start = store.before(batch_id)
    touched = sorted(r["b"] for r in calls.select(store.bucket().alias("b")).distinct().collect())     # at most the bucket count
    work = f"{store.path}/work"
    # Saved rows of the touched installs alone; written once, as every step reads them.
    active = calls.select("install_id").distinct()
    store.read(start, touched).join(active, "install_id", "left_semi").write.mode("overwrite").parquet(f"{work}/saved")
    saved = spark.read.schema(SAVED).parquet(f"{work}/saved")
    late, fresh = _late(calls, saved)
    out(late, "late_calls")
    changed = sorted(r["b"] for r in fresh.select(store.bucket().alias("b")).distinct().collect())
    rows = fresh
    for k, t in SNAPSHOT_COLS.items():
        rows = rows.withColumn(k, F.lit(None).cast(t))
    rows = rows.unionByName(resume_rows(saved), allowMissingColumns=True)
    # The scan runs once and is written; the outputs read their columns of it.
    scan_state(attach_app_config(rows, app_config), initial_consent).write.mode("overwrite").parquet(f"{work}/state")
    st = spark.read.parquet(f"{work}/state")
    real = st.filter(F.col("op") != RESUME_OP)
    out(real.select(*STATE_OUT), "state")
    out(exception_reports(real, extra_tracks=saved_tracks(saved)), "exception_reports")
    begun = build_sessions(real)
    out(begun, "session_starts")
    # Sessions carried over from earlier micro-batches that end (or are lost) here.
    change = F.col("next_session_change")
    out(st.filter((F.col("op") == RESUME_OP) & (F.length("snap_session") > 0) & change.isNotNull())
          .select("install_id", F.col("snap_session").alias("session_id"), change["ts"].alias("ts"), change["op"].alias("ended_by")), "session_ends")
    found = links(real, saved)
    out(found.drop("winner"), "identity_links")
    store.save(batch_id, start, next_saved(st, saved, found), changed)
    store.expire()


def stream_sessions(spark: SparkSession, out_dir: str) -> DataFrame:
    """Sessions of all micro-batches: starts with the end that a later
    micro-batch found."""
    begun = spark.read.parquet(f"{out_dir}/session_starts").drop("batch_id")
    later = spark.read.parquet(f"{out_dir}/session_ends").select("session_id", F.col("ts").alias("later_ts"), F.col("ended_by").alias("later_by"))
    s = begun.join(later, "session_id", "left")
    lost = F.col("later_by").isin(*PROCESS_OPS)
    ends = F.col("later_ts").isNotNull() & ~lost
    return s.select("install_id", "session_id", "actor_id", "started_ts",
                    F.coalesce("ended_ts", F.when(ends, F.col("later_ts"))).alias("ended_ts"),
                    F.coalesce("ended_by", F.when(ends, F.col("later_by"))).alias("ended_by"),
                    F.coalesce("end_reason", F.when(ends, F.lit("normal"))).alias("end_reason"),
                    F.coalesce("lost_ts", F.when(lost, F.col("later_ts"))).alias("lost_ts"))


def stateful_stream(calls_stream: DataFrame, app_config: DataFrame, state_dir: str, out_dir: str,
                    checkpoint: str, initial_consent: DataFrame | None = None, **trigger):
    """Start the stateful stream; ``trigger`` as for ``DataStreamWriter``."""
    w = (calls_stream.writeStream
         .foreachBatch(lambda df, bid: process_batch(df, bid, app_config, state_dir, out_dir, initial_consent))
         .option("checkpointLocation", checkpoint))
    if trigger:
        w = w.trigger(**trigger)
    return w.start()
