"""Durable queue and memory queue operators.

Queue positions are running counts per install in id (or call) order,
computed with the skew-safe ordered scan; per-install totals are partial
aggregates joined back on the install.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetscope import config as C
from fleetscope.functions.core import epoch_micros, iso_millis, uuid7_from_key
from fleetscope.operators.scan import Scan, cut_slices, ordered_scan


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def read_oldest(queue: DataFrame, n: int, key: str = "install_id", order: str = "id") -> DataFrame:
    """The first ``n`` rows by id of each install's queue.

    ``row_number() <= n`` is planned as a window group limit: every map
    task keeps at most ``n`` rows per install before the shuffle, so a hot
    install ships only ``n`` rows per task.
    """
    w = Window.partitionBy(key).orderBy(order)
    return queue.withColumn("rn", F.row_number().over(w)).filter(F.col("rn") <= n).drop("rn")


def ack_delivered(queue: DataFrame, acked: DataFrame, key: str = "install_id") -> DataFrame:
    """Remove delivered or discarded rows (anti join on install and id)."""
    return queue.join(acked.select(key, "id"), [key, "id"], "left_anti")


def delivery_order(durable: DataFrame, memory: DataFrame, key: str = "install_id",
                   target_rows: int = C.DEFAULT_TARGET_ROWS) -> DataFrame:
    """Priority order per install: durable rows before memory rows. (The
    client interleaves: each wake sends one durable batch, then memory.)

    Both inputs carry ``(install_id, ts, seq)``; the position is the
    running count over ``(origin_rank, ts, seq)``, by a scan whose slices are
    cut at quantiles of that order.
    """
    d = durable.select(key, "ts", "seq").withColumn("origin", F.lit("durable"))
    m = memory.select(key, "ts", "seq").withColumn("origin", F.lit("memory"))
    u = d.unionByName(m).withColumn("origin_rank", F.when(F.col("origin") == "durable", 0).otherwise(1))
    order = ["origin_rank", "ts", "seq"]
    u = cut_slices(u, key, order, F.col("origin_rank").cast("long"), target_rows)
    u = ordered_scan(u, key, order, [Scan("delivery_pos", "sum_incl", F.lit(1))])
    return u.select(key, "origin", "ts", "seq", F.col("delivery_pos").cast("long").alias("delivery_pos"))


def cap_queue(queue: DataFrame, max_bytes, key: str = "install_id", target_rows: int = C.DEFAULT_TARGET_ROWS,
              size: str | None = None) -> DataFrame:
    """Enforce a byte cap on each install's durable queue.

    When the queue holds ``max_bytes`` or more, the oldest rows go in
    blocks of 100 until what remains is below the cap. Size = payload
    bytes, or the column ``size`` where it is known. ``max_bytes`` is an int
    or a column of the queue rows.
    """
    q = queue.withColumn("bytes", F.col(size) if size else F.octet_length("payload_json").cast("long"))
    q = q.withColumn("__cap", _c(max_bytes) if not isinstance(max_bytes, int) else F.lit(max_bytes).cast("long"))
    q = _positions_by_id(q, key, target_rows)
    # What holds for a whole queue is summed up from its slices and joined back
    # on them: joined on the key, a hot install would be one task's.
    whole, part = Window.partitionBy(key), [key, "__part"]
    totals = q.groupBy(*part).agg(F.sum("bytes").alias("__b"), F.count(F.lit(1)).alias("__n"), F.max("__cap").alias("__m"))
    totals = totals.select(*part, F.sum("__b").over(whole).alias("__total"), F.sum("__n").over(whole).alias("__cnt"),
                           F.max("__m").over(whole).alias("__most"))
    q = q.join(totals, part, "left")
    block_end = (F.col("rn") % C.EVICTION_BLOCK_ROWS == 0) | (F.col("rn") == F.col("__cnt"))
    cut_ok = block_end & ((F.col("__total") - F.col("prefix")) < F.col("__most"))
    cuts = q.groupBy(*part).agg(F.min(F.when(cut_ok, F.col("rn"))).alias("__c"))
    cuts = cuts.select(*part, F.min("__c").over(whole).alias("__cut"))
    q = q.join(cuts, part, "left")
    cut = F.when(F.col("__total") < F.col("__most"), F.lit(0)).otherwise(F.coalesce(F.col("__cut"), F.col("__cnt")))
    kept = [key, *[c for c in q.columns if c not in (key, "__part", "__cap", "__total", "__cnt", "__most", "__cut")]]
    return q.withColumn("evicted", F.col("rn") <= cut).select(*kept, "evicted")


def _positions_by_id(q: DataFrame, key: str, target_rows: int) -> DataFrame:
    """Row number and byte prefix in id order, and the slice (``__part``). Slices are cut at quantiles of
    the ids, so sparse, hashed or time-based ids split as evenly as dense ones."""
    q = cut_slices(q, key, ["id"], None, target_rows, "__part")
    q = ordered_scan(q, key, ["id"], [Scan("rn", "sum_incl", F.lit(1)),
                                      Scan("prefix", "sum_incl", F.col("bytes"))], slice_col="__part")
    return q.withColumn("rn", F.col("rn").cast("long")).withColumn("prefix", F.col("prefix").cast("long"))


def form_batches(rows: DataFrame, max_batch, order: str = "id", key: str = "install_id",
                 payload: str = "payload_json", target_rows: int = C.DEFAULT_TARGET_ROWS) -> DataFrame:
    """FIFO batches of at most ``max_batch`` rows per install, each one JSON
    array body. A batch holds at most 1000 small strings (bounded group)."""
    q = rows.withColumn("__b", _c(max_batch) if not isinstance(max_batch, int) else F.lit(max_batch))
    q = cut_slices(q, key, [order], None, target_rows, "__part")
    q = ordered_scan(q, key, [order], [Scan("rn", "sum_incl", F.lit(1))], slice_col="__part")
    q = q.withColumn("batch_no", F.floor((F.col("rn") - 1) / F.col("__b")).cast("long"))
    g = q.groupBy(key, "batch_no").agg(
        F.array_sort(F.collect_list(F.struct(F.col(order).alias("o"), F.col(payload).alias("p")))).alias("items"))
    return g.select(key, "batch_no", F.size("items").cast("long").alias("n_events"),
                    F.element_at("items", 1)["o"].alias("first_id"),
                    F.concat(F.lit("["), F.array_join(F.transform("items", lambda x: x["p"]), ","), F.lit("]")).alias("body"))


def queue_depth(queue: DataFrame, key: str = "install_id") -> DataFrame:
    """Pending rows and payload bytes per install."""
    return queue.groupBy(key).agg(F.count(F.lit(1)).alias("n_pending"),
                                  F.sum(F.octet_length("payload_json")).cast("long").alias("bytes"))


def _lag_seconds() -> Column:
    """Seconds from the payload's event time to the spill; null where the
    time is missing or malformed."""
    ts = F.get_json_object("payload_json", "$.timestamp").try_cast("timestamp_ntz")
    return (epoch_micros("queued_at") - epoch_micros(ts)) / F.lit(1_000_000)


def delivery_lag(queue: DataFrame, key: str = "source_app") -> DataFrame:
    """Spill delay (queued_at minus event time) per key: count, rows without
    a readable time, min, max and approximate 99th percentile in seconds;
    sizes the watermark of the streaming consumers."""
    lag = _lag_seconds()
    return (queue.withColumn("lag_s", lag)
                 .groupBy(key).agg(F.count("lag_s").alias("n"), F.count_if(F.col("lag_s").isNull()).alias("n_bad"),
                                   F.min("lag_s").alias("min_lag_s"),
                                   F.max("lag_s").alias("max_lag_s"),
                                   F.percentile_approx("lag_s", 0.99).alias("p99_lag_s")))


# Bits of a lag that its bucket keeps: quantiles are low by at most 1/64.
LAG_BITS = 7


def lag_sketch(queue: DataFrame, key: str = "source_app") -> DataFrame:
    """Mergeable sketch of the spill delay: (key, day, low, width, n), the
    rows of each spill day whose delay in milliseconds lies in a bucket.

    A bucket keeps the leading 7 bits of the delay, so its width is at most
    1/64 of it and a key has some thousand buckets however many rows. Sketches
    of different runs unite by ``merge_sketches``. Rows without a readable time
    are left out (``delivery_lag`` counts them).
    """
    ms = F.floor(_lag_seconds() * 1000).cast("long")
    d = queue.select(key, F.to_date("queued_at").alias("day"), ms.alias("ms")).filter("ms IS NOT NULL")
    drop = F.greatest(F.length(F.bin(F.abs("ms"))) - LAG_BITS, F.lit(0))
    d = d.withColumn("width", F.pow(F.lit(2.0), drop).cast("long"))
    low = F.signum("ms").cast("long") * (F.abs("ms") - F.abs("ms") % F.col("width"))
    return d.groupBy(key, "day", low.alias("low"), "width").agg(F.count(F.lit(1)).alias("n"))


def merge_sketches(*sketches: DataFrame) -> DataFrame:
    """One sketch of all rows (a partial aggregate)."""
    u = sketches[0]
    for s in sketches[1:]:
        u = u.unionByName(s)
    return u.groupBy(*[c for c in u.columns if c != "n"]).agg(F.sum("n").alias("n"))


def sketch_quantiles(sketch: DataFrame, percents: list[int], key: str = "source_app") -> DataFrame:
    """Per key: rows and, for each percent, the delay in milliseconds that at
    least so many percent of the rows do not exceed, as its bucket's edge
    nearest zero: at most 1/64 below the true delay in size. The window runs
    over a key's buckets, whose number is bounded."""
    b = sketch.groupBy(key, "low").agg(F.sum("n").alias("n"))
    w = Window.partitionBy(key).orderBy("low")
    b = b.withColumn("upto", F.sum("n").over(w)).withColumn("all", F.sum("n").over(Window.partitionBy(key)))
    cuts = [F.min(F.when(F.col("upto") * 100 >= F.lit(p) * F.col("all"), F.col("low"))).alias(f"p{p}_lag_ms") for p in percents]
    return b.groupBy(key).agg(F.sum("n").cast("long").alias("n"), *cuts)


def delay_from_sketch(sketch: DataFrame, percent: int = 100, floor_seconds: int = 60) -> str:
    """Watermark delay of a stream whose rows arrive in spill order: the
    spread between the earliest delay (below zero where clocks ran ahead) and
    the given percentile over all keys, rounded up to the bucket's far edge.
    At 100 no measured row would have come late. One row reaches the driver."""
    whole = sketch.groupBy(F.lit("all").alias("key"), "low", "width").agg(F.sum("n").alias("n"))
    first = whole.agg(F.min(F.col("low") - F.col("width")).alias("x"), F.max("width").alias("w")).first()
    if first["x"] is None:
        return f"{floor_seconds} seconds"
    high = sketch_quantiles(whole, [percent], "key").first()[f"p{percent}_lag_ms"]
    seconds = -((min(first["x"], 0) - high - max(first["w"], 1)) // 1000)
    return f"{max(int(seconds) + 1, floor_seconds)} seconds"


def watermark_delay(queue: DataFrame, quantile: float = 0.99, floor_seconds: int = 60) -> str:
    """Watermark delay for the streaming consumers from the measured spill
    delay: the given quantile over all rows (one approximate-percentile
    aggregate, a single row to the driver), at least ``floor_seconds``."""
    lag = _lag_seconds()
    q = queue.select(F.percentile_approx(lag, quantile).alias("q")).first()["q"]
    return f"{max(int(q or 0) + 1, floor_seconds)} seconds"


def spill_rows(events: DataFrame) -> DataFrame:
    """Durable-queue rows from event payloads: event id from the JSON (a new
    id when missing), one spill time per batch, retry count 0."""
    eid = F.coalesce(F.get_json_object("payload_json", "$.event_id"),
                     uuid7_from_key(F.col("queued_at"), F.col("install_id"), F.col("id"), F.lit("spill")))
    return events.select("install_id", "id", eid.alias("event_id"), "payload_json",
                         iso_millis("queued_at").alias("queued_at"), F.lit(0).alias("retry_count"))
