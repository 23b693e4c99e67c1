"""Two-stage allowlist under skew, and the mergeable lag sketch."""

import datetime as dt
import random

from pyspark.sql import functions as F

from fleetscope.operators import events as evm
from fleetscope.operators import queue as qm

DAY0 = dt.datetime(2024, 3, 1)


def test_allowlist_with_a_hot_triple_and_nulls(spark):
    rng = random.Random(1)
    triples = [("a", "ui", "open"), ("a", "ui", "shut"), ("b", None, "open"), (None, "ui", "open"), ("b", "", "x"), ("c", "z", "z")]
    rows = [(i, DAY0, i, *(triples[0] if i % 3 else rng.choice(triples))) for i in range(3000)]
    ev = spark.createDataFrame(rows, "install_id long, ts timestamp_ntz, seq long, source_app string, category string, name string")
    defs = spark.createDataFrame([("a", "ui", "open"), ("a", "ui", "open"), ("b", "", "x"), ("d", "q", "q"), (None, "ui", "open")], "source_app string, category string, name string")
    wide = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    declared = sorted(r[0] for r in rows if r[3:] == triples[0])
    try:
        for limit in (wide, "-1"):                                     # broadcast, then salted shuffle
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            good, bad, unused = evm.check_allowlist(ev, defs, target_rows=100)
            assert sorted(r.seq for r in good.collect()) == declared
            assert sorted(r.seq for r in bad.collect()) == sorted(set(range(3000)) - set(declared))
            assert [tuple(r) for r in unused.filter("source_app IS NOT NULL").collect()] == [("d", "q", "q")]
            assert good.columns == ev.columns
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", wide)


def test_hot_triple_is_spread(spark):
    """With many triples the rows of a hot one meet under many salts."""
    ev = spark.range(20_000).select(F.col("id").alias("install_id"), F.lit(DAY0).alias("ts"), F.col("id").alias("seq"), F.lit("a").alias("source_app"),
                                    F.lit("ui").alias("category"), F.when(F.col("id") < 18_000, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("name"))
    defs = spark.createDataFrame([("a", "ui", "hot")], "source_app string, category string, name string")
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    was = [spark.conf.get(k) for k in keys]
    try:
        for k, v in zip(keys, ("-1", "false")):
            spark.conf.set(k, v)
        good, _, _ = evm.check_allowlist(ev, defs, target_rows=500)
        parts = [r["count"] for r in good.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(parts) == 18_000 and len(parts) >= 6 and max(parts) <= 6_000, parts
        plan = good._jdf.queryExecution().executedPlan().toString()
        assert "__salt" in plan
    finally:
        for k, v in zip(keys, was):
            spark.conf.set(k, v)


def lag_queue(spark, lags):
    rows = [(i % 3, DAY0 + dt.timedelta(hours=i % 60), ms) for i, ms in enumerate(lags)]
    q = spark.createDataFrame(rows, "source_app long, at timestamp_ntz, ms long")
    stamp = F.date_format("at", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    queued = F.col("at") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), (F.col("ms") / 1000).cast("decimal(18,6)"))
    return q.select("source_app", F.concat(F.lit('{"timestamp":"'), stamp, F.lit('"}')).alias("payload_json"), queued.alias("queued_at"), F.lit(0).alias("id"))


def test_lag_sketch_error_merge_and_delay(spark):
    rng = random.Random(4)
    lags = [int(10 ** rng.uniform(0, 8)) for _ in range(900)] + [0, 1, 127, 128, 129] + [-5, -70_000, -1]
    q = lag_queue(spark, lags)
    whole = qm.lag_sketch(q)
    merged = qm.merge_sketches(qm.lag_sketch(q.filter("hour(queued_at) < 7")), qm.lag_sketch(q.filter("hour(queued_at) >= 7")))
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, merged.collect()))
    for r in qm.sketch_quantiles(merged, [50, 99, 100]).collect():
        own = sorted(ms for i, ms in enumerate(lags) if i % 3 == r.source_app)
        assert r.n == len(own)
        for p in (50, 99, 100):
            true = own[-(-len(own) * p // 100) - 1]
            assert abs(true) * 63 / 64 - 1 <= abs(r[f"p{p}_lag_ms"]) <= abs(true), (p, true)
    seconds = int(qm.delay_from_sketch(merged).split()[0])
    spread = (max(lags) - min(lags)) / 1000
    assert spread <= seconds <= spread * 1.04 + 65
    assert qm.delay_from_sketch(whole.limit(0)) == "60 seconds"
    bad = q.withColumn("payload_json", F.lit("{}"))
    assert qm.lag_sketch(bad).collect() == []
