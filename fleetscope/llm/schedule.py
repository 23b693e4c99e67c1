"""Mixing sources to target weights by a low-discrepancy schedule.

Every source's documents are shuffled (by a keyed hash) onto a tape of words,
cut into blocks of equal word count. A schedule of slots says which source
gives its next block: slot n takes the golden-ratio point ``frac(n * phi)``
and the source whose interval of the cumulative weights holds the point, so
every stretch of the schedule is close to the weights. Slots are ranked per
source; rank r takes block ``r mod blocks`` in pass ``r div blocks``. A
source stops when it has given its target: its last slot is trimmed to the
word. The few slots that a source misses against its share (logarithmic in
the schedule's length) follow at the end.

DataFrame operations only. No step gathers a source: places on a tape and
ranks of slots are two-level prefix sums (inside hash buckets or stretches of
the schedule, then over one row per bucket and source). One row per source
meets in one task for the targets.

Targets: the sources, by code point with null last, weigh 5, 2, 1, repeating,
and share 150% of all words. No target exceeds twice its source's size; what
lies above is shared again by weight until none is above (the level at which
that ends is found by a running sum over sources in order of size / weight).

Defined cases: a null source is a source of its own; a null or empty text has
size 0 and is never taken; rows alike in id and text are interchangeable;
ids may be null or repeat; without any words all targets are 0; an empty table
gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetscope.llm.common import WORD, staged

WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2
BLOCK_WORDS = 1024
STRETCH = 4096            # slots ranked together
CELLS = 1024              # equal parts of [0, 1) that points are matched by, for as many sources at most
GOLDEN = 0.6180339887498949


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def shuffle_key(seed: str = "mix") -> Column:
    """Keyed hash of id and text that orders a source's tape."""
    ident = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.md5(F.concat(F.lit(seed + "-"), ident, F.lit("-"), F.md5(F.coalesce("text", F.lit("")).cast("binary"))).cast("binary"))


def sized(docs: DataFrame, seed: str = "mix") -> DataFrame:
    """(doc_id, source, size, k, bucket): the narrow table all else uses."""
    return docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), shuffle_key(seed).alias("k")).withColumn(
        "bucket", F.substring("k", 1, 3))


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """(sid, source, source_size, target) per source."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("sid") % len(weights) + 1).cast("int"))
    rows = totals.withColumn("sid", (F.row_number().over(by_name) - 1).cast("long")).withColumn("weight", w)
    # In order of cap / weight, the first source whose level (what is left,
    # per weight left) does not exceed its cap / weight sets the level.
    by_ratio = Window.orderBy((most * F.col("source_size") / F.col("weight")), "sid")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    everywhere = Window.partitionBy(F.lit(0))
    cap = (most * F.col("source_size")).cast("double")
    rows = (rows.withColumn("goal", share * F.sum("source_size").over(everywhere))
            .withColumn("cap", cap)
            .withColumn("capped_before", F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
            .withColumn("weight_left", F.sum("weight").over(everywhere) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
            .withColumn("level", (F.col("goal") - F.col("capped_before")) / F.col("weight_left")))
    ratio = F.col("cap") / F.col("weight")
    holds = F.when(F.col("level") <= ratio, F.struct(ratio.alias("ratio"), "sid", "level"))
    level = F.min(holds).over(everywhere)["level"]
    return rows.withColumn("final", level).select(
        "sid", "source", "source_size", F.least("cap", F.col("weight") * F.coalesce("final", F.lit(0.0))).alias("target"))


def tapes(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Documents with their place: sid, pos (words before it on its source's
    tape), source_size and target."""
    near = (F.col("sizes.source").eqNullSafe(F.col("targets.source")))
    rows = (sizes.alias("sizes").join(targets.alias("targets"), near)
            .select("doc_id", F.col("sizes.source").alias("source"), "size", "k", "bucket", "sid", "source_size", "target"))
    inside = Window.partitionBy("sid", "bucket").orderBy("k", "size").rowsBetween(Window.unboundedPreceding, -1)
    sums = rows.groupBy("sid", "bucket").agg(F.sum("size").alias("total"))
    across = Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("sid", "bucket", F.coalesce(F.sum("total").over(across), F.lit(0)).alias("base"))
    return (rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0)))
            .join(sums, ["sid", "bucket"]).withColumn("pos", F.col("base") + F.col("inside")).drop("base", "inside"))


def slots(targets: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(slot, sid, pass, block, use): ``use`` words of the block are taken."""
    spark = targets.sparkSession
    size, goal = F.col("source_size"), F.round("target").cast("long")
    plan = (targets.filter("source_size > 0").withColumn("goal", F.least(goal, MOST * size))
            .withColumn("blocks", F.ceil(size / block_words)).withColumn("rest", F.col("goal") % size)
            .withColumn("need", F.floor(F.col("goal") / size) * F.col("blocks") + F.ceil(F.col("rest") / block_words))
            .filter("need > 0"))
    upto = Window.orderBy("sid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    plan = staged(plan.withColumn("high", F.sum("need").over(upto)).withColumn("all", F.sum("need").over(Window.partitionBy(F.lit(0))))
                  .select("sid", "blocks", "rest", "need", ((F.col("high") - F.col("need")) / F.col("all")).alias("lo"),
                          F.when(F.col("high") == F.col("all"), F.lit(1.0)).otherwise(F.col("high") / F.col("all")).alias("hi"), "all"), "slot-plan")
    total, sources = plan.agg(F.coalesce(F.max("all"), F.lit(0)).cast("long"), F.count(F.lit(1))).first()
    # No source is narrower than one part of the schedule's length, so with
    # that many cells a point meets at most three sources.
    parts = CELLS if sources <= CELLS else total
    cell = lambda x: F.least(F.floor(x * F.lit(float(parts))), F.lit(parts - 1))
    cells = plan.withColumn("cell", F.explode(F.sequence(cell(F.col("lo")), cell(F.col("hi")))))
    points = spark.range(int(total)).select(F.col("id").alias("slot"), ((F.col("id") + 0.5) * GOLDEN % 1.0).alias("u"))
    points = points.withColumn("cell", cell(F.col("u")))
    drawn = (points.join(cells, "cell").filter("u >= lo AND u < hi")
             .select("slot", "sid", F.floor(F.col("slot") / STRETCH).alias("stretch")))
    drawn = staged(drawn, "slots")
    counts = drawn.groupBy("stretch", "sid").agg(F.count(F.lit(1)).alias("n"))
    across = Window.partitionBy("sid").orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.withColumn("base", F.coalesce(F.sum("n").over(across), F.lit(0)))
    inside = Window.partitionBy("stretch", "sid").orderBy("slot")
    ranked = (drawn.withColumn("in_stretch", F.row_number().over(inside) - 1)
              .join(counts.select("stretch", "sid", "base"), ["stretch", "sid"])
              .select("slot", "sid", (F.col("base") + F.col("in_stretch")).alias("rank")))
    given = drawn.groupBy("sid").agg(F.count(F.lit(1)).alias("n"))
    late = (plan.join(given, "sid", "left").withColumn("n", F.coalesce("n", F.lit(0))).filter("n < need")
            .select("sid", F.explode(F.sequence(F.col("n"), F.col("need") - 1)).alias("rank"))
            .select((F.lit(int(total)) + F.row_number().over(Window.orderBy("rank", "sid")) - 1).alias("slot"), "sid", "rank"))
    last = (F.col("rank") == F.col("need") - 1) & (F.col("rest") > 0)
    use = F.when(last, F.col("rest") - F.floor((F.col("rest") - 1) / block_words) * block_words).otherwise(F.lit(block_words))
    return (ranked.unionByName(late).join(plan.select("sid", "blocks", "rest", "need"), "sid").filter("rank < need")
            .select("slot", "sid", F.floor(F.col("rank") / F.col("blocks")).alias("pass"), (F.col("rank") % F.col("blocks")).alias("block"),
                    use.cast("long").alias("use")))


def placements(tape: DataFrame, schedule: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix: one row per document part and slot that takes it, with
    (slot, pass, sid, pos, doc_id, word_from, words)."""
    first, final = F.floor(F.col("pos") / block_words), F.floor((F.col("pos") + F.col("size") - 1) / block_words)
    parts = (tape.filter("size > 0").withColumn("block", F.explode(F.sequence(first, final)))
             .withColumn("begin", F.greatest(F.col("pos"), F.col("block") * block_words))
             .withColumn("end", F.least(F.col("pos") + F.col("size"), (F.col("block") + 1) * block_words)))
    words = F.least(F.col("end"), F.col("block") * block_words + F.col("use")) - F.col("begin")
    return (parts.join(schedule, ["sid", "block"]).withColumn("words", words).filter("words > 0")
            .select("slot", "pass", "sid", "pos", "doc_id", (F.col("begin") - F.col("pos")).alias("word_from"), "words"))


def mix_report(docs: DataFrame, block_words: int = BLOCK_WORDS, seed: str = "mix") -> DataFrame:
    """Per document: doc_id, size, source_size, target, the words taken, how
    many slots of the schedule take from it and the first of them (null where
    none does), which orders the mix."""
    sizes = staged(sized(docs, seed), "sizes")
    targets = staged(source_targets(sizes), "targets")
    tape = staged(tapes(sizes, targets), "tapes")
    taken = (placements(tape, slots(targets, block_words), block_words)
             .groupBy("sid", "pos").agg(F.sum("words").alias("taken"), F.min("slot").alias("first_slot"), F.count(F.lit(1)).alias("n_slots")))
    # Documents without words share places; they get keys that match nothing.
    place = F.when(F.col("size") > 0, F.col("pos")).otherwise(-1 - F.pmod(F.xxhash64("k", "doc_id"), F.lit(1 << 40)))
    return (tape.withColumn("place", place).join(taken.withColumnRenamed("pos", "place"), ["sid", "place"], "left")
            .select("doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"),
                    F.col("first_slot").cast("long").alias("first_slot"), F.coalesce("n_slots", F.lit(0)).cast("long").alias("n_slots")))


def mixed_documents(docs: DataFrame, block_words: int = BLOCK_WORDS, seed: str = "mix") -> DataFrame:
    """``docs`` in the mix: every document as often as the schedule takes its
    first word (whole documents; documents without words once)."""
    sizes = staged(sized(docs, seed), "sizes")
    targets = staged(source_targets(sizes), "targets")
    tape = staged(tapes(sizes, targets), "tapes")
    copies = (placements(tape, slots(targets, block_words), block_words).filter("word_from = 0")
              .groupBy("sid", "pos").agg(F.count(F.lit(1)).alias("copies")))
    place = F.when(F.col("size") > 0, F.col("pos")).otherwise(-1 - F.pmod(F.xxhash64("k", "doc_id"), F.lit(1 << 40)))
    times = (tape.withColumn("place", place).join(copies.withColumnRenamed("pos", "place"), ["sid", "place"], "left")
             .groupBy("k").agg(F.sum(F.when(F.col("size") == 0, 1).otherwise(F.coalesce("copies", F.lit(0)))).alias("__times"),
                               F.count(F.lit(1)).alias("__rows")))
    times = staged(times.filter("__times > 0"), "times").withColumnRenamed("k", "__k")
    keyed = docs.withColumn("__k", shuffle_key(seed)).join(times, "__k")
    # Rows alike in id and text count as one row that is taken for all.
    single, alike = keyed.filter("__rows = 1"), keyed.filter("__rows > 1").dropDuplicates(["__k"])
    return (single.unionByName(alike).withColumn("__copy", F.explode(F.array_repeat(F.lit(1), F.col("__times").cast("int"))))
            .select(*[F.col(f"`{c}`") for c in docs.columns]))
