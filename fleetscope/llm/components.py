"""Connected components of a link table, as Spark jobs.

Alternates two rewrites until nothing changes: every node's larger
neighbours are linked to its smallest neighbour ("large star"), then its
smaller ones are ("small star"). Both are an aggregate with partial sums and
an equi-join; the links shrink to stars around the smallest id. The number of
rounds grows with the logarithm of the longest path. Each side of a join is
read from a checkpoint in the shared folder, so a hub's rows are split by
Spark's skew join, and lost executors recompute nothing from the start.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetscope.config import checkpoint_dir


def _rewrite(links: DataFrame, larger: bool) -> DataFrame:
    """One star step on links (a > b)."""
    if larger:
        both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        both = links
    low = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("k"), F.least("a", "m").alias("m")).checkpoint()
    j = both.join(low, both["a"] == low["k"])
    if larger:
        out = j.filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = j.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(low.select(F.col("k").alias("a"), F.col("m").alias("b")))
    return out.filter("a > b").distinct().checkpoint()


def _print(links: DataFrame) -> tuple:
    r = links.agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("a", "b")).alias("x")).first()
    return r["n"], r["x"]


def connected_components(links: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 100) -> DataFrame:
    """(node, component) for every node with a link to another node; the
    component is the smallest node id reachable. Ids are integers; links with
    a null end or equal ends are ignored; direction and repeats do not matter.
    """
    checkpoint_dir(links.sparkSession)
    x, y = F.col(a).cast("long"), F.col(b).cast("long")
    now = (links.select(F.greatest(x, y).alias("a"), F.least(x, y).alias("b"))
           .filter("a > b").distinct().checkpoint())
    seen = _print(now)
    for _ in range(max_rounds):
        if seen[0] == 0:
            break
        now = _rewrite(_rewrite(now, True), False)
        then, seen = seen, _print(now)
        if seen == then:
            break
    else:
        raise RuntimeError(f"no fixed point after {max_rounds} rounds")
    return (now.select(F.col("a").alias("node"), F.col("b").alias("component"))
            .unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()))
