"""Join of a large table with a dimension table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def join_small(big: DataFrame, small: DataFrame, on: Column | list[str] | str, how: str) -> DataFrame:
    """Join ``big`` with a dimension table, without a hint: Spark broadcasts
    the dimension when its size in bytes is below
    ``spark.sql.autoBroadcastJoinThreshold`` (by estimate, or as measured at
    run time), and otherwise shuffles and splits skewed keys."""
    return big.join(small, on, how)


def semi_join_counted(big: DataFrame, counted: DataFrame, keys: Sequence[str], wanted: Column, spread: Sequence[str],
                      target_rows: int) -> DataFrame:
    """Rows of ``big`` whose ``keys`` (nulls equal nulls) are among the rows of
    ``counted`` that are ``wanted``. ``counted(keys..., n)`` holds every key of
    ``big`` and how many rows have it.

    A small ``counted`` is broadcast and ``big`` does not move. Otherwise rows
    meet on the keys and a salt: a key of ``n`` rows has
    ``ceil(n / target_rows)`` salts, drawn from a hash of ``spread`` (columns
    that tell its rows apart), so no task gets more than about
    ``target_rows`` rows of one key. Keys of several salts number at most
    rows / ``target_rows``.
    """
    salts = F.ceil(F.col("n") / F.lit(target_rows)).cast("int")
    hot = counted.filter(F.col("n") > target_rows).select(*[F.col(k).alias(f"__h_{k}") for k in keys], salts.alias("__salts"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"__h_{k}"))
    salted = join_small(big, hot, same, "left").drop(*[f"__h_{k}" for k in keys])
    salted = salted.withColumn("__salt", F.when(F.col("__salts").isNull(), F.lit(0)).otherwise(
        F.pmod(F.xxhash64(*spread), F.col("__salts")).cast("int"))).drop("__salts")
    right = counted.filter(wanted).select(*[F.col(k).alias(f"__w_{k}") for k in keys],
                                          F.explode(F.sequence(F.lit(0), salts - 1)).alias("__w_salt"))
    on = F.col("__salt") == F.col("__w_salt")
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"__w_{k}"))
    return salted.join(right, on, "left_semi").drop("__salt")
