"""Environment headers: decode, dimension, RAM buckets, machine hashes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetscope.functions.environment import pseudonymize, ram_bucket

ENV_SCHEMA = T.StructType([
    T.StructField("cpu_core_count", T.IntegerType()),
    T.StructField("display_height", T.IntegerType()),
    T.StructField("display_width", T.IntegerType()),
    T.StructField("locale", T.StringType()),
    T.StructField("machine_name_hash", T.StringType()),
    T.StructField("os_architecture", T.StringType()),
    T.StructField("os_name", T.StringType()),
    T.StructField("os_version", T.StringType()),
    T.StructField("runtime_name", T.StringType()),
    T.StructField("runtime_version", T.StringType()),
    T.StructField("total_ram_mb", T.LongType()),
    T.StructField("total_ram_mb_bucket", T.StringType()),
])


def decode_environment(headers: DataFrame, col: str = "env_header") -> DataFrame:
    """Base64 JSON header -> environment struct ``env`` plus ``env_valid``.

    Undecodable base64 or JSON give ``env_valid = false`` instead of an
    error; a header without ``os_name`` counts as invalid.
    """
    raw = F.try_to_binary(F.col(col), F.lit("base64"))
    env = F.from_json(raw.cast("string"), ENV_SCHEMA)
    out = headers.withColumn("env", env)
    bucket = F.coalesce(F.col("env.total_ram_mb_bucket"), ram_bucket(F.col("env.total_ram_mb")))
    out = out.withColumn("env", F.col("env").withField("total_ram_mb_bucket", bucket))
    return out.withColumn("env_valid", raw.isNotNull() & F.col("env.os_name").isNotNull())


def environment_dim(headers: DataFrame) -> DataFrame:
    """One environment per install: the latest valid header wins (a
    partial aggregate of ``max(struct(reported_at, env))``)."""
    d = decode_environment(headers).filter("env_valid")
    g = d.groupBy("install_id").agg(F.max(F.struct("reported_at", "env")).alias("m"),
                                    F.count(F.lit(1)).alias("n_headers"))
    return g.select("install_id", F.col("m.reported_at").alias("reported_at"), "n_headers", "m.env.*")


def ram_bucket_counts(env_dim: DataFrame) -> DataFrame:
    return env_dim.groupBy("total_ram_mb_bucket", "os_name").agg(F.count(F.lit(1)).alias("n_installs"))


def machine_hashes(hosts: DataFrame, col: str = "host") -> DataFrame:
    """Replace raw machine names by their SHA-256 hex."""
    return hosts.withColumn("machine_name_hash", pseudonymize(col)).drop(col)
