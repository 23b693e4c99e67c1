"""App configuration: normalisation and attachment to the call log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetscope import config as C
from fleetscope.operators.joins import join_small


def _clamp(col: str, default: int, lo: int, hi: int):
    return F.greatest(F.lit(lo), F.least(F.lit(hi), F.coalesce(F.col(col), F.lit(default)))).cast("int")


def normalize_app_config(cfg: DataFrame) -> DataFrame:
    """Validate and clean app options; invalid options disable, never fail.

    Required: api key, an ``http://``/``https://`` base URL, app name and
    version. Trailing ``/`` are stripped, name/version truncated, numeric
    options clamped to their ranges. ``invalid_fields`` lists what failed.
    Of several rows of one app the highest version counts: by its numbers in
    order (1.10 is above 1.9), then its text, then the highest api key. So a
    join can never multiply calls.
    """
    version = F.coalesce("app_version", F.lit(""))
    numbers = F.transform(F.regexp_extract_all(version, F.lit(r"(\d+)"), F.lit(1)), lambda d: F.lpad(d, C.MAX_APP_VERSION_LEN, "0"))
    rank = F.struct(numbers, version, F.coalesce("api_key", F.lit("")))
    cfg = (cfg.groupBy("app_name").agg(F.max_by(F.struct(*[c for c in cfg.columns if c != "app_name"]), rank).alias("c"))
              .select("app_name", "c.*"))
    url = F.coalesce(F.col("api_base_url"), F.lit(""))
    bad = F.array_compact(F.array(
        F.when(F.coalesce(F.length("api_key"), F.lit(0)) == 0, F.lit("api_key")),
        F.when(~(url.startswith("http://") | url.startswith("https://")), F.lit("api_base_url")),
        F.when(F.coalesce(F.length("app_name"), F.lit(0)) == 0, F.lit("app_name")),
        F.when(F.coalesce(F.length("app_version"), F.lit(0)) == 0, F.lit("app_version")),
    ))
    return cfg.select(
        F.col("app_name").alias("app_key"),
        F.left(F.col("app_name"), F.lit(C.MAX_APP_NAME_LEN)).alias("app_name"),
        F.left(F.col("app_version"), F.lit(C.MAX_APP_VERSION_LEN)).alias("app_version"),
        F.regexp_replace(url, "/+$", "").alias("api_base_url"),
        (F.coalesce(F.col("enabled"), F.lit(True)) & (F.size(bad) == 0)).alias("enabled"),
        F.array_join(bad, ",").alias("invalid_fields"),
        _clamp("flush_interval_seconds", C.FLUSH_INTERVAL_DEFAULT, C.FLUSH_INTERVAL_MIN, C.FLUSH_INTERVAL_MAX)
        .alias("flush_interval_seconds"),
        _clamp("max_batch_size", C.BATCH_SIZE_DEFAULT, C.BATCH_SIZE_MIN, C.BATCH_SIZE_MAX).alias("max_batch_size"),
        _clamp("max_queue_size_mb", C.QUEUE_MB_DEFAULT, C.QUEUE_MB_MIN, C.QUEUE_MB_MAX).alias("max_queue_size_mb"),
        _clamp("max_breadcrumbs", C.BREADCRUMBS_DEFAULT, C.BREADCRUMBS_MIN, C.BREADCRUMBS_MAX).alias("max_breadcrumbs"),
    )


def attach_app_config(calls: DataFrame, cfg: DataFrame) -> DataFrame:
    """Give every call its app's normalised limits (left join on app name).

    An app without a config row was never configured: its tracker is
    disabled (the default limits are filled in but not used).

    The normalised configs are written once: few apps have all calls, and
    Spark splits such keys of a shuffled join only where both sides come
    straight from an exchange, not from the aggregate that makes the configs.
    """
    from fleetscope.plans.stage import stage
    n = stage(normalize_app_config(cfg), "app-config")
    j = join_small(calls, n, calls["source_app"] == n["app_key"], "left")
    return j.select(
        *[calls[c] for c in calls.columns if c != "source_app"],
        F.coalesce(n["app_name"], F.left(calls["source_app"], F.lit(C.MAX_APP_NAME_LEN))).alias("source_app"),
        n["app_version"].alias("source_version"),
        F.coalesce(n["enabled"], F.lit(False)).alias("enabled"),
        F.coalesce(n["flush_interval_seconds"], F.lit(C.FLUSH_INTERVAL_DEFAULT)).alias("flush_interval_seconds"),
        F.coalesce(n["max_batch_size"], F.lit(C.BATCH_SIZE_DEFAULT)).alias("max_batch_size"),
        F.coalesce(n["max_queue_size_mb"], F.lit(C.QUEUE_MB_DEFAULT)).alias("max_queue_size_mb"),
        F.coalesce(n["max_breadcrumbs"], F.lit(C.BREADCRUMBS_DEFAULT)).alias("max_breadcrumbs"),
    )
