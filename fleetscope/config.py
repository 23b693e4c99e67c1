"""Session construction, fixed limits and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# ---------------------------------------------------------------------------
# Fixed values. These must equal the tracked client's limits for results to
# match; they are stated here together, in natural order.
# ---------------------------------------------------------------------------
MAX_ACTOR_LEN = 512
MAX_CATEGORY_LEN = 128
MAX_NAME_LEN = 256
MAX_PROPERTIES = 20
MAX_PROPERTY_KEY_LEN = 64
MAX_PROPERTY_VALUE_LEN = 256
MAX_MESSAGE_LEN = 1000
MAX_STACK_LEN = 32768
MAX_APP_NAME_LEN = 128
MAX_APP_VERSION_LEN = 256
FLUSH_INTERVAL_DEFAULT, FLUSH_INTERVAL_MIN, FLUSH_INTERVAL_MAX = 60, 1, 3600
FIRST_FLUSH_MAX_SECONDS = 5
BATCH_SIZE_DEFAULT, BATCH_SIZE_MIN, BATCH_SIZE_MAX = 25, 1, 1000
QUEUE_MB_DEFAULT, QUEUE_MB_MIN, QUEUE_MB_MAX = 10, 1, 1000
BREADCRUMBS_DEFAULT, BREADCRUMBS_MIN, BREADCRUMBS_MAX = 25, 0, 200
EVICTION_BLOCK_ROWS = 100
MAX_RETRIES = 3
BACKOFF_BASE_MS = 1000
BACKOFF_CAP_MS = 60000
JITTER_FRACTION = 0.2
RETRY_AFTER_CAP_SECONDS = 300
SEVERITY_FATAL, SEVERITY_NON_FATAL = "fatal", "non_fatal"
END_REASON_NORMAL = "normal"
RESERVED_CATEGORY_PREFIX = "_"
PATH_UNSAFE_CHARS = '/\\:*?"<>|'
MANIFEST_SCHEMA_VERSION = "1"
ISO_MILLIS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'"

# Width of the time slices used by the skew-safe per-install scans, and the
# row count above which one install's slice is split further.
DEFAULT_SLICE_HOURS = 24
DEFAULT_TARGET_ROWS = 500_000


def build_session(master: str | None = None, app_name: str = "fleetscope",
                  shuffle_partitions: int | None = None, **extra: str) -> SparkSession:
    """Build (or fetch) a session with the settings the operators assume.

    Settings only fill gaps: a cluster's own ``spark.checkpoint.dir`` and
    partition counts are respected. The UI is off (no server is opened).
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        # Broadcasts only below a checked size; AQE re-checks at runtime.
        "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra)
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session, as a URI.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as it is. Only a local master (one machine, so every folder is shared)
    may run without it: then a scratch folder is created and registered. Any
    other master without the setting is refused, because files written to an
    executor's own disk are not seen by the others.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        d = "file://" + tempfile.mkdtemp(prefix="fleetscope-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder for written tables."""
    return checkpoint_dir(spark).rstrip("/") + "/" + name
