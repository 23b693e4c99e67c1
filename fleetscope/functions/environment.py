"""Environment dimension expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# RAM bucket labels and their lower bounds in MB.
RAM_BUCKETS = [(2048, "< 2 GB"), (4096, "2-4 GB"), (8192, "4-8 GB"),
               (16384, "8-16 GB"), (32768, "16-32 GB")]
RAM_BUCKET_TOP = "> 32 GB"


def ram_bucket(total_mb) -> Column:
    """Coarse RAM bucket; each lower bound is inclusive."""
    m = _c(total_mb)
    expr = None
    for upper, label in RAM_BUCKETS:
        expr = F.when(m < upper, F.lit(label)) if expr is None else expr.when(m < upper, F.lit(label))
    return F.when(m.isNull(), F.lit(None)).otherwise(expr.otherwise(F.lit(RAM_BUCKET_TOP)))


def pseudonymize(col) -> Column:
    """Lower-hex SHA-256 of a value (machine names are never kept raw)."""
    return F.sha2(_c(col).cast("string"), 256)
