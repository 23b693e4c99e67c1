"""Materialise an intermediate result that several branches read.

Spark recomputes a DataFrame for every branch of a plan that uses it (a
join of two filters of the same state reruns its sort and windows twice).
Where a result fans out, it is written once as a parquet table under the
cluster's shared ``spark.checkpoint.dir`` and read back: lineage is cut,
reads are column-pruned, and a lost executor costs a re-read, not a
recomputation.

``staging`` bounds their life: tables staged inside it are removed at its
end, so a job leaves its outputs only. Results that read a staged table must
have been written by then.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from fleetscope.config import scratch_path

_open: ContextVar[list[str] | None] = ContextVar("staged_tables", default=None)


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a fresh table in the shared folder and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, f"stage-{name}-{uuid.uuid4().hex}")
    tables = _open.get()
    if tables is not None:
        tables.append(path)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


@contextmanager
def staging(spark: SparkSession) -> Iterator[list[str]]:
    """Remove the tables staged inside, also when the work fails. Scopes may
    be nested; each removes its own tables."""
    tables: list[str] = []
    before = _open.set(tables)
    try:
        yield tables
    finally:
        _open.reset(before)
        for table in tables:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
