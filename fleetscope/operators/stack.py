"""Stack trace text -> frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetscope import config as C

# The frame line forms of the platforms.
# Windows: ``[i] symbol (file:line)``; the file part is optional.
FRAME_PATTERN = r"^\[(\d+)\] (.*?)(?: \((.+):(\d+)\))?$"
# Linux: ``module(symbol+0xoffset) [0xaddress]``; symbol or bracket may be empty.
LINUX_PATTERN = r"^(.+?)(?:\(([^()+]*)(?:\+(0x[0-9a-fA-F]+))?\))? ?\[(0x[0-9a-fA-F]+)\]$"
# macOS: ``i   module   0xaddress symbol + offset``.
MAC_PATTERN = r"^(\d+)\s+(\S.*?)\s+(0x[0-9a-fA-F]+) (.+?) \+ (\d+)$"


def stack_frames(reports: DataFrame, key: list[str], col: str = "stack_trace") -> DataFrame:
    """One row per frame line of each (capped) trace: position, frame index,
    symbol, file, line, module, address and offset (as written). Linux lines
    carry no index. Unparsable lines keep ``raw`` only, and numbers too large
    for an integer become null."""
    t = reports.select(*key, F.left(F.col(col), F.lit(C.MAX_STACK_LEN)).alias("__t"))
    e = t.select(*key, F.posexplode(F.split(F.col("__t"), "\n")).alias("pos", "raw")).filter(F.length("raw") > 0)
    # Each line is matched once per form that it may still have. A line holds no
    # line feed, so the groups are set apart by it: no feed, no match.
    def groups(pattern: str, n: int):
        return F.split(F.regexp_replace("raw", F.lit(pattern), F.lit("".join(f"\n${i}" for i in range(1, n + 1)) + "\n")), "\n")

    e = e.withColumn("__win", groups(FRAME_PATTERN, 4))
    e = e.withColumn("__mac", F.when(F.size("__win") == 1, groups(MAC_PATTERN, 5)))
    e = e.withColumn("__lin", F.when(F.size("__mac") == 1, groups(LINUX_PATTERN, 4)))

    def pick(w: int | None, m: int | None, x: int | None):
        found = [F.nullif(F.get(c, F.lit(i)), F.lit("")) for c, i in (("__win", w), ("__mac", m), ("__lin", x)) if i]
        return F.coalesce(*found)

    # A Windows symbol may be empty text; the other forms give null instead.
    symbol = F.coalesce(F.get("__win", F.lit(2)), pick(None, 4, 2))
    return e.select(*key, F.col("pos").cast("long").alias("pos"), "raw", pick(1, 1, None).try_cast("int").alias("frame_index"), symbol.alias("symbol"),
                    pick(3, None, None).alias("file"), pick(4, None, None).try_cast("int").alias("line"),
                    pick(None, 2, 1).alias("module"), pick(None, 3, 4).alias("address"), pick(None, 5, 3).alias("offset"))


def top_frames(frames: DataFrame) -> DataFrame:
    """How often each symbol is the top frame: index 0, or the first line
    where lines carry no index."""
    first = F.col("frame_index").isNull() & F.col("module").isNotNull() & (F.col("pos") == 0)
    return (frames.filter((F.col("frame_index") == 0) | first)
                  .groupBy("symbol").agg(F.count(F.lit(1)).alias("n")))
