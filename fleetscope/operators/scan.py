"""Skew-safe ordered scans per key (parallel prefix scan on Spark).

Per-install state (consent flag, current actor, session, device epoch, ...)
is a running "last value" or "running count" over the install's calls in
call order. A plain ``Window.partitionBy(install_id)`` would put one hot
install -- which may hold a third of all rows -- into a single task.

Instead every scan runs in two levels:

1. inside ``(key, slice)`` partitions, where ``slice`` is a time bucket, a
   window gives the value local to the slice, and one ``groupBy`` gives a
   one-row summary per slice (map-side partial aggregation);
2. a window over the small summary table (one row per key and slice)
   carries each slice's incoming value, which is joined back on
   ``(key, slice)`` -- the big side keeps its partitioning, only the summary
   moves, and AQE broadcasts it when its measured size is small.

A hot install is thereby spread over as many tasks as it has slices.

Scans that depend on a boolean *flag* which is itself a scan (here: "is
the install opted out before this call", which decides whether a call is
accepted) are evaluated inside the slice under both hypotheses for the
flag entering the slice; the carried flag then picks the right one. The
whole dependent chain therefore still needs one exchange, one sort and one
window pass.

Supported kinds (``x`` is any column expression, nulls are "no value"):

``last``      last non-null ``x`` strictly before the row
``last_incl`` last non-null ``x`` up to and including the row
``sum``       sum of ``x`` strictly before the row (0 when none)
``sum_incl``  sum of ``x`` up to and including the row
``first``     first non-null ``x`` of the key up to and including the row
``next``      first non-null ``x`` strictly after the row
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Callable, Union

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetscope import config as C
from fleetscope.functions.core import epoch_micros

KINDS = ("last", "last_incl", "sum", "sum_incl", "first", "next")

Expr = Union[Column, Callable[[Column], Column]]


@dataclass(frozen=True)
class Scan:
    """One scan. ``expr`` is a column, or a function of the flag column."""
    name: str
    kind: str
    expr: Expr

    @property
    def flagged(self) -> bool:
        return callable(self.expr) and not isinstance(self.expr, Column)


def time_slice(ts, hours: int = C.DEFAULT_SLICE_HOURS) -> Column:
    """Time bucket of ``hours`` width, time-zone independent."""
    return F.floor(epoch_micros(ts) / F.lit(3600 * 1_000_000 * hours)).cast("long")


# A slice's share of the sample: its size is met within a few percent.
SAMPLES_PER_SLICE = 256
# Cuts are kept in groups of this many, so a row is held against the groups'
# heads and then against one group.
CUTS_PER_GROUP = 256
# Slice id = base * SUB_SLICES + number of cuts at or before the row.
SUB_SLICES = 1 << 31


def order_cuts(df: DataFrame, key: str, order: Sequence[str], base: Column, target_rows: int) -> DataFrame:
    """(key, __base, __cut, __at): the places of the whole order key that cut
    each (key, base) bucket of more than ``target_rows`` rows into slices of
    about that many.

    The sketch is the set of rows whose hash of key and order falls in one of
    ``target_rows / 256`` classes. It needs no shuffle of the rows, sketches
    of parts of the data unite to that of the whole, and a rerun draws the
    same rows. Every 256th sampled row of a bucket, in order, is a cut, so
    slices hold equally many rows however the order key is spread: one
    timestamp with many sequence numbers, sparse ids and hashed ids included.
    For targets of at most 256 rows the sample is all rows and cuts are exact.
    Only sampled rows (about 1 in 2,000 at the default) are ranked.
    """
    classes = max(1, target_rows // SAMPLES_PER_SLICE)
    each = max(1, round(target_rows / classes))
    drawn = (df.filter(F.pmod(F.xxhash64(key, *order), F.lit(classes)) == 0)
               .select(key, base.alias("__base"), F.struct(*order).alias("__at")))
    rank = F.row_number().over(Window.partitionBy(key, "__base").orderBy("__at")) - 1
    return (drawn.withColumn("__rank", rank).filter((F.col("__rank") > 0) & (F.col("__rank") % each == 0))
                 .select(key, "__base", (F.col("__rank") / each - 1).cast("long").alias("__cut"), "__at"))


def _upto(cuts: str, at: Column) -> Column:
    """How many of the array's cuts lie at or before ``at``."""
    return F.size(F.filter(F.col(cuts), lambda c: c <= at))


def cut_slices(df: DataFrame, key: str, order: Sequence[str], base: Column | None = None,
               target_rows: int = C.DEFAULT_TARGET_ROWS, out: str = "slice") -> DataFrame:
    """Slices along ``order`` (a total order inside the key): one per
    ``base`` value, and buckets of more than about ``target_rows`` rows cut
    at quantiles of the order key (``order_cuts``).

    ``base`` is a long that never decreases along ``order``; none puts all
    rows of a key in one bucket. Slice ids never decrease along ``order``.
    The cuts (one per ``target_rows`` rows at most) are written once; they
    are joined as a dimension, in two steps, so no row meets more than the
    heads of its bucket's groups and the cuts of one group. Rows with a null
    key are never cut, and rows equal in key and order stay together.
    """
    from fleetscope.operators.joins import join_small
    from fleetscope.plans.stage import stage
    base = F.lit(0).cast("long") if base is None else base
    cuts = stage(order_cuts(df, key, order, base, target_rows), "cuts")
    d = df.withColumn("__base", base)
    first = F.col("__base") * F.lit(SUB_SLICES)
    if cuts.isEmpty():                 # no bucket outgrows a slice
        return d.withColumn(out, first).drop("__base")
    groups = (cuts.groupBy(key, "__base", F.floor(F.col("__cut") / CUTS_PER_GROUP).alias("__group"))
                  .agg(F.array_sort(F.collect_list("__at")).alias("__cuts")))
    heads = (cuts.filter(F.col("__cut") % CUTS_PER_GROUP == 0)
                 .groupBy(key, "__base").agg(F.array_sort(F.collect_list("__at")).alias("__heads")))
    at = F.struct(*order)
    j = join_small(d, heads, [key, "__base"], "left")
    j = j.withColumn("__group", F.when(F.col("__heads").isNotNull(), _upto("__heads", at) - 1).cast("long")).drop("__heads")
    j = join_small(j, groups, [key, "__base", "__group"], "left")
    sub = F.when(F.col("__cuts").isNull(), F.lit(0)).otherwise(F.col("__group") * CUTS_PER_GROUP + _upto("__cuts", at))
    j = j.withColumn(out, first + sub)
    return j.select(*[F.col(f"`{c}`") for c in df.columns], out)


def hot_aware_slice(df: DataFrame, key: str, ts: str, target_rows: int,
                    hours: int = C.DEFAULT_SLICE_HOURS, out: str = "slice", order: Sequence[str] | None = None) -> DataFrame:
    """Time buckets, those of more than about ``target_rows`` rows cut at
    quantiles of ``order`` (by default ``ts`` and ``seq``; it starts with
    ``ts``)."""
    return cut_slices(df, key, order or [ts, "seq"], time_slice(ts, hours), target_rows, out)


def slices(df: DataFrame, key: str = "install_id", ts: str = "ts",
           target_rows: int | None = C.DEFAULT_TARGET_ROWS, hours: int = C.DEFAULT_SLICE_HOURS,
           order: Sequence[str] | None = None) -> DataFrame:
    """Add the ``slice`` column every per-key scan uses: day buckets, with
    hot buckets split (``hot_aware_slice``) unless ``target_rows`` is None."""
    if target_rows:
        return hot_aware_slice(df, key, ts, target_rows, hours, order=order)
    return df.withColumn("slice", time_slice(ts, hours))


def _local(kind: str, x: Column, wl, t: str) -> Column:
    before = wl.rowsBetween(Window.unboundedPreceding, -1)
    upto = wl.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    if kind == "last":
        return F.last(x, ignorenulls=True).over(before)
    if kind == "last_incl":
        return F.last(x, ignorenulls=True).over(upto)
    if kind == "sum":
        return F.sum(x).over(before)
    if kind == "sum_incl":
        return F.sum(x).over(upto)
    if kind == "first":
        return F.first(x, ignorenulls=True).over(upto)
    if kind == "next":
        # lead ... IGNORE NULLS is one forward pass (no per-row re-scan,
        # unlike an unbounded-following frame).
        return F.expr(f"lead(`{t}`) IGNORE NULLS").over(wl)
    raise ValueError(f"unknown scan kind {kind!r}; expected one of {KINDS}")


def _summary(kind: str, x: Column, order: list[str]) -> Column:
    ordered = F.when(x.isNotNull(), F.struct(*[F.col(o) for o in order], x.alias("v")))
    if kind in ("last", "last_incl"):
        return F.max(ordered)["v"]
    if kind in ("sum", "sum_incl"):
        return F.sum(x)
    return F.min(ordered)["v"]  # first, next


def _carry(kind: str, v: Column, wc, name: str) -> Column:
    before = wc.rowsBetween(Window.unboundedPreceding, -1)
    if kind in ("last", "last_incl"):
        return F.last(v, ignorenulls=True).over(before)
    if kind in ("sum", "sum_incl"):
        return F.sum(v).over(before)
    if kind == "first":
        return F.first(v, ignorenulls=True).over(before)
    return F.expr(f"lead(`{name}`) IGNORE NULLS").over(wc)


def _combine(kind: str, lv: Column, cv: Column) -> Column:
    if kind in ("last", "last_incl", "next"):
        return F.coalesce(lv, cv)
    if kind in ("sum", "sum_incl"):
        return F.coalesce(lv, F.lit(0)) + F.coalesce(cv, F.lit(0))
    return F.coalesce(cv, lv)  # first: earlier slices win


def ordered_scan(df: DataFrame, key: str | list[str], order: list[str], scans: list[Scan],
                 slice_col: str = "slice", flag: Column | None = None,
                 flag_name: str = "flag_before", flag_initial: DataFrame | None = None) -> DataFrame:
    """Add one column per ``Scan`` (and ``flag_name`` when ``flag`` is given).

    ``df`` must carry ``slice_col``; ``order`` must be a total order inside a
    key along which the slice never decreases.

    ``flag`` is a toggle expression (true sets, false clears, null keeps);
    ``flag_name`` becomes the flag's value strictly before each row, starting
    from ``flag_initial(key..., initial)`` or false. Scans whose ``expr`` is a
    function receive that flag column.
    """
    keys = [key] if isinstance(key, str) else list(key)
    part = keys + [slice_col]
    wl = Window.partitionBy(*part).orderBy(*order)
    wc = Window.partitionBy(*keys).orderBy(slice_col)
    hyps = (False, True) if flag is not None else (None,)

    cols, local, summary = [], [], []
    if flag is not None:
        cols.append(flag.cast("boolean").alias("__flag_x"))
        local.append(_local("last", F.col("__flag_x"), wl, "__flag_x").alias("__flag_l"))
        summary.append(_summary("last", F.col("__flag_x"), order).alias("__flag_s"))

    def flag_col(h: bool) -> Column:
        return F.coalesce(F.col("__flag_l"), F.lit(h))

    for s in scans:
        for h in (hyps if s.flagged else (None,)):
            sfx = "" if h is None else ("_1" if h else "_0")
            t = f"__x_{s.name}{sfx}"
            cols.append((s.expr(flag_col(h)) if s.flagged else s.expr).alias(t))
            local.append(_local(s.kind, F.col(t), wl, t).alias(f"__l_{s.name}{sfx}"))
            summary.append(_summary(s.kind, F.col(t), order).alias(f"__s_{s.name}{sfx}"))

    # Level 1: inside the slice. Flag-dependent inputs need the local flag
    # first (a second window operator on the same sort, no new exchange).
    base = df
    if flag is not None:
        base = base.select("*", cols[0]).select("*", local[0])
        cols, local = cols[1:], local[1:]
    base = base.select("*", *cols)
    out = base.select("*", *local)
    # The summary side reads only the columns the summaries use.
    sums = base.groupBy(*part).agg(*summary)

    # Level 2: carry across slices on the small summary table.
    if flag is not None:
        if flag_initial is not None:
            init = flag_initial.select(*keys, F.col(flag_initial.columns[-1]).cast("boolean").alias("__flag_init"))
            sums = sums.join(init, keys, "left")
        else:
            sums = sums.withColumn("__flag_init", F.lit(None).cast("boolean"))
        sums = sums.withColumn("__flag_c", F.coalesce(_carry("last", F.col("__flag_s"), wc, "__flag_s"),
                                                      F.col("__flag_init"), F.lit(False)))
    carried_cols = [F.col("__flag_c")] if flag is not None else []
    chosen = []
    for s in scans:
        if s.flagged:
            chosen.append(F.when(F.col("__flag_c"), F.col(f"__s_{s.name}_1"))
                          .otherwise(F.col(f"__s_{s.name}_0")).alias(f"__s_{s.name}"))
        else:
            chosen.append(F.col(f"__s_{s.name}"))
    sums = sums.select(*part, *carried_cols, *chosen)
    carry = [_carry(s.kind, F.col(f"__s_{s.name}"), wc, f"__s_{s.name}").alias(f"__c_{s.name}") for s in scans]
    carried = sums.select(*part, *carried_cols, *carry)

    joined = out.join(carried, on=part, how="left")
    internal = (set(out.columns) | set(carried.columns)) - set(df.columns)
    final = []
    if flag is not None:
        joined = joined.withColumn("__flag_c", F.coalesce(F.col("__flag_c"), F.lit(False)))
        final.append(F.coalesce(F.col("__flag_l"), F.col("__flag_c")).alias(flag_name))
    for s in scans:
        if s.flagged:
            lv = F.when(F.col("__flag_c"), F.col(f"__l_{s.name}_1")).otherwise(F.col(f"__l_{s.name}_0"))
        else:
            lv = F.col(f"__l_{s.name}")
        final.append(_combine(s.kind, lv, F.col(f"__c_{s.name}")).alias(s.name))
    names = {s.name for s in scans} | {flag_name}
    keep = [c for c in joined.columns if c not in internal and c not in names]
    return joined.select(*keep, *final)
