"""Periodic runs of words, found by recursive frequency splitting.

A run is a stretch of consecutive words with smallest period ``q`` (words
``q`` apart are equal), of at least ``max(min_length, min_exponent * q)``
words, that neither neighbour extends. Every word of such a run occurs in it
at least ``min_exponent`` times, so:

1. **Split.** A word that occurs fewer times within the present segment (a
   whole text at first) lies in no run and cuts the segment there; segments
   too short for a run go. The parts are counted anew until nothing cuts.
   Ordinary prose falls apart in two or three rounds, and all segments of an
   Arrow slice are counted together in numpy. Splitting only prunes: a
   segment that is still falling apart after ``max_rounds`` goes on as it is,
   with the same result.
2. **Scan.** The surviving segments are scanned at every lag ``q``. A run
   covers at least ``min_exponent - 1`` whole blocks ``[kq, (k+1)q)``, so
   only the hashes of such blocks are compared with their neighbours: ``n/q``
   comparisons a lag and ``n log n`` in all, also for one text that is
   periodic throughout. A stretch whose period a prime divisor of ``q``
   makes smaller is left to that lag. What remains is compared word by word
   to find the exact ends.

A collapsed text keeps the first period of every run and drops the rest.
One map pass; a text never leaves its task, so no key can be hot.

Defined cases: null, empty and wordless texts have no runs and collapse to
the empty text; repeated rows and ids, ties and null ids are rows of their
own; an empty table gives no rows; input columns named like results are
replaced, all others pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetscope.llm.common import WORD, mix, small_batches, split_words, text_slices

MIN_LENGTH, MIN_EXPONENT, MAX_ROUNDS = 6, 4, 64
# Bytes of text worked on at once: bounds the memory of a task.
SLICE_BYTES = 2_000_000
BASE, BASE_INV = np.uint64(0x100000001B3), np.uint64(pow(0x100000001B3, -1, 1 << 64))

RUNS = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")]))


def split_segments(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, min_length: int, min_count: int,
                   max_rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Segments (starts, ends) whose every word is frequent within them."""
    done_s, done_e = [], []
    width = int(codes.max()) + 1 if len(codes) else 1
    for _ in range(max_rounds):
        long = ends - starts >= min_length
        starts, ends = starts[long], ends[long]
        if not len(starts):
            break
        size = ends - starts
        segment = np.repeat(np.arange(len(size)), size)
        first = np.cumsum(size) - size
        place = np.arange(int(size.sum())) + np.repeat(starts - first, size)
        key = segment * width + codes[place]
        order = np.argsort(key, kind="stable")
        ranked = key[order]
        edge = np.flatnonzero(np.concatenate(([True], ranked[1:] != ranked[:-1])))
        count = np.diff(np.append(edge, len(ranked)))
        frequent = np.empty(len(key), bool)
        frequent[order] = np.repeat(count >= min_count, count)
        whole = np.logical_and.reduceat(frequent, first)
        done_s.append(starts[whole])
        done_e.append(ends[whole])
        # The stretches of frequent words in the segments that fell apart.
        frequent &= ~whole[segment]
        begins = frequent.copy()
        begins[1:] &= ~(frequent[:-1] & (segment[1:] == segment[:-1]))
        stops = frequent.copy()
        stops[:-1] &= ~(frequent[1:] & (segment[1:] == segment[:-1]))
        starts, ends = place[begins], place[stops] + 1
    done_s.append(starts)
    done_e.append(ends)
    s, e = np.concatenate(done_s), np.concatenate(done_e)
    long = e - s >= min_length
    return s[long], e[long]


def _prime_divisors(q: int) -> list[int]:
    out, r = [], 2
    while r * r <= q:
        if q % r == 0:
            out.append(r)
            while q % r == 0:
                q //= r
        r += 1
    return out + ([q] if q > 1 else [])


def scan_lags(codes: np.ndarray, starts: np.ndarray, ends: np.ndarray, min_length: int, min_exponent: int) -> np.ndarray:
    """Runs inside the segments: rows of (segment, start, length, period)
    with starts into ``codes``, by segment, start and period."""
    found: list[tuple[int, int, int, int]] = []
    if not len(starts):
        return np.zeros((0, 4), np.int64)
    # Segments side by side, the longest first, so that the ones long enough
    # for a lag are a prefix.
    order = np.argsort(starts - ends, kind="stable")
    size = (ends - starts)[order]
    first = np.cumsum(size) - size
    own = codes[np.arange(int(size.sum())) + np.repeat(starts[order] - first, size)]
    n = len(own)
    with np.errstate(over="ignore"):
        power = np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(n, BASE, np.uint64), dtype=np.uint64)))
        inverse = np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(n, BASE_INV, np.uint64), dtype=np.uint64)))
        prefix = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(own.astype(np.uint64) + np.uint64(1)) * power[:n], dtype=np.uint64)))

        def spans(a: np.ndarray, b: np.ndarray) -> np.ndarray:
            return (prefix[b] - prefix[a]) * inverse[a]

        for q in range(1, int(size[0]) // min_exponent + 1):
            need = max(min_length, min_exponent * q)
            active = int(np.searchsorted(-size, -need, side="right"))
            if not active:
                break
            blocks = size[:active] // q
            segment = np.repeat(np.arange(active), blocks)
            at = first[segment] + (np.arange(len(segment)) - np.repeat(np.cumsum(blocks) - blocks, blocks)) * q
            h = spans(at, at + q)
            same = (h[1:] == h[:-1]) & (segment[1:] == segment[:-1])
            if not same.any():
                continue
            edges = np.flatnonzero(np.diff(np.concatenate(([False], same, [False])).astype(np.int8)))
            i, j = edges[::2], edges[1::2]                # blocks i..j are equal
            enough = j - i + 1 >= min_exponent - 1
            i, j = i[enough], j[enough]
            a, b = at[i], at[j] + q
            for r in _prime_divisors(q):
                d = q // r
                smaller = spans(a, b - d) == spans(a + d, b)
                a, b, i = a[~smaller], b[~smaller], i[~smaller]
            for left, right, k in zip(a.tolist(), b.tolist(), segment[i].tolist()):
                lo, hi = max(int(first[k]), left - q), min(int(first[k] + size[k]), right + q)
                equal = np.concatenate(([False], own[lo:hi - q] == own[lo + q:hi], [False]))
                cuts = np.flatnonzero(equal[1:] != equal[:-1])
                for s, e in zip(cuts[::2].tolist(), cuts[1::2].tolist()):
                    if e - s + q >= need and lo + s < right and lo + e + q > left:
                        found.append((int(order[k]), lo + s - int(first[k]), e - s + q, q))
    if not found:
        return np.zeros((0, 4), np.int64)
    out = np.array(sorted(found), np.int64)
    out[:, 1] += starts[out[:, 0]]
    return out


def runs_of_texts(offsets: np.ndarray, codes: np.ndarray, min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT,
                  max_rounds: int = MAX_ROUNDS) -> np.ndarray:
    """Runs of many texts: rows of (text, start, length, period), starts
    counted from the text's first word, ordered by text, start and period."""
    s, e = split_segments(codes, offsets[:-1], offsets[1:], min_length, min_exponent, max_rounds)
    found = scan_lags(codes, s, e, min_length, min_exponent)
    if not len(found):
        return found
    text = np.searchsorted(offsets, found[:, 1], side="right") - 1
    out = np.column_stack((text, found[:, 1] - offsets[text], found[:, 2], found[:, 3]))
    return out[np.lexsort((out[:, 3], out[:, 1], out[:, 0]))]


def _list_array(offsets: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def periodic_runs(docs: DataFrame, text: str = "text", min_length: int = MIN_LENGTH, min_exponent: int = MIN_EXPONENT) -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` (start, length, period, by start
    and period) and ``collapsed`` (kept words joined by one space)."""
    if min_exponent < 3 or min_length < 1:
        raise ValueError("block comparison needs an exponent of at least 3")
    names = ["n_words", "runs", "collapsed"]
    keep = [f for f in docs.schema.fields if f.name not in names]
    kept = [f.name for f in keep]
    schema = T.StructType(keep + [T.StructField("n_words", T.LongType()), T.StructField("runs", RUNS), T.StructField("collapsed", T.StringType())])
    small_batches(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in text_slices(batch, text, SLICE_BYTES):
                offsets, words = split_words(part.column(text))
                coded = words.dictionary_encode()
                if isinstance(coded, pa.ChunkedArray):
                    coded = coded.combine_chunks()
                codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
                found = runs_of_texts(offsets, codes, min_length, min_exponent)
                drop = np.zeros(len(codes) + 1, np.int64)
                np.add.at(drop, offsets[found[:, 0]] + found[:, 1] + found[:, 3], 1)
                np.add.at(drop, offsets[found[:, 0]] + found[:, 1] + found[:, 2], -1)
                stay = np.cumsum(drop[:-1]) == 0
                before = np.concatenate(([0], np.cumsum(stay)))[offsets]
                lists = _list_array(before, words.filter(pa.array(stay)).cast(pa.string()))
                at = np.searchsorted(found[:, 0], np.arange(len(offsets)))
                runs = pa.StructArray.from_arrays([pa.array(found[:, k], pa.int64()) for k in (1, 2, 3)], ["start", "length", "period"])
                yield pa.RecordBatch.from_arrays(
                    [part.column(k) for k in kept]
                    + [pa.array(np.diff(offsets), pa.int64()), _list_array(at, runs), pc.binary_join(lists, " ")],
                    names=kept + names)

    return docs.select(*[F.col(f"`{k}`") for k in kept]).mapInArrow(work, schema)


def planted(doc_id: Column, text: Column) -> Column:
    """The text with its tail made periodic where ``h = crc32(decimal id)`` is
    divisible by ten: from word ``a = g % n`` on (``g = h div 10``), the first
    ``p = 1 + (n - a) div (3 + g % 8)`` words repeat. Null ids: unchanged."""
    h = F.crc32(doc_id.cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))
    n = F.size(words).cast("long")
    a = F.pmod(g, n)
    tail = n - a
    p = 1 + F.floor(tail / (3 + F.pmod(g, F.lit(8))))
    cycle = F.slice(words, (a + 1).cast("int"), p.cast("int"))
    whole = F.flatten(F.array_repeat(cycle, F.ceil(tail / p).cast("int")))
    made = F.array_join(F.concat(F.slice(words, F.lit(1), a.cast("int")), F.slice(whole, F.lit(1), tail.cast("int"))), " ")
    return F.when((h % 10 == 0) & F.coalesce(text.rlike(WORD), F.lit(False)), made).otherwise(text)


def run_digest(found: DataFrame) -> DataFrame:
    """Per document: the number of runs, the greatest one (ties: smallest
    start, then period), and SHA-256 of all runs and of the collapsed text."""
    top = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("q"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    lines = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    return (found.withColumn("top", top)
            .select("doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("top.s")).alias("start"), F.col("top.length").alias("length"),
                    (-F.col("top.q")).alias("period"), F.expr("1000 * top.length div -top.q").alias("exponent_milli"),
                    F.sha2(lines.cast("binary"), 256).alias("runs_sha256"), F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256")))
