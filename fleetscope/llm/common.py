"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetscope.plans.stage import stage

# Characters that one Python call works on at a time. Bounds the memory of a
# task for any row length up to Spark's own limits; a longer text is still
# processed whole, alone in its slice.
SLICE_CHARS = 8_000_000
# The same for stages that run after each other in one pipeline, where the
# workers' memory adds to that of the stages before.
SMALL_SLICE = 2_000_000
# Bytes per Arrow batch sent to Python workers, whatever the texts' lengths.
ARROW_BYTES = 16 << 20

WORD = r"[^\x20\x09-\x0D]+"

# Odd 64-bit multipliers of the hash functions below.
MIX_A = np.uint64(0x9E3779B97F4A7C15)
MIX_B = np.uint64(0xBF58476D1CE4E5B9)
MIX_C = np.uint64(0x94D049BB133111EB)
BASE = np.uint64(0x100000001B3)
BASE_INV = np.uint64(pow(0x100000001B3, -1, 1 << 64))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables, through Spark's reader."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Send about ``ARROW_BYTES`` at once to Python workers (the session keeps
    a smaller setting of its own)."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = int(str(spark.conf.get(key)).rstrip("b"))
    if now <= 0 or now > ARROW_BYTES:
        spark.conf.set(key, str(ARROW_BYTES))


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back (cuts lineage)."""
    return stage(df, f"llm-{name}")


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """True for the rows no label may be learned from: crc32 of the id's text
    leaves 2 modulo 4. A null id is not held out (and has no label)."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def text_slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_CHARS) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of a batch with at most ``limit`` bytes of text
    each (or a single row)."""
    size = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False), np.int64)
    total = np.cumsum(size)
    start = 0
    while start < batch.num_rows:
        done = total[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(total, done + limit, side="right")))
        yield batch.slice(start, end - start)
        start = end
    # Buffers freed meanwhile go back to the system, not to the next stage.
    pa.default_memory_pool().release_unused()


def split_words(text: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Words (runs without ASCII white space) of each text: offsets into the
    flat word array (rows + 1 entries) and that array. Null text: no words."""
    parts = pc.ascii_split_whitespace(pc.fill_null(text.cast(pa.large_string()), ""))
    flat = parts.flatten()
    keep = pc.greater(pc.binary_length(flat), 0)
    lengths = np.asarray(pc.list_value_length(parts).to_numpy(zero_copy_only=False), np.int64)
    before = np.concatenate(([0], np.cumsum(lengths)))
    kept = np.concatenate(([0], np.cumsum(keep.to_numpy(zero_copy_only=False).astype(np.int64))))
    return kept[before], flat.filter(keep)


def mix(h: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (a bijection)."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= MIX_B
    h ^= h >> np.uint64(27)
    h *= MIX_C
    h ^= h >> np.uint64(31)
    return h


_powers = np.ones(1, np.uint64)
_inverses = np.ones(1, np.uint64)


def _grow(n: int) -> None:
    global _powers, _inverses
    if len(_powers) < n:
        size = max(n, 1 << 16)
        with np.errstate(over="ignore"):
            _powers = np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(size, BASE, np.uint64), dtype=np.uint64)))
            _inverses = np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(size, BASE_INV, np.uint64), dtype=np.uint64)))


def span_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Rolling polynomial hash of ``values[start:end]`` for many spans.

    One prefix sum serves spans of any length; the result depends on the
    span's content only, not on its place.
    """
    _grow(len(values) + 1)
    prefix = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values.astype(np.uint64) * _powers[:len(values)], dtype=np.uint64, out=prefix[1:])
    h = (prefix[end] - prefix[start]) * _inverses[start]
    return mix(h + (end - start).astype(np.uint64) * MIX_A)


def word_hashes(words: pa.Array) -> np.ndarray:
    """64-bit hash of each word, computed once per distinct word."""
    coded = words.dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    distinct = coded.dictionary.cast(pa.large_binary())
    bounds = np.frombuffer(distinct.buffers()[1], np.int64)[distinct.offset:distinct.offset + len(distinct) + 1]
    data = np.frombuffer(distinct.buffers()[2] or b"", np.uint8)[bounds[0]:bounds[-1]].astype(np.uint64) + np.uint64(1)
    hashes = span_hashes(data, bounds[:-1] - bounds[0], bounds[1:] - bounds[0]) if len(distinct) else np.zeros(0, np.uint64)
    return hashes[coded.indices.to_numpy(zero_copy_only=False)] if len(words) else np.zeros(0, np.uint64)


def labelled_sample(docs: DataFrame, labels: DataFrame, target: str, per_class: int, max_chars: int,
                    seed: int = 7) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Texts and 0/1 labels to fit a classifier on, and the class counts.

    A bounded sample (documented parameters): the first ``per_class`` ids of
    each class in the order of a hash of the id, among labelled rows that are
    not held out, of which the documents with at most ``max_chars`` characters
    are taken; the same at every run. Ids with
    contradicting labels and null labels are left out. The driver therefore
    receives at most ``2 * per_class * max_chars`` characters.
    """
    rows = (labels.filter(F.col(target).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
            .groupBy("doc_id").agg(F.min(target).alias("y"), F.max(target).alias("y2"))
            .filter("y = y2").select("doc_id", F.col("y").cast("int").alias("y")))
    counts = {r["y"]: r["n"] for r in rows.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    draw = F.xxhash64(F.lit(seed), "doc_id")
    picked = None
    for y in sorted(counts):
        own = rows.filter(F.col("y") == y).orderBy(draw, "doc_id").limit(per_class)
        picked = own if picked is None else picked.unionByName(own)
    if picked is None:
        return [], np.zeros(0, np.int64), np.zeros(2, np.int64)
    # Broadcast: at most 2 * per_class ids. Of an id's documents the first in
    # code point order counts.
    got = (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(picked), "doc_id")
           .filter(F.length("text") <= max_chars).groupBy("doc_id", "y").agg(F.min("text").alias("text")).collect())
    got.sort(key=lambda r: (r["doc_id"], r["text"]))
    return ([r["text"] for r in got], np.array([r["y"] for r in got], np.int64),
            np.array([counts.get(0, 0), counts.get(1, 0)], np.int64))


def logistic_fit(score: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and offset turning a margin into a probability (Platt scaling
    with smoothed targets, Newton steps on the weighted log loss)."""
    if len(score) == 0:
        return 0.0, 0.0
    n1, n0 = weight[y == 1].sum(), weight[y == 0].sum()
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 0.0, float(np.log((n1 + 1) / (n0 + 1)))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a * score + b, -35, 35)))
        g, v = weight * (p - target), weight * np.maximum(p * (1 - p), 1e-9)
        grad = np.array([(g * score).sum() + 1e-4 * a, g.sum()])
        hess = np.array([[(v * score * score).sum() + 1e-4, (v * score).sum()], [(v * score).sum(), v.sum() + 1e-6]])
        step = np.linalg.solve(hess, grad)
        size = np.abs(step).max()
        step = step if size < 5 else step * (5 / size)
        a, b = a - step[0], b - step[1]
        if size < 1e-8:
            break
    return float(a), float(b)


def hinge_dual(x_index: list[np.ndarray], x_value: list[np.ndarray], y: np.ndarray, n_features: int,
               cost: np.ndarray, epochs: int = 20, seed: int = 11) -> tuple[np.ndarray, float]:
    """Linear support vector machine (hinge loss) by dual coordinate descent.

    Each step picks one example, moves its dual variable to the exact optimum
    within ``[0, cost]`` and updates the weights by its sparse row. The last
    weight is the offset (an added feature that is always 1).
    """
    rng = np.random.default_rng(seed)
    w, bias = np.zeros(n_features), 0.0
    alpha = np.zeros(len(y))
    sign = np.where(y == 1, 1.0, -1.0)
    diag = np.array([float(v @ v) + 1.0 for v in x_value])
    for _ in range(epochs):
        worst = 0.0
        for i in rng.permutation(len(y)):
            idx, val = x_index[i], x_value[i]
            g = sign[i] * (w[idx] @ val + bias) - 1.0
            new = min(max(alpha[i] - g / diag[i], 0.0), cost[i])
            d = new - alpha[i]
            if d != 0.0:
                alpha[i] = new
                w[idx] += d * sign[i] * val
                bias += d * sign[i]
                worst = max(worst, abs(d) * diag[i])
        if worst < 1e-3:
            break
    return w, bias


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Consecutive rows with equal (non-null integer) keys, as one table each,
    from a stream sorted by the keys. Holds one group in memory."""
    held: list[pa.Table] = []
    last = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        t = pa.Table.from_batches([batch])
        cols = np.stack([t.column(k).to_numpy() for k in keys], axis=1)
        cuts = np.flatnonzero((cols[1:] != cols[:-1]).any(axis=1)) + 1
        bounds = [0, *cuts.tolist(), len(cols)]
        for s, e in zip(bounds[:-1], bounds[1:]):
            key = tuple(cols[s].tolist())
            if held and key != last:
                yield pa.concat_tables(held)
                held = []
            held.append(t.slice(s, e - s))
            last = key
    if held:
        yield pa.concat_tables(held)
