"""Best-two-fit packing of documents into sequences of fixed length.

Documents become token ids with an end id; only those longer than a sequence
are cut. Pieces are dealt at random to shards of bounded token count, and
each shard is packed alone, one task each: fill a sequence greedily with the
largest pieces that fit, then exchange its smallest piece for two unpacked
ones that fit the widened gap more tightly. A shard leaves at most about one
sequence part-filled, so with ``shard_tokens`` at five hundred sequences
the loss against packing everything at once is about a five-hundredth.

Defined cases: a null or empty text is a document of the end id alone;
repeated rows and ids are documents of their own; a null id stays null; an
empty table gives no rows; other columns of the input are not carried.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetscope.llm.common import SMALL_SLICE, small_batches, text_slices
from fleetscope.llm.tokens import default_vocabulary, worker_tokenizer

SEQUENCE_TOKENS = 4096
SHARD_TOKENS = 2_000_000
PIECES = "doc_id long, piece int, start long, length int, shard int, ids binary"
PLACED = "doc_id long, piece int, start long, length int, sequence_id long, offset int, ids binary"


class _Sizes:
    """Multiset of sizes with "largest size at most x" lookups, as counts and
    a bit per size that is left."""

    def __init__(self, sizes: np.ndarray, limit: int):
        self.left = np.bincount(sizes, minlength=limit + 1).tolist()
        self.mask = sum(1 << s for s, n in enumerate(self.left) if n)
        self.upto = [(1 << (x + 1)) - 1 for x in range(limit + 1)]

    def at_most(self, x: int) -> int:
        """Largest size left that is at most ``x`` (0: none)."""
        return max(0, (self.mask & self.upto[x]).bit_length() - 1) if x > 0 else 0

    def take(self, s: int) -> None:
        self.left[s] -= 1
        if not self.left[s]:
            self.mask ^= 1 << s

    def give(self, s: int) -> None:
        self.left[s] += 1
        self.mask |= 1 << s


def best_two_fit(sizes: np.ndarray, limit: int) -> list[list[int]]:
    """Bins of sizes, each of at most ``limit`` in sum."""
    bag = _Sizes(sizes, limit)
    bins: list[list[int]] = []
    todo = len(sizes)
    while todo:
        own: list[int] = []
        gap = limit
        while s := bag.at_most(gap):
            bag.take(s)
            own.append(s)
            gap -= s
        if gap and (pair := tightest_pair(bag, own[-1], gap)):
            for s in pair:
                bag.take(s)
            bag.give(own.pop())
            own.extend(pair)
        todo -= len(own)
        bins.append(own)
    return bins


def tightest_pair(bag: _Sizes, smallest: int, gap: int) -> tuple[int, int] | None:
    """Two sizes left whose sum lies above ``smallest`` and fits the gap that
    its removal would leave, with the largest sum."""
    room = smallest + gap
    best, found = smallest, None
    a = bag.at_most(room - 1)
    while 2 * a > best:
        b = bag.at_most(min(a, room - a))
        if b == a and bag.left[a] < 2:
            b = bag.at_most(a - 1)
        if b and a + b > best:
            best, found = a + b, (a, b)
            if best == room:
                break
        a = bag.at_most(a - 1)
    return found


def cut_documents(docs: DataFrame, vocabulary: str | None = None, end_id: int = 1, limit: int = SEQUENCE_TOKENS,
                  shards: int = 1) -> DataFrame:
    """Pieces of at most ``limit`` ids per document, dealt to shards.

    ``ids`` are little-endian unsigned 16-bit (vocabularies of up to 65,536
    ids) or 32-bit integers here, to keep the shuffle small.
    """
    path = vocabulary or default_vocabulary()
    small_batches(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = worker_tokenizer(path)
        kind = np.dtype("<u2") if max(tok.vocabulary_size(), end_id + 1) <= 1 << 16 else np.dtype("<u4")
        task = TaskContext.get().partitionId() if TaskContext.get() else 0
        rng = np.random.default_rng([task, 0x5EED])
        for batch in batches:
            for part in text_slices(batch, "text", SMALL_SLICE):
                offsets, flat = tok.encode(part.column("text"))
                n = np.diff(offsets) + 1
                ids = np.insert(flat, offsets[1:], end_id).astype(kind)
                count = -(-n // limit)
                row = np.repeat(np.arange(len(n)), count)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
                start = piece * limit
                length = np.minimum(limit, n[row] - start)
                at = np.concatenate(([0], np.cumsum(length))) * kind.itemsize
                data = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(row), [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(row)).cast(pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                     pa.array(length, pa.int32()), pa.array(rng.integers(0, shards, len(row)), pa.int32()), data.cast(pa.binary())],
                    names=["doc_id", "piece", "start", "length", "shard", "ids"])

    return docs.select("doc_id", "text").mapInArrow(work, PIECES)


def place_pieces(pieces: pa.Table, limit: int) -> pa.Table:
    """One shard's pieces with their sequence and place in it."""
    length = pieces.column("length").to_numpy().astype(np.int64)
    bins = best_two_fit(length, limit)
    by_size = np.argsort(-length, kind="stable")
    flat = np.array([s for b in bins for s in b], np.int64)
    where = np.repeat(np.arange(len(bins)), [len(b) for b in bins])
    ends = np.cumsum(flat)
    offset = ends - flat - where_start(ends, flat, bins)
    # Pieces of one size are interchangeable: the k-th largest slot takes the
    # k-th largest piece.
    slot = np.argsort(-flat, kind="stable")
    sequence, offsets = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
    sequence[by_size], offsets[by_size] = where[slot], offset[slot]
    shard = pieces.column("shard").to_numpy().astype(np.int64)
    blobs = pieces.column("ids").combine_chunks()
    if isinstance(blobs, pa.ChunkedArray):
        blobs = pa.concat_arrays(blobs.chunks)
    data = np.concatenate([np.frombuffer(b, "<u2" if len(b) == 2 * n else "<u4").astype("<u4")
                           for b, n in zip(blobs.to_numpy(zero_copy_only=False), length)]) if len(length) else np.zeros(0, "<u4")
    at = np.concatenate(([0], np.cumsum(length))) * 4
    ids = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(length), [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(data)])
    return pa.table({"doc_id": pieces.column("doc_id"), "piece": pieces.column("piece"), "start": pieces.column("start"),
                     "length": pieces.column("length"), "sequence_id": pa.array((shard << 32) + sequence, pa.int64()),
                     "offset": pa.array(offsets, pa.int32()), "ids": ids.cast(pa.binary())})


def where_start(ends: np.ndarray, flat: np.ndarray, bins: list[list[int]]) -> np.ndarray:
    """Tokens before each slot's bin."""
    count = np.array([len(b) for b in bins], np.int64)
    if not len(count):
        return np.zeros(0, np.int64)
    last = np.cumsum(count)
    total = np.concatenate(([0], ends[last - 1][:-1]))
    return np.repeat(total, count)


def pack_documents(docs: DataFrame, vocabulary: str | None = None, end_id: int = 1, limit: int = SEQUENCE_TOKENS,
                   shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Every piece of every document with its sequence, place and ids.

    ``ids`` are little-endian unsigned 32-bit integers. The shard count
    follows the corpus: an estimate of its tokens (a third of its UTF-8 bytes
    plus the end ids) over ``shard_tokens``.
    """
    est = docs.agg((F.coalesce(F.sum(F.octet_length("text")), F.lit(0)) / 3 + F.count(F.lit(1))).alias("t")).first()["t"]
    shards = max(1, int(est // shard_tokens))
    pieces = cut_documents(docs, vocabulary, end_id, limit, shards)
    return pieces.groupBy("shard").applyInArrow(lambda t: place_pieces(t, limit), PLACED)
