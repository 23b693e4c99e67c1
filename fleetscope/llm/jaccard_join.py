"""Similarity join of documents on the Jaccard index of word n-grams.

1. One map pass gives each document the hash set of its five-word n-grams
   (reduced at once to a 128-bit digest of the set, its size and MinHash band
   hashes). ``rows`` and ``bands`` are chosen so that a pair at the threshold
   meets in some band with probability ``recall``.
2. Documents with equal sets form a class (their index is 1). From here on a
   class is one item with a weight, so exact copies never meet each other.
3. Band hashes are shuffled; a bucket is (band, hash) with two classes or
   more. Buckets with the same members in several bands are kept once, in the
   lowest band.
4. Members of kept buckets get their full n-gram sets (recomputed from whole
   texts in a second pass over only those documents). A bucket of many
   classes is cut into tiles of at most ``2 * TILE`` members, so a group of
   any size is spread over many tasks.
5. Each tile verifies its pairs exactly, by counting shared n-grams through
   postings; a pair is counted only in the first band where it meets. A tile
   returns its members' link counts and the links of a spanning forest; pairs
   are never written out as rows.
6. Connected components over the forests give the groups.

Identity. ``key`` is the id, or a hash of the n-gram set where the id is null.
Documents that share an id are taken as one document: their classes join.

Defined cases: null and empty texts have no n-gram and link with nothing,
their key is their class; texts of fewer words than ``n`` are one n-gram of
all their words; repeated rows are copies of each other; an empty table gives
no rows; columns other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetscope.llm.common import (SMALL_SLICE, MIX_A, mix, small_batches, sorted_groups, span_hashes, split_words, staged,
                                   text_slices, word_hashes)
from fleetscope.llm.components import connected_components

NGRAM, THRESHOLD, ROWS, RECALL = 5, 0.8, 5, 0.9999
TILE = 512
TILE_KEYS = ["band", "bucket", "side_a", "side_b"]


def bands_for(threshold: float = THRESHOLD, rows: int = ROWS, recall: float = RECALL) -> int:
    """Bands that let a pair at the threshold meet with this probability."""
    return ceil(log(1 - recall) / log(1 - threshold ** rows))


def ngram_set(words: np.ndarray, n: int = NGRAM) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's word n-grams."""
    if not len(words):
        return np.zeros(0, np.uint64)
    at = np.arange(max(1, len(words) - n + 1))
    return np.unique(span_hashes(words, at, np.minimum(at + n, len(words))))


class _MinHash:
    def __init__(self, bands: int, rows: int, seed: int = 17):
        rng = np.random.default_rng(seed)
        self.a = rng.integers(1, 1 << 63, bands * rows, dtype=np.uint64) | np.uint64(1)
        self.b = rng.integers(0, 1 << 63, bands * rows, dtype=np.uint64)
        self.bands, self.rows = bands, rows

    def band_hashes(self, items: np.ndarray) -> np.ndarray:
        least = np.full(self.bands * self.rows, np.iinfo(np.uint64).max, np.uint64)
        for s in range(0, len(items), 2048):        # bounded memory for any text length
            part = items[s:s + 2048, None] * self.a + self.b
            np.minimum(least, part.min(axis=0), out=least)
        m = mix(least).reshape(self.bands, self.rows)
        h = np.zeros(self.bands, np.uint64)
        for r in range(self.rows):
            h = mix(h * MIX_A + m[:, r])
        return h.view(np.int64)


def _digest(items: np.ndarray) -> tuple[int, int]:
    one = mix(items * MIX_A).sum(dtype=np.uint64)
    two = (mix(items + MIX_A) | np.uint64(1)).sum(dtype=np.uint64)
    return one.view(np.int64).item(), mix(two[None])[0].view(np.int64).item()


def fingerprints(docs: DataFrame, n: int = NGRAM, bands: int | None = None, rows: int = ROWS) -> DataFrame:
    """(doc_id, key, d1, d2, size, bands): digest of the n-gram set, its size
    and its band hashes (null without n-grams)."""
    bands = bands or bands_for(rows=rows)
    small_batches(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = _MinHash(bands, rows)
        for batch in batches:
            for part in text_slices(batch, "text", SMALL_SLICE):
                offsets, words = split_words(part.column("text"))
                hashes = word_hashes(words)
                sets = [ngram_set(hashes[s:e], n) for s, e in zip(offsets[:-1], offsets[1:])]
                digest = np.array([_digest(x) for x in sets], np.int64).reshape(-1, 2)
                ids = part.column("doc_id").cast(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [ids, ids.fill_null(0) if not ids.null_count else pa.array([d if d is not None else int(k) for d, k in zip(ids.to_pylist(), digest[:, 0])], pa.int64()),
                     pa.array(digest[:, 0]), pa.array(digest[:, 1]), pa.array([len(x) for x in sets], pa.int64()),
                     pa.array([least.band_hashes(x) if len(x) else None for x in sets], pa.list_(pa.int64()))],
                    names=["doc_id", "key", "d1", "d2", "size", "bands"])

    return docs.select("doc_id", "text").mapInArrow(
        work, "doc_id long, key long, d1 long, d2 long, size long, bands array<long>")


def _sets_of(docs: DataFrame, n: int, bands: int, rows: int) -> DataFrame:
    """(key, d1, d2, items, bands): full n-gram sets as packed 64-bit values."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = _MinHash(bands, rows)
        for batch in batches:
            for part in text_slices(batch, "text", SMALL_SLICE):
                offsets, words = split_words(part.column("text"))
                hashes = word_hashes(words)
                sets = [ngram_set(hashes[s:e], n) for s, e in zip(offsets[:-1], offsets[1:])]
                digest = np.array([_digest(x) for x in sets], np.int64).reshape(-1, 2)
                ids = part.column("doc_id").to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(k) if i is None else i for i, k in zip(ids, digest[:, 0])], pa.int64()), pa.array(digest[:, 0]),
                     pa.array(digest[:, 1]), pa.array([x.tobytes() for x in sets], pa.binary()),
                     pa.array([least.band_hashes(x).tobytes() for x in sets], pa.binary())],
                    names=["key", "d1", "d2", "items", "signature"])

    return docs.select("doc_id", "text").mapInArrow(work, "key long, d1 long, d2 long, items binary, signature binary")


def _verify(tile: pa.Table, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys, linked weight and forest root of each member of a tile."""
    key = tile.column("key").to_numpy()
    band = int(tile.column("band")[0].as_py())
    block = tile.column("block").to_numpy()
    weight = tile.column("weight").to_numpy()
    across = tile.column("side_a")[0].as_py() != tile.column("side_b")[0].as_py()
    sets = [np.frombuffer(x, np.uint64) for x in tile.column("items").combine_chunks().to_numpy(zero_copy_only=False)]
    earlier = np.stack([np.frombuffer(x, np.int64)[:band] for x in tile.column("signature").combine_chunks().to_numpy(zero_copy_only=False)])
    m = len(key)
    size = np.array([len(s) for s in sets], np.int64)
    _, item = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(m), size)
    order = np.argsort(item, kind="stable")
    post_owner = owner[order]
    post_first = np.searchsorted(item[order], np.arange(item.max() + 2))
    ends = np.cumsum(size)
    links = np.zeros(m, np.int64)
    root = np.arange(m)

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(m - 1):
        own = item[ends[i] - size[i]:ends[i]]
        counts = post_first[own + 1] - post_first[own]
        at = np.repeat(post_first[own] - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
        shared = np.bincount(post_owner[at], minlength=m)
        near = shared >= threshold * (size[i] + size - shared) - 1e-9
        near[:i + 1] = False
        if across:
            near &= block != block[i]
        if near.any():
            near &= ~(earlier == earlier[i]).any(axis=1)
        for j in np.flatnonzero(near).tolist():
            links[i] += weight[j]
            links[j] += weight[i]
            a, b = find(i), find(j)
            if a != b:
                if key[a] > key[b]:
                    a, b = b, a
                root[b] = a
    top = np.array([key[find(i)] for i in range(m)], np.int64)
    return key, links, top


def jaccard_join(docs: DataFrame, n: int = NGRAM, threshold: float = THRESHOLD, rows: int = ROWS,
                 recall: float = RECALL) -> DataFrame:
    """One row per document: doc_id, key, class_id (smallest key of the
    documents with the same n-gram set), n_links (other documents linked
    directly), component_id (smallest key reachable by links), kept (the one
    document of its group: key = component_id)."""
    bands = bands_for(threshold, rows, recall)
    prints = staged(fingerprints(docs, n, bands, rows), "fingerprints")
    full = prints.filter("size > 0")
    classes = full.groupBy("d1", "d2").agg(F.min("key").alias("rep"), F.count(F.lit(1)).alias("weight"),
                                           F.any_value("bands").alias("bands"))
    classes = staged(classes, "classes")
    hashes = classes.select("rep", F.posexplode("bands").alias("band", "bucket"))
    buckets = (hashes.groupBy("band", "bucket")
               .agg(F.count(F.lit(1)).alias("m"), F.min("rep").alias("low"), F.max("rep").alias("high"),
                    F.bit_xor(F.xxhash64("rep")).alias("x")).filter("m > 1"))
    # Buckets of the same classes in several bands: the lowest band is enough.
    buckets = (buckets.groupBy("m", "low", "high", "x").agg(F.min(F.struct("band", "bucket")).alias("b"))
               .select("b.band", "b.bucket", F.ceil(F.col("m") / TILE).cast("int").alias("blocks")))
    members = staged(hashes.join(buckets, ["band", "bucket"]), "members")

    wanted = members.select("rep").distinct().join(classes.select("rep", "d1", "d2", "weight"), "rep")
    wanted = staged(wanted, "wanted")
    # Documents whose id stands for a wanted class; null ids are few or are
    # told by their digest.
    by_id = docs.join(wanted.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
    unnamed = docs.filter("doc_id IS NULL")
    sets = _sets_of(by_id.select("doc_id", "text").unionByName(unnamed.select("doc_id", "text")), n, bands, rows)
    sets = (sets.join(wanted, (sets["key"] == wanted["rep"]) & (sets["d1"] == wanted["d1"]) & (sets["d2"] == wanted["d2"]))
            .select("key", "weight", "items", "signature", sets["d1"], sets["d2"])
            .dropDuplicates(["key", "d1", "d2"]).drop("d1", "d2"))
    sets = staged(sets, "sets")

    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    tiles = (members.withColumn("block", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("band", "bucket", F.least("block", "other").alias("side_a"), F.greatest("block", "other").alias("side_b"), "block",
                     F.col("rep").alias("key")))
    tiles = tiles.join(sets, "key")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in sorted_groups(batches, TILE_KEYS):
            if tile.num_rows > 1:
                key, links, top = _verify(tile, threshold)
                yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(links), pa.array(top)], names=["key", "links", "top"])

    # Ranges, not hashes: whole tiles side by side in parts of equal rows.
    found = staged(tiles.repartitionByRange(*TILE_KEYS).sortWithinPartitions(*TILE_KEYS)
                   .mapInArrow(work, "key long, links long, top long"), "links")
    near = found.filter("links > 0")
    # Classes of one id are one document: its other classes join by the key.
    groups = connected_components(near, "key", "top")
    counts = near.groupBy("key").agg(F.sum("links").alias("links"))
    per_class = (classes.select("d1", "d2", F.col("rep").alias("class_id"), "weight")
                 .join(counts.withColumnRenamed("key", "class_id"), "class_id", "left")
                 .join(groups.select(F.col("node").alias("class_id"), "component"), "class_id", "left")
                 .select("d1", "d2", "class_id", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                         F.coalesce("component", "class_id").alias("component_id")))
    linked = prints.drop("bands").join(per_class, ["d1", "d2"], "left")
    class_id = F.when(F.col("size") > 0, F.col("class_id")).otherwise(F.col("key"))
    component = F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("key"))
    return linked.select("doc_id", "key", class_id.alias("class_id"),
                         F.when(F.col("size") > 0, F.col("n_links")).otherwise(F.lit(0)).cast("long").alias("n_links"),
                         component.alias("component_id"), (F.col("key") == component).alias("kept"))
