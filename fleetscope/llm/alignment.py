"""Alignment of two tokenisers over the same texts.

Side A is a byte-level vocabulary of the tokenizers library, side B a model
of sentencepiece. Both tile the bytes of ``" " + text``, so their tokens are
intervals on one axis:

* **Links**: all pairs of an A and a B token that overlap. Per Arrow slice,
  ``pandas.merge_asof`` keyed by document finds for each token's start the
  covering token of the other side; the union of both directions is every
  overlap, because of two overlapping intervals one starts inside the other.
* **Groups**: the offsets where tokens of both sides end cut a document into
  the smallest stretches that both sides tile alone.
* **Pair counts**: in how many documents of the corpus an (A id, B id) pair is
  linked, and whether that is the most of all pairs of its A id.

The counts come from the whole corpus and go back to every document, without
a row per link. Documents are gathered into blocks of ``BLOCK_BYTES`` of text
inside map tasks and staged; a block holds its distinct pairs once, with the
number of its documents that hold them. Pairs are summed over blocks (partial
sums before the shuffle), the rated pairs return to the blocks that hold them
by a join on the pair, and each block then rates its own documents. A pair
has at most one row per block, so that a pair which every document holds is
no hot key; AQE splits the join further where it would be.

Defined cases: texts that are null or empty, and texts of which either side's
token bytes differ from ``" " + text`` (a normalising model, or U+2581 in the
text), have no tokens: counts of zero, no groups, no links. Special tokens'
strings inside texts are plain text. Repeated rows and ids are documents of
their own; null ids stay null; other columns of the input are not carried; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetscope.llm.common import small_batches, staged, text_slices
from fleetscope.llm.tokens import WordStore, byte_of_letter, coded, listed

# Bytes of text aligned at once, and bytes of text of a staged block (at
# least one text each).
SLICE_BYTES, BLOCK_BYTES = 2_000_000, 8_000_000
TOKENS = "doc_id long, a_ids array<int>, b_ids array<int>, groups string, links array<struct<a:int,b:int>>"
BLOCKS = ("block long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, groups array<string>, "
          "n_pairs array<long>, pair_at binary, pair_links binary, pairs binary, pair_docs binary")
REPORT = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups string")


def default_paths() -> tuple[str, str]:
    """Paths of the installed public vocabularies (side A, side B)."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@dataclass(frozen=True)
class TokenBytes:
    """Bytes of every id: flat, with each id's start and length."""
    flat: np.ndarray
    start: np.ndarray
    size: np.ndarray

    @staticmethod
    def of(entries: list[bytes]) -> TokenBytes:
        size = np.array([len(e) for e in entries], np.int64)
        return TokenBytes(np.frombuffer(b"".join(entries), np.uint8), np.cumsum(size) - size, size)

    def joined(self, ids: np.ndarray) -> np.ndarray:
        n = self.size[ids]
        return self.flat[np.arange(int(n.sum())) + np.repeat(self.start[ids] - (np.cumsum(n) - n), n)]


class SideA:
    """Ids by the tokenizers library; its tables also drive tiktoken, which
    gives the same ids faster where both read characters alike."""

    # Texts of other characters, and long ones without a place to cut (white
    # space can exhaust tiktoken's stack), take the library itself.
    PLAIN_END, PLAIN_CHARS = "\u0250", 500

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = byte_of_letter()
        vocabulary = spec["model"]["vocab"]
        added = {t["id"]: t["content"].encode() for t in spec.get("added_tokens", [])}
        # An added token's id is never given to a text.
        ranks = {bytes(letters[c] for c in k): i for k, i in vocabulary.items() if i not in added}
        by_id = {i: b for b, i in ranks.items()} | added
        self.bytes = TokenBytes.of([by_id.get(i, b"") for i in range(max(by_id) + 1)])
        self.quick = self._quick(spec, ranks)

    @staticmethod
    def _quick(spec: dict, ranks: dict[bytes, int]):
        """tiktoken's encoder, where the file is a plain byte-level one whose
        merges are ranked as its ids."""
        level = spec["pre_tokenizer"] or {}
        if spec["normalizer"] or level.get("type") != "ByteLevel" or level.get("add_prefix_space") or not level.get("use_regex", True):
            return None
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        made = [spec["model"]["vocab"][a + b] for a, b in merges]
        if made != sorted(made) or len(made) + 256 != len(ranks):
            return None
        import public_tokenizers
        import tiktoken
        return tiktoken.Encoding("side-a", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_ordinary

    def encode(self, texts: list[str]) -> list[list[int]]:
        """Ids of ``" " + text`` of each text."""
        quick = [self.quick is not None and len(t) < self.PLAIN_CHARS and (t.isascii() or max(t) < self.PLAIN_END) for t in texts]
        slow = iter(self.tokenizer.encode_batch([" " + t for t, q in zip(texts, quick) if not q], add_special_tokens=False))
        return [self.quick(" " + t) if q else next(slow).ids for t, q in zip(texts, quick)]


class SideB:
    """Ids by sentencepiece, which adds the leading space itself."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        self.model = SentencePieceProcessor(model_file=path)
        n = self.model.vocab_size()
        self.bytes = TokenBytes.of([bytes([int(self.model.id_to_piece(i)[3:-1], 16)]) if self.model.is_byte(i)
                                    else self.model.id_to_piece(i).replace("▁", " ").encode() for i in range(n)])

    def encode(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)


@dataclass(frozen=True)
class Alignment:
    """Tokens, links and groups of several texts; offsets have one entry per
    text and one more, links and ends number tokens of the flat arrays."""
    a_ids: np.ndarray
    a_off: np.ndarray
    b_ids: np.ndarray
    b_off: np.ndarray
    link_a: np.ndarray
    link_b: np.ndarray
    end_a: np.ndarray            # tokens before each group's end
    end_b: np.ndarray
    group_off: np.ndarray


def _only(ids: np.ndarray, off: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of the marked texts; the others have none."""
    size = np.diff(off)
    return ids[np.repeat(rows, size)], np.concatenate(([0], np.cumsum(size * rows)))


# A space that follows none and does not end the text: neither side joins
# characters across it, so the stretches between are encoded alone.
CUT = re.compile(r"(?<=\S)(?= .)", re.DOTALL)
NO_CUT = r"(^|[\s\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}])$"


def cut_texts(text: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Offsets and flat stretches of texts: each stands for a space and
    itself, and all of a text's in order for a space and the text."""
    parts = pc.split_pattern(text, " ")
    if isinstance(parts, pa.ChunkedArray):
        parts = parts.combine_chunks()
    size = np.asarray(pc.list_value_length(parts).to_numpy(zero_copy_only=False), np.int64)
    ends = np.cumsum(size)
    # A part that is empty or ends in white space belongs to the next one.
    flat = parts.flatten()
    open_end = pc.match_substring_regex(flat, NO_CUT).to_numpy(zero_copy_only=False).astype(np.int64)
    open_end[ends - 1] = pc.equal(flat.take(pa.array(ends - 1)), "").to_numpy(zero_copy_only=False)
    joined = np.flatnonzero(np.add.reduceat(open_end, ends - size)) if len(size) else np.zeros(0, np.int64)
    if len(joined):
        redone = pa.array([[p[1:] for p in CUT.split(" " + text[i].as_py())] for i in joined.tolist()], parts.type)
        order = np.arange(len(size))
        order[joined] = len(size) + np.arange(len(joined))
        parts = pa.concat_arrays([parts, redone]).take(pa.array(order))
        size = np.asarray(pc.list_value_length(parts).to_numpy(zero_copy_only=False), np.int64)
    return np.concatenate(([0], np.cumsum(size))), parts.flatten()


class Aligner:
    def __init__(self, path_a: str, path_b: str, cache_words: int = 400_000):
        self.a, self.b = SideA(path_a), SideB(path_b)
        self.name_a, self.name_b = (pa.array([str(i) for i in range(len(s.bytes.size))]) for s in (self.a, self.b))
        self.store = WordStore(self._learn, 2, np.uint32, cache_words)
        # Side B must not join across a cut: no piece has a space after another character.
        inner = [p for p in map(self.b.model.id_to_piece, range(len(self.b.bytes.size))) if "▁" in p.lstrip("▁")]
        if inner or self.a.quick is None:
            raise ValueError("texts cannot be cut at spaces for these vocabularies")

    def _learn(self, parts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids of both sides; none where the bytes of either side's tokens are
        not a space and the part."""
        raw = [b" " + p.encode() for p in parts]
        want, size = np.frombuffer(b"".join(raw), np.uint8), np.array([len(r) for r in raw], np.int64)
        lists = [listed(s.encode(parts)) for s in (self.a, self.b)]
        good = np.ones(len(parts), bool)
        for side, (n, ids) in zip((self.a, self.b), lists):
            ends = np.concatenate(([0], np.cumsum(side.bytes.size[ids])))[np.cumsum(n)]
            good &= np.diff(ends, prepend=0) == size
        for side, (n, ids) in zip((self.a, self.b), lists):
            differ = np.flatnonzero(side.bytes.joined(ids[np.repeat(good, n)]) != want[np.repeat(good, size)])
            good[np.flatnonzero(good)[np.unique(np.searchsorted(np.cumsum(size[good]), differ, side="right"))]] = False
        return [(n * good, ids[np.repeat(good, n)]) for n, ids in lists]

    def align(self, text: pa.Array) -> Alignment:
        text = pc.fill_null(text.cast(pa.large_string()), "")
        size = np.asarray(pc.binary_length(text).to_numpy(zero_copy_only=False), np.int64)
        offsets, parts = cut_texts(text)
        (n_a, a_ids), (n_b, b_ids) = self.store.lists(*coded(parts))
        a_ids, a_off = a_ids.astype(np.int64), np.concatenate(([0], np.cumsum(n_a)))[offsets]
        b_ids, b_off = b_ids.astype(np.int64), np.concatenate(([0], np.cumsum(n_b)))[offsets]
        # A part without tokens leaves its text short of bytes.
        total = np.concatenate(([0], np.cumsum(self.a.bytes.size[a_ids])))[a_off]
        rows = (size > 0) & (np.diff(total) == size + 1)
        if not rows.all():
            a_ids, a_off = _only(a_ids, a_off, rows)
            b_ids, b_off = _only(b_ids, b_off, rows)
        return self._overlaps(a_ids, a_off, b_ids, b_off)

    def _overlaps(self, a_ids: np.ndarray, a_off: np.ndarray, b_ids: np.ndarray, b_off: np.ndarray) -> Alignment:
        # Both sides tile the same bytes of the same texts, one after the other.
        end_a, end_b = np.cumsum(self.a.bytes.size[a_ids]), np.cumsum(self.b.bytes.size[b_ids])
        frame_a = pd.DataFrame({"at": end_a - self.a.bytes.size[a_ids], "doc": np.repeat(np.arange(len(a_off) - 1), np.diff(a_off)),
                                "a": np.arange(len(a_ids))})
        frame_b = pd.DataFrame({"at": end_b - self.b.bytes.size[b_ids], "doc": np.repeat(np.arange(len(b_off) - 1), np.diff(b_off)),
                                "b": np.arange(len(b_ids))})
        from_a = pd.merge_asof(frame_a, frame_b, on="at", by="doc")
        from_b = pd.merge_asof(frame_b, frame_a, on="at", by="doc")
        # Equal starts are found from both sides: count them once.
        cover = from_b["a"].to_numpy()
        later = frame_a["at"].to_numpy()[cover] != from_b["at"].to_numpy() if len(cover) else np.zeros(0, bool)
        link_a = np.concatenate((from_a["a"].to_numpy(), cover[later]))
        link_b = np.concatenate((from_a["b"].to_numpy(), from_b["b"].to_numpy()[later]))
        # Tokens of both sides that end together: the next ones start together.
        cut_a = from_b["a"].to_numpy()[~later]
        cut_b = from_b["b"].to_numpy()[~later]
        cut_a, cut_b = (np.append(c[1:], n)[:len(c)] for c, n in ((cut_a, len(a_ids)), (cut_b, len(b_ids))))
        return Alignment(a_ids, a_off, b_ids, b_off, link_a, link_b, cut_a, cut_b, np.searchsorted(cut_a, a_off, side="right"))

    def group_texts(self, x: Alignment) -> pa.Array:
        """Per text: ``a1,a2|b1;a3|b2,b3`` in ids ('' without tokens)."""
        def lists(names: pa.Array, ids: np.ndarray, ends: np.ndarray) -> pa.Array:
            cuts = pa.array(np.concatenate(([0], ends)), pa.int32())
            return pc.binary_join(pa.ListArray.from_arrays(cuts, names.take(pa.array(ids))), ",")

        both = pc.binary_join_element_wise(lists(self.name_a, x.a_ids, x.end_a), lists(self.name_b, x.b_ids, x.end_b), "|")
        return pc.binary_join(pa.ListArray.from_arrays(pa.array(x.group_off, pa.int32()), both), ";")


_workers: dict[tuple[str, str], Aligner] = {}


def worker_aligner(path_a: str, path_b: str) -> Aligner:
    """The aligner of this worker process, loaded once and kept."""
    if (path_a, path_b) not in _workers:
        _workers[path_a, path_b] = Aligner(path_a, path_b)
    return _workers[path_a, path_b]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, pa.Array]]:
    for batch in batches:
        for part in text_slices(batch, "text", SLICE_BYTES):
            yield part.column("doc_id"), part.column("text")


def align_documents(docs: DataFrame, path_a: str | None = None, path_b: str | None = None) -> DataFrame:
    """Both sides' ids of every text, the groups as text and all links as
    token numbers (by A, then B token). One map pass."""
    path_a, path_b = path_a or default_paths()[0], path_b or default_paths()[1]
    small_batches(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = worker_aligner(path_a, path_b)
        for doc_id, text in _slices(batches):
            x = own.align(text)
            order = np.lexsort((x.link_b, x.link_a))
            a, b = x.link_a[order], x.link_b[order]
            doc = np.searchsorted(x.a_off, a, side="right") - 1
            links = pa.StructArray.from_arrays([pa.array(a - x.a_off[doc], pa.int32()), pa.array(b - x.b_off[doc], pa.int32())], ["a", "b"])
            yield pa.RecordBatch.from_arrays(
                [doc_id, pa.ListArray.from_arrays(pa.array(x.a_off, pa.int32()), pa.array(x.a_ids, pa.int32())),
                 pa.ListArray.from_arrays(pa.array(x.b_off, pa.int32()), pa.array(x.b_ids, pa.int32())), own.group_texts(x),
                 pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(len(x.a_off))), pa.int32()), links)],
                names=["doc_id", "a_ids", "b_ids", "groups", "links"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(work, TOKENS)


def aligned_blocks(docs: DataFrame, path_a: str, path_b: str, digest: bool) -> DataFrame:
    """One row per block of documents: facts per document, the distinct pairs
    of the block (ascending) with the number of its documents that hold them,
    and each document's distinct pairs as places in that list, with its links
    of each. Numbers in binary columns are little-endian."""
    small_batches(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = worker_aligner(path_a, path_b)
        width = len(own.b.bytes.size)
        pair_space = len(own.a.bytes.size) * width
        block = TaskContext.get().partitionId() << 32
        held: list[tuple[list[pa.Array], np.ndarray, np.ndarray]] = []
        size = 0

        def emit() -> pa.RecordBatch:
            pairs, at = np.unique(np.concatenate([h[1] for h in held]), return_inverse=True)
            links = np.concatenate([h[2] for h in held])
            facts = [pa.concat_arrays([h[0][k] for h in held]) for k in range(len(held[0][0]))]
            rows = [pa.ListArray.from_arrays(pa.array([0, len(f)], pa.int32()), f) for f in facts]
            blobs = [at.astype("<u4"), links.astype("<u4"), pairs.astype("<i8"), np.bincount(at, minlength=len(pairs)).astype("<u4")]
            return pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), *rows, *(pa.array([b.tobytes()], pa.binary()) for b in blobs)],
                names=["block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "n_pairs", "pair_at", "pair_links", "pairs", "pair_docs"])

        for doc_id, text in _slices(batches):
            x = own.align(text)
            doc = np.searchsorted(x.a_off, x.link_a, side="right") - 1
            key, links = np.unique(doc * pair_space + x.a_ids[x.link_a] * width + x.b_ids[x.link_b], return_counts=True)
            n = len(x.a_off) - 1
            groups = own.group_texts(x)
            if digest:
                groups = pa.array(["" if not g else hashlib.sha256(g.encode()).hexdigest() for g in groups.to_pylist()], pa.string())
            facts = [doc_id.cast(pa.int64()), *(pa.array(f, pa.int64()) for f in (np.diff(x.a_off), np.diff(x.b_off), np.diff(x.group_off),
                                                                                 np.bincount(doc, minlength=n))),
                     groups, pa.array(np.bincount(key // pair_space, minlength=n), pa.int64())]
            held.append((facts, key % pair_space, links))
            size += text.nbytes
            if size >= BLOCK_BYTES:
                yield emit()
                block, held, size = block + 1, [], 0
        if held:
            yield emit()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(work, BLOCKS)


def rated_pairs(blocks: DataFrame, width: int) -> DataFrame:
    """Every pair of the corpus: (pair, n documents, best of its A id)."""
    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pairs, docs in zip(batch.column("pairs"), batch.column("pair_docs")):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(pairs.as_py(), "<i8")), pa.array(np.frombuffer(docs.as_py(), "<u4").astype(np.int64))],
                                                 names=["pair", "n"])

    counts = blocks.select("pairs", "pair_docs").mapInArrow(listed, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    counts = staged(counts.withColumn("a", F.expr(f"pair div {width}")), "pair-counts")
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    return counts.join(most, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def alignment_report(docs: DataFrame, path_a: str | None = None, path_b: str | None = None, digest: bool = False) -> DataFrame:
    """Per document: tokens of both sides, groups, links, links whose pair
    count is the highest of their A id, and the sum of pair counts over all
    links; ``groups`` is the groups' text, or its SHA-256 (``digest``)."""
    path_a, path_b = path_a or default_paths()[0], path_b or default_paths()[1]
    blocks = staged(aligned_blocks(docs, path_a, path_b, digest), "aligned-blocks")
    width = len(worker_aligner(path_a, path_b).b.bytes.size)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, pairs in zip(batch.column("block"), batch.column("pairs")):
                own = np.frombuffer(pairs.as_py(), "<i8")
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), block.as_py())), pa.array(own)], names=["block", "pair"])

    back = (blocks.select("block", "pairs").mapInArrow(listed, "block long, pair long")
            .join(rated_pairs(blocks, width), "pair").select("block", "pair", "n", "best"))

    def rate(block: pa.Table, rated: pa.Table) -> pa.Table:
        row = block.to_pylist()[0]
        order = np.argsort(rated.column("pair").to_numpy(), kind="stable")       # the block's own pairs, ascending
        n = rated.column("n").to_numpy()[order]
        best = rated.column("best").to_numpy()[order]
        at, links = np.frombuffer(row["pair_at"], "<u4"), np.frombuffer(row["pair_links"], "<u4").astype(np.int64)
        ends = np.concatenate(([0], np.cumsum(np.array(row["n_pairs"], np.int64))))
        sums = [np.concatenate(([0], np.cumsum(v[at] * links)))[ends] if len(at) else np.zeros(len(ends), np.int64) for v in (best.astype(np.int64), n)]
        return pa.table({"doc_id": pa.array(row["doc_id"], pa.int64()), **{k: pa.array(row[k], pa.int64()) for k in ("n_a", "n_b", "n_groups", "n_links")},
                         "n_best": pa.array(np.diff(sums[0]), pa.int64()), "count_sum": pa.array(np.diff(sums[1]), pa.int64()),
                         "groups": pa.array(row["groups"], pa.string())})

    return (blocks.drop("pairs", "pair_docs").groupBy("block").cogroup(back.groupBy("block")).applyInArrow(rate, REPORT))
