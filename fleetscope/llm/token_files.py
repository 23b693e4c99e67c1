"""Token files: frequency-ranked ids in byte-aligned variable-length coding.

Ids are replaced by their rank (the most frequent id is 0), so most take one
byte. Widths stand apart from the data: control bytes first, then the data
bytes. With up to 65,536 ranks a control bit tells one byte from two (eight
values per control byte); beyond that two control bits tell one to four bytes
(four values per control byte). Both are decoded by a numpy table that maps a
control byte to its widths.

A file holds a block of whole documents in ascending id order::

    b"RVB1" | u8 control bits | 3 zero bytes | u32 documents | u64 values
    u64 values before this block in its part
    i64 doc ids | u8 null-id marks | u32 values per document
    control bytes | data bytes

Beside the files lie two Parquet tables: ``ranks`` (rank, id) and ``index``
(part, block, file, documents, values).

Writing: documents are range partitioned by id (one shuffle of the texts) and
tokenised once, in order, into staged blocks; the ranks come from counts over
all staged blocks; then each block becomes one file in a map pass. A file is
written under a name of its task attempt and renamed, so a lost or repeated
task leaves whole files only.

Defined cases: null ids come first; documents of one id (repeated rows) follow
each other in the order of a hash of the text; a null or empty text is the end
id alone; an empty table gives no file; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetscope.config import scratch_path
from fleetscope.llm.common import small_batches, text_slices
from fleetscope.llm.tokens import default_vocabulary, worker_tokenizer

MAGIC = b"RVB1"
# Values per block at most, unless one document alone has more.
BLOCK_VALUES = 1_000_000


def _widths(bits: int) -> tuple[np.ndarray, int]:
    """Widths per control byte (256 rows) and values per control byte."""
    per = 8 // bits
    codes = (np.arange(256)[:, None] >> (bits * np.arange(per))) & ((1 << bits) - 1)
    return (codes + 1).astype(np.int64), per


def encode_values(values: np.ndarray, bits: int) -> tuple[bytes, bytes]:
    """Control bytes and data bytes of unsigned values."""
    per = 8 // bits
    values = np.ascontiguousarray(values, "<u4")
    width = 1 + (values >= 1 << 8).astype(np.int64)
    if bits == 2:
        width += (values >= 1 << 16).astype(np.int64) + (values >= 1 << 24).astype(np.int64)
    padded = np.zeros(-(-len(values) // per) * per, np.int64)
    padded[:len(values)] = width - 1
    control = (padded.reshape(-1, per) << (bits * np.arange(per))).sum(axis=1).astype(np.uint8)
    lanes = values.view(np.uint8).reshape(-1, 4)
    return control.tobytes(), lanes[np.arange(4) < width[:, None]].tobytes()


def decode_values(control: np.ndarray, data: np.ndarray, n: int, bits: int) -> np.ndarray:
    """Inverse of ``encode_values``: widths by table, then one gather per byte."""
    table, _ = _widths(bits)
    width = table[control].reshape(-1)[:n]
    first = np.cumsum(width) - width
    out = np.zeros(n, np.uint32)
    for k in range(1 << bits):
        has = width > k
        out[has] |= data[first[has] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def file_bytes(doc_ids: list[int | None], lengths: np.ndarray, values: np.ndarray, before: int, bits: int) -> bytes:
    control, data = encode_values(values, bits)
    null = np.array([d is None for d in doc_ids], np.uint8)
    ids = np.array([0 if d is None else d for d in doc_ids], "<i8")
    head = MAGIC + bytes([bits, 0, 0, 0]) + np.uint32(len(ids)).tobytes() + np.uint64(len(values)).tobytes() + np.uint64(before).tobytes()
    return head + ids.tobytes() + null.tobytes() + lengths.astype("<u4").tobytes() + control + data


def parse_file(content: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, int]:
    """Doc ids, null marks, lengths, ranks and values before of one file."""
    if content[:4] != MAGIC:
        raise ValueError("not a token file")
    bits = content[4]
    n, (total, before) = int(np.frombuffer(content, "<u4", 1, 8)[0]), np.frombuffer(content, "<u8", 2, 12).tolist()
    at = 28
    ids = np.frombuffer(content, "<i8", n, at)
    null = np.frombuffer(content, np.uint8, n, at + 8 * n)
    lengths = np.frombuffer(content, "<u4", n, at + 9 * n).astype(np.int64)
    at += 13 * n
    n_control = -(-total // (8 // bits))
    control = np.frombuffer(content, np.uint8, n_control, at)
    data = np.frombuffer(content, np.uint8, -1, at + n_control)
    return ids, null, lengths, decode_values(control, data, total, bits), before


def stage_blocks(docs: DataFrame, vocabulary: str, end_id: int, block_values: int) -> DataFrame:
    """Blocks of whole documents in id order; ``before`` counts the values of
    the blocks before it in its part."""
    small_batches(docs.sparkSession)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok = worker_tokenizer(vocabulary)
        kind = np.dtype("<u2") if max(tok.vocabulary_size(), end_id + 1) <= 1 << 16 else np.dtype("<u4")
        part = TaskContext.get().partitionId()
        block, before, held, size = 0, 0, [], 0

        def emit() -> pa.RecordBatch:
            ids = np.concatenate([h[2] for h in held])
            lengths = np.concatenate([h[1] for h in held]).astype("<u4")
            names = [x for h in held for x in h[0]]
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([before], pa.int64()), pa.array([names], pa.list_(pa.int64())),
                 pa.array([lengths.tobytes()]), pa.array([ids.astype(kind).tobytes()])],
                names=["part", "block", "before", "doc_ids", "lengths", "ids"])

        for batch in batches:
            for piece in text_slices(batch, "text", min(1 << 22, 4 * block_values)):
                offsets, flat = tok.encode(piece.column("text"))
                n = np.diff(offsets) + 1
                ids = np.insert(flat, offsets[1:], end_id)
                total = np.concatenate(([0], np.cumsum(n)))
                names, row = piece.column("doc_id").to_pylist(), 0
                while row < len(n):
                    end = int(np.searchsorted(total, total[row] + block_values - size, side="right")) - 1
                    if end <= row and not held:
                        end = row + 1
                    if end > row:
                        held.append((names[row:end], n[row:end], ids[total[row]:total[end]]))
                        size += int(total[end] - total[row])
                        row = end
                    if row < len(n):
                        yield emit()
                        block, before, held, size = block + 1, before + size, [], 0
        if held:
            yield emit()

    ordered = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange("doc_id")
    ordered = ordered.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), "text")
    return ordered.mapInArrow(work, "part int, block int, before long, doc_ids array<long>, lengths binary, ids binary")


def count_ids(blocks: DataFrame, vocabulary_size: int) -> np.ndarray:
    """How often each id occurs in all blocks (the vocabulary bounds it)."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(vocabulary_size, np.int64)
        for batch in batches:
            for blob in batch.column("ids"):
                raw = blob.as_py()
                count += np.bincount(np.frombuffer(raw, "<u2" if vocabulary_size <= 1 << 16 else "<u4"), minlength=vocabulary_size)
        at = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(count[at], pa.int64())], names=["id", "n"])

    total = np.zeros(vocabulary_size, np.int64)
    rows = blocks.select("ids").mapInArrow(work, "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).toArrow()
    total[rows.column("id").to_numpy()] = rows.column("n").to_numpy()
    return total


def write_token_files(docs: DataFrame, folder: str, vocabulary: str | None = None, end_id: int = 2,
                      block_values: int = BLOCK_VALUES) -> None:
    """Write ``docs`` as token files, ``ranks`` and ``index`` under ``folder``
    (a URI that the executors share and pyarrow can open)."""
    spark = docs.sparkSession
    vocabulary = vocabulary or default_vocabulary()
    size = max(worker_tokenizer(vocabulary).vocabulary_size(), end_id + 1)
    store, base = pafs.FileSystem.from_uri(folder)
    store.create_dir(f"{base}/files", recursive=True)
    stage_path = scratch_path(spark, f"token-blocks-{uuid.uuid4().hex}")
    stage_blocks(docs, vocabulary, end_id, block_values).write.option("compression", "zstd").parquet(stage_path)
    blocks = spark.read.parquet(stage_path)
    by_rank = np.argsort(-count_ids(blocks, size), kind="stable").astype(np.int64)
    rank = np.empty(size, "<u4")
    rank[by_rank] = np.arange(size, dtype="<u4")
    bits = 1 if size <= 1 << 16 else 2
    narrow = "<u2" if size <= 1 << 16 else "<u4"
    spark.createDataFrame(pa.table({"rank": pa.array(np.arange(size), pa.int64()), "id": pa.array(by_rank)})).coalesce(1).write.parquet(f"{folder}/ranks")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = pafs.FileSystem.from_uri(folder)
        attempt = TaskContext.get().taskAttemptId()
        for batch in batches:
            for i in range(batch.num_rows):
                part, block = batch.column("part")[i].as_py(), batch.column("block")[i].as_py()
                lengths = np.frombuffer(batch.column("lengths")[i].as_py(), "<u4")
                values = rank[np.frombuffer(batch.column("ids")[i].as_py(), narrow)]
                name = f"part-{part:06d}-{block:06d}.rvb"
                with store.open_output_stream(f"{base}/files/_{name}.{attempt}") as out:
                    out.write(file_bytes(batch.column("doc_ids")[i].as_py(), lengths, values, batch.column("before")[i].as_py(), bits))
                store.move(f"{base}/files/_{name}.{attempt}", f"{base}/files/{name}")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([part], pa.int32()), pa.array([block], pa.int32()), pa.array([name]),
                     pa.array([len(lengths)], pa.int64()), pa.array([len(values)], pa.int64())],
                    names=["part", "block", "file", "documents", "values"])

    blocks.mapInArrow(work, "part int, block int, file string, documents long, values long").write.parquet(f"{folder}/index")


def part_starts(index: DataFrame) -> DataFrame:
    """Tokens before each part: one row per partition of the write."""
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return (index.groupBy("part").agg(F.sum("values").alias("total"))
            .select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("part_start")))


def read_token_files(spark: SparkSession, folder: str) -> DataFrame:
    """Documents read back: (doc_id, start, n_tokens, ids); ``ids`` are
    little-endian unsigned 32-bit integers in a binary column."""
    ranks = spark.read.parquet(f"{folder}/ranks").orderBy("rank").toArrow()
    by_rank = ranks.column("id").to_numpy().astype("<u4")
    # Broadcast: as many rows as the write had partitions, never more.
    starts = F.broadcast(part_starts(spark.read.parquet(f"{folder}/index")))
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "part-*.rvb").load(f"{folder}/files")
             .select(F.regexp_extract("path", r"part-(\d+)-\d+\.rvb$", 1).cast("int").alias("part"), "content"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                doc, null, n, values, before = parse_file(batch.column("content")[i].as_py())
                ids = by_rank[values]
                ends = np.cumsum(n)
                first = batch.column("part_start")[i].as_py() + before
                at = np.concatenate(([0], ends)) * 4
                blob = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(n), [None, pa.py_buffer(at.astype(np.int64)), pa.py_buffer(ids)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc, pa.int64(), mask=null.astype(bool)), pa.array(first + ends - n, pa.int64()),
                     pa.array(n, pa.int64()), blob.cast(pa.binary())],
                    names=["doc_id", "start", "n_tokens", "ids"])

    return files.join(starts, "part").mapInArrow(work, "doc_id long, start long, n_tokens long, ids binary")
