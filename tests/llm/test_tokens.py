import uuid
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from fleetscope.config import scratch_path
from fleetscope.llm.packing import best_two_fit, pack_documents
from fleetscope.llm.token_files import decode_values, encode_values, read_token_files, write_token_files
from fleetscope.llm.tokens import WordTokenizer, default_vocabulary


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(default_vocabulary())


@pytest.fixture(scope="module")
def words():
    return WordTokenizer(default_vocabulary(), cache_words=500)


def whole(plain, text):
    return plain.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=150, deadline=None)
@given(texts=st.lists(st.one_of(st.none(), st.text(max_size=60), st.text(alphabet="aB é'sß̱́\x85\x1c\t\n<|>endofttx,.1", max_size=60)), max_size=6))
def test_word_ids_equal_whole_text_ids(plain, words, texts):
    offsets, ids = words.encode(pa.array(texts, pa.string()))
    assert [ids[a:b].tolist() for a, b in zip(offsets[:-1], offsets[1:])] == [whole(plain, t) for t in texts]


@given(values=st.lists(st.integers(0, 65535), max_size=300))
def test_coding_round_trip_16(values):
    v = np.array(values, np.uint32)
    control, data = encode_values(v, 1)
    assert decode_values(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), len(v), 1).tolist() == values


@given(values=st.lists(st.integers(0, 2 ** 32 - 1), max_size=300))
def test_coding_round_trip_32(values):
    v = np.array(values, np.uint32)
    control, data = encode_values(v, 2)
    assert decode_values(np.frombuffer(control, np.uint8), np.frombuffer(data, np.uint8), len(v), 2).tolist() == values


@pytest.mark.parametrize("block", [50, 1_000_000])
def test_token_files_hold_all_documents(spark, sf, odd_docs, plain, block):
    for docs in (spark.read.parquet(f"{sf}/documents.parquet"), odd_docs):
        folder = scratch_path(spark, f"test-tokens-{block}-{uuid.uuid4().hex}")
        write_token_files(docs, folder, block_values=block)
        got = read_token_files(spark, folder).collect()
        want = [(r["doc_id"], whole(plain, r["text"]) + [2]) for r in docs.collect()]
        ids = lambda r: np.frombuffer(r["ids"], "<u4").tolist()
        key = lambda d: (d is not None, d or 0)
        assert sorted(((r["doc_id"], ids(r)) for r in got), key=lambda x: (key(x[0]), x[1])) == sorted(want, key=lambda x: (key(x[0]), x[1]))
        at, last = 0, None
        for r in sorted(got, key=lambda r: r["start"]):
            assert r["start"] == at and r["n_tokens"] == len(r["ids"]) // 4
            assert last is None or key(last) <= key(r["doc_id"])
            at, last = at + r["n_tokens"], r["doc_id"]


def test_token_files_of_an_empty_table(spark, no_docs):
    folder = scratch_path(spark, f"test-tokens-empty-{uuid.uuid4().hex}")
    write_token_files(no_docs, folder)
    assert read_token_files(spark, folder).count() == 0


@settings(max_examples=60, deadline=None)
@given(sizes=st.lists(st.integers(1, 64), max_size=120))
def test_bins_hold_every_piece_once(sizes):
    bins = best_two_fit(np.array(sizes, np.int64), 64)
    assert sorted(s for b in bins for s in b) == sorted(sizes) and all(0 < sum(b) <= 64 for b in bins)
    assert len(bins) <= 1 + (11 * -(-sum(sizes) // 64)) // 9 + len([s for s in sizes if s > 32])


def test_two_pieces_replace_the_smallest():
    # Greedy alone takes 6 and 3; 6 with 2 + 2 fills the bin.
    assert sorted(map(sorted, best_two_fit(np.array([6, 3, 2, 2]), 10))) == [[2, 2, 6], [3]]


def test_packing_places_every_token(spark, sf, odd_docs, no_docs, plain):
    for docs in (spark.read.parquet(f"{sf}/documents.parquet"), odd_docs):
        got = pack_documents(docs).collect()
        want = sorted(zlib.crc32(np.array(whole(plain, r["text"]) + [1], "<u4").tobytes()) for r in docs.collect())
        by_doc, by_sequence = defaultdict(list), defaultdict(list)
        for r in got:
            assert len(r["ids"]) == 4 * r["length"] and r["start"] == 4096 * r["piece"]
            by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
            by_doc[r["doc_id"]].append(r)
        for rows in by_sequence.values():
            at = 0
            for offset, length in sorted(rows):
                assert offset == at
                at += length
            assert at <= 4096
        if docs is not odd_docs:
            assert sorted(zlib.crc32(b"".join(r["ids"] for r in sorted(rows, key=lambda r: r["piece"]))) for rows in by_doc.values()) == want
            total = sum(r["length"] for r in got)
            assert len(by_sequence) <= -(-total // 4096) + 1
        else:
            assert sum(r["length"] for r in got) == sum(len(whole(plain, r["text"])) + 1 for r in docs.collect())
    assert pack_documents(no_docs).count() == 0
