import hashlib
import zlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fleetscope.llm.oracles import ORACLES
from fleetscope.llm.periodic_runs import periodic_runs, runs_of_texts, split_segments
from fleetscope.llm.queries import op11_periodic_runs


def brute_runs(words, min_length=6, min_exponent=4):
    """Every maximal stretch at every lag, smallest period kept."""
    best = {}
    n = len(words)
    for q in range(1, n // min_exponent + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(min_length, min_exponent * q):
                best.setdefault((i, length), q)
            i = j
    return sorted((s, k, q) for (s, k), q in best.items())


def brute_words(text):
    return "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text or "").replace(" ", "\x00 ").replace("\x00", "").split(" ")


def brute_row(doc_id, text):
    words = [w for w in brute_words(text) if w]
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = brute_runs(words)
    dropped = {i for s, k, q in runs for i in range(s + q, s + k)}
    top = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(runs), *((top[0], top[1], top[2], 1000 * top[1] // top[2]) if top else (None,) * 4),
            sha("".join(f"{s},{k},{q}\n" for s, k, q in runs)), sha(" ".join(w for i, w in enumerate(words) if i not in dropped)))


def found_runs(texts, **more):
    codes = np.array([c for t in texts for c in t], np.int64)
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    out = [[] for _ in texts]
    for t, s, k, q in runs_of_texts(offsets, codes, **more).tolist():
        out[t].append((s, k, q))
    return out


block = st.lists(st.integers(0, 3), min_size=1, max_size=6)
text = st.lists(st.tuples(block, st.integers(1, 9)), max_size=7).map(lambda parts: [c for b, k in parts for c in b * k])


@settings(max_examples=300, deadline=None)
@given(texts=st.lists(text, max_size=4))
def test_runs_equal_every_lag(texts):
    assert found_runs(texts) == [brute_runs(t) for t in texts]


@settings(max_examples=100, deadline=None)
@given(texts=st.lists(text, max_size=3), length=st.integers(1, 12), exponent=st.integers(3, 6), rounds=st.integers(0, 3))
def test_other_limits_and_cut_off_splitting_change_nothing(texts, length, exponent, rounds):
    got = found_runs(texts, min_length=length, min_exponent=exponent, max_rounds=rounds)
    assert got == [brute_runs(t, length, exponent) for t in texts]


def test_splitting_leaves_only_frequent_words():
    codes = np.array([1, 2, 3, 1, 2, 3, 9, 7, 7, 7, 7, 7, 7, 4, 1, 2, 1, 2, 1, 2, 1, 2], np.int64)
    s, e = split_segments(codes, np.array([0]), np.array([len(codes)]), 6, 4, 64)
    assert sorted(zip(s.tolist(), e.tolist())) == [(7, 13), (14, 22)]


def test_one_very_long_periodic_text_needs_no_quadratic_time():
    period = np.arange(997)
    assert found_runs([np.tile(period, 300).tolist(), [5] * 200_000]) == [[(0, 299_100, 997)], [(0, 200_000, 1)]]


def key(row):
    return (row[0] is not None, row[0] or 0, row[-1], row[-2])


def test_query_equals_brute_force(spark, sf):
    want = [brute_row(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert sorted(map(tuple, op11_periodic_runs(spark, sf).collect()), key=key) == sorted(want, key=key)
    assert sum(r[1] for r in want) > 10


def test_query_equals_sql(spark, sf):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf}/documents.parquet'")
    want = con.execute(ORACLES["op11_periodic_runs"])
    names = [d[0] for d in want.description]
    got = [tuple(r[n] for n in names) for r in op11_periodic_runs(spark, sf).collect()]
    assert sorted(got) == sorted(want.fetchall())


def test_odd_rows(spark, odd_docs, no_docs):
    got = periodic_runs(odd_docs).collect()
    assert len(got) == odd_docs.count()
    by_text = {r["text"]: r for r in got}
    assert (by_text[None]["n_words"], by_text[None]["runs"], by_text[None]["collapsed"]) == (0, [], "")
    assert by_text[""]["collapsed"] == by_text[" \t\n "]["collapsed"] == ""
    long = by_text["word " * 30000]
    assert [tuple(r) for r in long["runs"]] == [(0, 30000, 1)] and long["collapsed"] == "word"
    assert by_text["A\x00b \x85c\x1cd"]["n_words"] == 2 and by_text["A\x00b \x85c\x1cd"]["collapsed"] == "A\x00b \x85c\x1cd"
    assert by_text["a"]["score"] == 1.5                      # other columns pass, those named like results are replaced
    assert periodic_runs(no_docs).count() == 0


def test_overlapping_runs_drop_what_any_of_them_repeats(spark):
    words = "a b a b a b a b b b b b b c".split()
    r = periodic_runs(spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")).first()
    runs = [tuple(x) for x in r["runs"]]
    assert runs == brute_runs(words) == [(0, 8, 2), (7, 6, 1)]
    assert r["collapsed"] == "a b c"


def test_exponent_below_three_is_refused(spark, odd_docs):
    with pytest.raises(ValueError):
        periodic_runs(odd_docs, min_exponent=2)
