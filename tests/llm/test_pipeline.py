"""The whole pipeline against a brute-force version on a small table."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as cp
from fleetscope.config import scratch_path
from fleetscope.llm.tokens import default_vocabulary

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def fixture_texts():
    """(doc_id, text, source): clean texts, copies, near copies, junk, entities."""
    rng = random.Random(11)
    vocabulary = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(3, 9))) for _ in range(3000)]
    clean = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(25, 900))) for _ in range(36)]
    rows = [(i, t, ("a", "b", None)[i % 3 if i < 12 else 0]) for i, t in enumerate(clean)]
    rows += [(100 + i, clean[i], "b") for i in (1, 1, 2)]                                    # exact copies
    rows += [(200 + i, " ".join([*clean[i].split()[:-1], "changedword"]), None) for i in (4, 5)]   # near copies
    rows += [(300, "too short", "a"), (301, "", "a"), (302, None, None)]
    rows += [(303, "the very same line of words comes here\n" * 40, "b")]                    # repeated lines
    rows += [(400 + i, f"{clean[i][::-1]} write to user{i}@mail.example.com today", "b") for i in range(12, 18)]
    return rows


def ngrams(text):
    w = text.split()
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))}


def brute_groups(rows):
    """Smallest id of each group of texts with an index of 0.8 or more."""
    root = {d: d for d, *_ in rows}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    sets = [(d, ngrams(t)) for d, t, _ in rows]
    for i, (d, x) in enumerate(sets):
        for e, y in sets[i + 1:]:
            if len(x & y) >= 0.8 * len(x | y):
                a, b = sorted((find(d), find(e)))
                root[b] = a
    return {find(d) for d in root}


def brute_copies(rows):
    """How often the mix takes each document's first word."""
    by_source = defaultdict(list)
    for d, t, s in rows:
        key = hashlib.md5(f"mix-{d}-{hashlib.md5(t.encode()).hexdigest()}".encode()).hexdigest()
        by_source[s].append((key, d, len(t.split())))
    names = sorted(by_source, key=lambda s: (s is None, s or ""))
    size = {s: sum(n for *_, n in by_source[s]) for s in names}
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, free = {}, set(names)
    while free:
        level = (1.5 * sum(size.values()) - sum(target.values())) / sum(weight[s] for s in free)
        over = [s for s in free if weight[s] * level > 2 * size[s]]
        for s in over or list(free):
            target[s] = 2 * size[s] if over else weight[s] * level
            free.discard(s)
    copies = {}
    for s in names:
        goal, at = int(target[s] + 0.5), 0
        for _, d, n in sorted(by_source[s]):
            copies[d] = goal // size[s] + (at < goal % size[s])
            at += n
    return copies


@pytest.fixture(scope="module")
def folder(spark):
    path = scratch_path(spark, "test-pipeline")
    rows = [(d, t, "en", s, len(t or "")) for d, t, s in fixture_texts()]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.mode("overwrite").parquet(f"{path}/documents.parquet")
    return path


def test_pipeline_equals_brute_force(spark, folder):
    rows = [(d, t, s) for d, t, s in fixture_texts() if t and len(t.split()) >= 20 and d != 303]
    left = brute_groups(rows)
    # Rows of one id are one document; exact copies of a text are its group.
    kept = sorted({(d, t, s) for d, t, s in rows if d in left}, key=lambda r: r[0])
    assert len(kept) == 42 and not left & {101, 102, 204, 205}

    changed = cp.hide_entities(spark, spark.createDataFrame([(d, t, "en", s, len(t)) for d, t, s in kept], SCHEMA), folder)
    assert changed.columns == cp.COLUMNS
    changed = [(r["doc_id"], r["text"], r["source"]) for r in changed.collect()]
    before = {d: t for d, t, _ in kept}
    assert all((t == before[d]) == (d < 400) and "@mail.example.com" not in t for d, t, _ in changed)

    plain = Tokenizer.from_file(default_vocabulary())
    copies = brute_copies(changed)
    want = Counter()
    for d, t, _ in changed:
        ids = plain.encode(t, add_special_tokens=False).ids + [1]
        for p in range(0, len(ids), 4096):
            piece = ids[p:p + 4096]
            want[d, p // 4096, p, len(piece), zlib.crc32(np.array(piece, "<u4").tobytes())] += copies[d]
    got = cp.run(spark, folder).collect()
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], zlib.crc32(r["ids"])) for r in got) == +want

    places = defaultdict(list)
    for r in got:
        places[r["sequence_id"]].append((r["offset"], r["length"]))
    for rows in places.values():
        at = 0
        for offset, length in sorted(rows):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(places) <= -(-sum(r["length"] for r in got) // 4096) + 1


def test_stages(spark, odd_docs, no_docs):
    assert [n for n, _ in cp.STAGES] == ["quality_rules", "ngram_jaccard_join", "pii_surrogates", "mix_sources", "best_fit_packing"]
    for docs in (odd_docs, no_docs):
        for name, stage in cp.STAGES:
            out = stage(spark, docs, "")
            if name != "best_fit_packing":
                assert set(cp.COLUMNS) <= set(out.columns), name
            assert out.count() >= 0


def test_one_row_of_each_group_by_text_not_by_id(spark, odd_docs):
    def kept(rows):
        return Counter((r["doc_id"], r["text"]) for r in cp.keep_one_of_group(spark, rows, "").collect())

    a, word = "one two three four five six seven", "word " * 30000
    want = Counter([(1, a), (2, None), (3, ""), (None, "null id here"), (4, " \t\n "), (5, word), (6, "é ü ß ñ 日本語 <|endoftext|> x"),
                    (7, "another text under the same id"), (8, "a"), (9, "A\x00b \x85c\x1cd")])
    assert kept(odd_docs) == want == kept(odd_docs.orderBy(F.desc("n_words")).repartition(3))

    # Unlinked texts of one id, near copies without ids, a near copy of a named row.
    long = " ".join(f"w{i}" for i in range(200))
    near = [long + " x", long + " y"]
    rows = [(1, "p q r s t u v"), (1, "some wholly other words stand here"), (None, near[0]), (None, near[1]), (None, "k l m n o p"),
            (None, "k l m n o p"), (3, "k l m n o p"), (None, None), (None, ""), (5, None), (5, "five words of its own id")]
    df = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], SCHEMA)
    got = kept(df)
    assert sum(n for (_, t), n in got.items() if t in near) == 1 and sum(n for (d, t), n in got.items() if d is None and not t) == 1
    assert Counter({k: n for k, n in got.items() if k[0] is not None}) == Counter([*rows[:2], (3, "k l m n o p"), (5, None), (5, rows[10][1])])
    assert sum(got.values()) == 7 and kept(df.repartition(4)) == got
