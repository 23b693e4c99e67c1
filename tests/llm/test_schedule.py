import re
from collections import defaultdict

from fleetscope.llm import schedule as sc


def wanted(size_of):
    """Targets by resharing round after round."""
    names = sorted(size_of, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, target, free = 1.5 * sum(size_of.values()), {}, set(names)
    while free:
        left = total - sum(target.values())
        w = sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / w > 2 * size_of[s]]
        if not over:
            target.update({s: left * weight[s] / w for s in free})
            break
        for s in over:
            target[s] = 2.0 * size_of[s]
            free.discard(s)
    return target


def hold(docs, block):
    rows = sc.mix_report(docs, block_words=block).collect()
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sorted((r["size"] for r in rows)) == sorted(size(r["text"]) for r in docs.collect())
    size_of, taken, target = defaultdict(int), defaultdict(int), {}
    for r in rows:
        size_of[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    goal = wanted(size_of)
    for s in size_of:
        assert all(r["source_size"] == size_of[s] for r in rows if r["source"] == s)
        assert abs(target[s] - goal[s]) < 1e-6 * (1 + goal[s])
        assert abs(taken[s] - goal[s]) <= 0.5001
    return rows


def test_targets_are_met_to_the_word(spark, sf, odd_docs):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    key = lambda r: (r["doc_id"], r["taken"])
    assert sorted(map(key, hold(docs, 64))) == sorted(map(key, hold(docs.repartition(5), 64)))
    hold(docs, sc.BLOCK_WORDS)
    hold(odd_docs, 100)


def test_schedule_is_even_along_its_length(spark, sf):
    sizes = sc.sized(spark.read.parquet(f"{sf}/documents.parquet"))
    targets = sc.source_targets(sizes)
    rows = sc.slots(targets, 16).collect()
    n, need = len(rows), defaultdict(int)
    for r in rows:
        need[r["sid"]] += 1
    assert sorted(r["slot"] for r in rows) == sorted(set(r["slot"] for r in rows))
    for part in (n // 4, n // 2):
        got = defaultdict(int)
        for r in rows:
            if r["slot"] < part:
                got[r["sid"]] += 1
        assert all(abs(got[s] - part * need[s] / n) <= 8 for s in need)


def test_mixed_documents(spark, sf, odd_docs, no_docs):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    mixed = sc.mixed_documents(docs, 64)
    assert mixed.columns == docs.columns
    sizes = {r["doc_id"]: r for r in sc.mix_report(docs, 64).collect()}
    copies = defaultdict(int)
    for r in mixed.collect():
        copies[r["doc_id"]] += 1
    assert max(copies.values()) <= 2
    for s in {r["source"] for r in sizes.values()}:
        own = [r for r in sizes.values() if r["source"] == s]
        assert abs(sum(copies[r["doc_id"]] * r["size"] for r in own) - own[0]["target"]) <= 2 * max(r["size"] for r in own) + 64
    assert sc.mixed_documents(odd_docs, 64).count() > 0
    assert sc.mix_report(no_docs).count() == 0 and sc.mixed_documents(no_docs).count() == 0


def golden_slots(need):
    """Slots by the points themselves: (slot, source index, rank)."""
    total, out, given = sum(need), [], [0] * len(need)
    edges, low = [], 0
    for i, n in enumerate(need):
        edges.append((low / total, 1.0 if low + n == total else (low + n) / total))
        low += n
    for slot in range(total):
        u = (slot + 0.5) * sc.GOLDEN % 1.0
        i = next(i for i, (a, b) in enumerate(edges) if a <= u < b)
        if given[i] < need[i]:
            out.append((slot, i, given[i]))
        given[i] += 1
    late = sorted((r, i) for i, n in enumerate(need) for r in range(given[i], n))
    return out + [(total + k, i, r) for k, (r, i) in enumerate(late)]


def test_documents_get_the_slots_of_the_golden_points(spark, sf):
    """first_slot and n_slots follow from the points, block by block."""
    docs, block = spark.read.parquet(f"{sf}/documents.parquet"), 64
    rows = sc.mix_report(docs, block_words=block).collect()
    targets = {r["sid"]: r for r in sc.source_targets(sc.sized(docs)).collect()}
    plan = {}
    for sid, t in targets.items():
        goal, size = min(round(t["target"]), 2 * t["source_size"]), t["source_size"]
        if goal:
            rest, blocks = goal % size, -(-size // block)
            plan[sid] = (blocks, rest, goal // size * blocks + -(-rest // block))
    sids = sorted(plan)
    takes = defaultdict(list)
    for slot, i, rank in golden_slots([plan[s][2] for s in sids]):
        blocks, rest, need = plan[sids[i]]
        use = rest - (rest - 1) // block * block if rest and rank == need - 1 else block
        takes[sids[i], rank % blocks].append((slot, use))
    tape = sorted((r for r in sc.tapes(sc.sized(docs), sc.source_targets(sc.sized(docs))).collect() if r["size"]), key=lambda r: (r["sid"], r["pos"]))
    want = []
    for r in tape:
        got = [slot for b in range(r["pos"] // block, (r["pos"] + r["size"] - 1) // block + 1)
               for slot, use in takes[r["sid"], b] if min(r["pos"] + r["size"], b * block + use) > max(r["pos"], b * block)]
        want.append((r["doc_id"], min(got, default=None), len(got)))
    assert sorted(map(str, want)) == sorted(str((r["doc_id"], r["first_slot"], r["n_slots"])) for r in rows if r["size"])
    assert all(r["first_slot"] is None and r["n_slots"] == 0 for r in rows if not r["size"])


def test_many_sources(spark):
    """10,000 sources of their own, one of them with a third of all words."""
    n = 10_000
    docs = spark.sql(f"SELECT id AS doc_id, repeat('w ', IF(id = 5, {n * 5}, 10)) AS text, printf('host%05d', id) AS source FROM range({n})")
    rows = sc.mix_report(docs, block_words=64).collect()
    goal = wanted({r["source"]: r["size"] for r in rows})
    assert len(rows) == n and all(abs(r["taken"] - goal[r["source"]]) <= 0.5001 for r in rows)
    assert all((r["n_slots"] == 0) == (r["taken"] == 0) for r in rows)
    firsts = [r["first_slot"] for r in rows if r["n_slots"] == 1]
    assert len(set(firsts)) == len(firsts)
