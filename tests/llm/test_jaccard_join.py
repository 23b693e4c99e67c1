import re
from collections import defaultdict

import pytest

from fleetscope.llm import jaccard_join as jj
from fleetscope.llm.components import connected_components


def grams(text, n=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    return frozenset(tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))) if w else frozenset()


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def brute(rows):
    sets = {r["doc_id"]: grams(r["text"]) for r in rows}
    where = defaultdict(list)
    for d, s in sets.items():
        for g in s:
            where[g].append(d)
    pairs = set()
    for d, s in sets.items():
        near = defaultdict(int)
        for g in s:
            for e in where[g]:
                near[e] += 1
        pairs |= {(d, e) for e, n in near.items() if e != d and n >= 0.8 * (len(s) + len(sets[e]) - n)}
    return sets, pairs, components(sets, pairs)


def hold(got, rows):
    sets, pairs, group = brute(rows)
    degree = defaultdict(int)
    for a, _ in pairs:
        degree[a] += 1
    first = {}
    for d in sorted(sets):
        first.setdefault(sets[d] or d, d)
    assert {r["doc_id"]: (r["n_links"], r["component_id"], r["kept"], r["class_id"]) for r in got} == {
        d: (degree[d], group[d], group[d] == d, first[sets[d] or d]) for d in sets}


def test_equals_brute_force(spark, sf):
    docs = spark.read.parquet(sf.replace("0.001", "0.01") + "/documents.parquet")
    hold(jj.jaccard_join(docs).collect(), docs.collect())


def test_large_groups_are_cut_into_tiles(spark, monkeypatch):
    monkeypatch.setattr(jj, "TILE", 16)
    base = [f"w{i}" for i in range(100)]
    rows = [(k, " ".join(base[:40] + [f"x{k}"] + base[41:])) for k in range(70)] + [(100 + k, " ".join(base)) for k in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    hold(jj.jaccard_join(docs).collect(), docs.collect())


def test_odd_rows(odd_docs, no_docs):
    rows = jj.jaccard_join(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    by = defaultdict(list)
    for r in rows:
        by[r["doc_id"]].append(r)
    assert {r["component_id"] for r in by[1]} == {1} and by[1][0]["n_links"] == 2        # its copy, and document 7's
    assert by[2][0]["n_links"] == 0 and by[2][0]["kept"] and by[3][0]["kept"] and by[4][0]["kept"]
    assert len({r["component_id"] for r in by[None]}) == 1 and by[None][0]["n_links"] == 1
    assert jj.jaccard_join(no_docs).count() == 0


def test_bands_reach_the_recall():
    b = jj.bands_for()
    assert 1 - (1 - 0.8 ** jj.ROWS) ** b >= jj.RECALL


@pytest.mark.parametrize("links", [[], [(1, 2)], [(i, i + 1) for i in range(60)], [(0, i) for i in range(1, 50)] + [(100, 101), (101, 102), (7, 7)],
                                   [(2 * i, 2 * i + 2) for i in range(20)] + [(2 * i + 1, 2 * i + 3) for i in range(20)]])
def test_components(spark, links):
    df = spark.createDataFrame(links + [(None, 3)], "a long, b long")
    nodes = {x for p in links if p[0] != p[1] for x in p}
    assert {r["node"]: r["component"] for r in connected_components(df).collect()} == components(nodes, [p for p in links if p[0] != p[1]])
