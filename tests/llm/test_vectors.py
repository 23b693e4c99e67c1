import numpy as np

from fleetscope.llm import projections as pj
from tests.llm.test_jaccard_join import components


def brute(ids, x):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = u @ u.T >= 0.9
    np.fill_diagonal(near, False)
    links = [(int(ids[a]), int(ids[b])) for a, b in zip(*np.nonzero(near))]
    group = components([int(i) for i in ids], links)
    return {int(i): (int(n), group[int(i)], group[int(i)] == int(i)) for i, n in zip(ids, near.sum(1))}


def made(n=300, d=32, seed=4):
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((n, d))
    hub = rng.standard_normal(d)
    x[:120] = hub + 0.15 * rng.standard_normal((120, d))             # one large near group
    x[120:140] = x[0]                                                  # copies
    for k in range(140, 200, 2):                                       # pairs around the threshold
        noise = rng.standard_normal(d)
        x[k + 1] = x[k] + noise * np.linalg.norm(x[k]) / np.linalg.norm(noise) * (0.3 + 0.01 * (k - 140) / 2)
    return np.arange(n) * 3, x


def test_equals_brute_force(spark, monkeypatch):
    ids, x = made()
    monkeypatch.setattr(pj, "HOT", 20)
    monkeypatch.setattr(pj, "TILE", 16)
    df = spark.createDataFrame([(int(i), [float(v) for v in r]) for i, r in zip(ids, x)], "vec_id long, embedding array<double>")
    want = brute(ids, x)
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in pj.near_vectors(df).collect()}
    assert got == want


def test_calm_path_equals_brute_force(spark):
    ids, x = made(seed=5)
    df = spark.createDataFrame([(int(i), [float(v) for v in r]) for i, r in zip(ids, x)], "vec_id long, embedding array<double>")
    assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in pj.near_vectors(df).collect()} == brute(ids, x)


def test_recall_on_simulated_pairs():
    for rows in (500, 200_000):
        model = pj.calibrated(rows, 64)
        rng = np.random.default_rng(99)
        x = rng.standard_normal((1500, 64)); x /= np.linalg.norm(x, axis=1, keepdims=True)
        z = rng.standard_normal((1500, 64)); z -= (z * x).sum(1, keepdims=True) * x; z /= np.linalg.norm(z, axis=1, keepdims=True)
        y = 0.9 * x + np.sqrt(1 - 0.81) * z
        counts = np.concatenate([model.collisions(x[s:s + 250].astype(np.float32), y[s:s + 250].astype(np.float32)) for s in range(0, 1500, 250)])
        assert (counts >= model.least).mean() >= 0.998


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 0), (2, [2.0, 0.0], 0), (2, [2.0, 0.0], 0), (3, None, 0), (4, [], 0), (5, [0.0, 0.0], 0), (6, [1.0, None], 0),
            (7, [nan, 1.0], 0), (8, [inf, 1.0], 0), (None, [1.0, 0.0], 0), (9, [1.0, 0.0, 0.0], 0), (10, [1e200, 1e199], 0), (11, [0.0, -1.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n_links int")
    got = pj.near_vectors(df).collect()
    assert len(got) == len(rows)
    links = {}
    for r in got:
        links.setdefault(r["vec_id"], []).append((r["n_links"], r["component_id"]))
    assert links[1] == [(3, 1)] and links[2] == [(3, 1)] * 2 and links[10] == [(3, 1)]
    for i in (3, 4, 5, 6, 7, 8, 9, 11):
        assert links[i] == [(0, i)]
    assert links[None] == [(0, None)]
    assert pj.near_vectors(df.limit(0)).count() == 0


def test_each_length_is_searched(spark, monkeypatch):
    (_, x), (_, y), (_, z) = made(n=260, d=32), made(n=200, d=24, seed=6), made(n=200, d=48, seed=7)
    rows, want = [], {}
    for k, part in enumerate((x, y, z)):
        own = 10_000 * k + np.arange(len(part))
        want.update(brute(own, part))
        rows += [(int(i), [float(v) for v in r]) for i, r in zip(own, part)]
    rows += [(90_000, [1.0, 2.0]), (90_001, [2.0, 4.0]), (90_002, [5.0])]        # one length of copies only, one of a single vector
    want.update({90_000: (1, 90_000, True), 90_001: (1, 90_000, False), 90_002: (0, 90_002, True)})
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    for hot, tile in ((256, 512), (20, 16)):
        monkeypatch.setattr(pj, "HOT", hot)
        monkeypatch.setattr(pj, "TILE", tile)
        assert {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in pj.near_vectors(df).collect()} == want
