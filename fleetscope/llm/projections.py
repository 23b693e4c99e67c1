"""Near-duplicate vectors by counting collisions on one-dimensional projections.

A projection orders all vectors by their value along a direction. Near
vectors lie close on every one of them; the query-centred window of a vector
holds those whose value differs by at most ``width``. The number of
projections on which a pair shares windows is counted, and pairs that reach
``least`` are verified by their exact cosine.

To keep windows small at any corpus size a vector takes part only in the
``top`` projections on which it lies furthest out, where the order is sparse:
a random pair seldom meets there, a pair at the threshold almost always does,
several times. Directions are all sums and differences of two random
families (``a_i + b_j``), so ``2 * m * m`` projections cost ``2 * m`` inner
products per vector; ``m`` grows with the square root of the row count, which
keeps the expected window at about ``crowd`` vectors. ``least`` is calibrated
on simulated pairs whose cosine is exactly the threshold: the largest count
that keeps the wanted recall.

Hot windows. Copies are collapsed first (equal vectors are one item with a
weight). A projection with more than ``HOT`` vectors would make too many
pairs, so it is cut into tiles of at most ``2 * TILE`` vectors that are
compared by matrix products inside tasks; every pair that shares a hot
projection is verified there exactly once, in its first hot projection, and
its links come back as counts and forest links, never as pairs.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite
components link with nothing and are their own component; vectors link with
vectors of their own length only, whatever lengths occur (each length has its
own directions, with projection numbers of its own); a null id links with
nothing and has a null component; rows of one id and one vector are copies
that link; an id with several vectors is one node of the components.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetscope.llm.common import small_batches, sorted_groups, staged
from fleetscope.llm.components import connected_components

THRESHOLD, TOP, CROWD, RECALL, WIDTH = 0.9, 24, 4, 0.999, 1.5
LEAST = 3                 # a count below this would verify chance meetings
HOT, TILE = 256, 512
TILE_KEYS = ["projection", "side_a", "side_b"]


def _largest(x: np.ndarray, k: int) -> np.ndarray:
    """Columns of the k largest values of each row, in falling order."""
    if k < x.shape[1]:
        some = np.argpartition(-x, k - 1, axis=1)[:, :k]
    else:
        some = np.broadcast_to(np.arange(x.shape[1]), x.shape)
    order = np.argsort(-np.take_along_axis(x, some, 1), axis=1, kind="stable")
    return np.take_along_axis(some, order, 1)


@dataclass(frozen=True)
class Projections:
    first: np.ndarray          # m x dimension
    second: np.ndarray
    top: int
    width: float
    least: int

    def outermost(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and values of the ``top`` projections of each row."""
        m = len(self.first)
        u, v = x @ self.first.T, x @ self.second.T
        k = min(self.top, m)
        grid_i, grid_j = np.divmod(np.arange(k * k), k)
        # A pair of ranks (i, j) can be among the k best sums only if
        # (i + 1) * (j + 1) <= k: so many sums are at least as large.
        some = (grid_i + 1) * (grid_j + 1) <= k
        grid_i, grid_j = grid_i[some], grid_j[some]
        numbers, values = [], []
        for sign in (1, -1):
            su, sv = sign * u, sign * v
            pu, pv = _largest(su, k), _largest(sv, k)
            tu, tv = np.take_along_axis(su, pu, 1), np.take_along_axis(sv, pv, 1)
            values.append((tu[:, grid_i] + tv[:, grid_j]) / np.sqrt(2.0))
            numbers.append((pu[:, grid_i].astype(np.int64) * m + pv[:, grid_j]) * 2 + (sign < 0))
        number, value = np.concatenate(numbers, 1), np.concatenate(values, 1)
        best = np.argsort(-value, axis=1, kind="stable")[:, :min(self.top, value.shape[1])]
        return np.take_along_axis(number, best, 1), np.take_along_axis(value, best, 1)

    def collisions(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Shared windows of the pairs (x[i], y[i])."""
        (nx, vx), (ny, vy) = self.outermost(x), self.outermost(y)
        meet = (nx[:, :, None] == ny[:, None, :]) & (np.abs(vx[:, :, None] - vy[:, None, :]) <= self.width)
        return meet.sum(axis=(1, 2))


def calibrated(rows: int, dimension: int, threshold: float = THRESHOLD, top: int = TOP, crowd: int = CROWD,
               recall: float = RECALL, width: float = WIDTH, seed: int = 23, trials: int = 2000) -> Projections:
    """Projections for a corpus of this size, with the largest count that
    keeps the recall on simulated pairs whose cosine is the threshold. While
    that count is below ``LEAST``, vectors take part in more projections."""
    rng = np.random.default_rng(seed)
    x = rng.standard_normal((trials, dimension))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    z = rng.standard_normal((trials, dimension))
    z -= (z * x).sum(axis=1, keepdims=True) * x
    norm = np.linalg.norm(z, axis=1, keepdims=True)
    y = threshold * x + np.sqrt(1 - threshold ** 2) * z / np.where(norm > 0, norm, 1)
    x, y = x.astype(np.float32), y.astype(np.float32)
    while True:
        m = max(16, int(np.ceil(np.sqrt(rows * top / (2.0 * crowd)))))
        first, second = (rng.standard_normal((m, dimension)).astype(np.float32) for _ in range(2))
        trial = Projections(first, second, top, width, 1)
        counts = np.sort(np.concatenate([trial.collisions(x[s:s + 250], y[s:s + 250]) for s in range(0, trials, 250)]))
        least = int(counts[int((1 - recall) * trials)])
        if least >= LEAST or top >= 2 * m:
            return Projections(first, second, top, width, max(1, least))
        top = top * 3 // 2


def unit_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, unit): vectors in double precision, to unit length (null
    where id or vector cannot link)."""
    small_batches(vectors.sparkSession)

    def unit(values: list | None, named: bool) -> np.ndarray | None:
        if not named or not values or None in values:
            return None
        x = np.array(values, np.float64)
        big = np.abs(x).max()
        if not np.isfinite(big) or big == 0:
            return None
        x /= big                       # first, so that squares stay finite
        return x / np.sqrt((x * x).sum())

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in range(0, batch.num_rows, 2000):
                part = batch.slice(s, 2000)
                ids = part.column("vec_id").cast(pa.int64())
                units = [unit(v, i is not None) for v, i in zip(part.column("embedding").to_pylist(), ids.to_pylist())]
                yield pa.RecordBatch.from_arrays([ids, pa.array(units, pa.list_(pa.float64()))], names=["vec_id", "unit"])

    return vectors.select("vec_id", "embedding").mapInArrow(work, "vec_id long, unit array<double>")


def _tile_links(tile: pa.Table, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Items, linked weight, ids and the least id linked in a hot tile."""
    key = tile.column("item").to_numpy()
    weight = tile.column("weight").to_numpy()
    block = tile.column("block").to_numpy()
    projection = tile.column("projection")[0].as_py()
    across = tile.column("side_a")[0].as_py() != tile.column("side_b")[0].as_py()
    x = np.stack(tile.column("unit").combine_chunks().to_numpy(zero_copy_only=False)).astype(np.float64)
    near = x @ x.T >= threshold
    np.fill_diagonal(near, False)
    if across:
        near &= block[:, None] != block[None, :]
    # Leave out pairs that meet in an earlier hot projection.
    hot = [[p for p in own if p < projection] for own in tile.column("hot").to_pylist()]
    for p in {p for own in hot for p in own}:
        has = np.array([p in own for own in hot])
        near &= ~(has[:, None] & has[None, :])
    links = near @ weight
    # Labels flow to the smallest id within the tile.
    rep = tile.column("rep").to_numpy()
    label = rep.copy()
    while True:
        least = np.minimum(label, np.where(near, label[None, :], np.iinfo(np.int64).max).min(axis=1))
        if (least == label).all():
            break
        label = least
    return key, links, rep, label


def near_vectors(vectors: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    spark = vectors.sparkSession
    small_batches(spark)
    units = staged(unit_vectors(vectors), "units")
    linkable = F.col("unit").isNotNull()
    usable = units.filter(linkable)
    # Equal vectors become one item, named by a hash; ``rep`` is its smallest id.
    named = usable.select("vec_id", "unit", F.xxhash64("unit").alias("h1"), F.xxhash64(F.lit(1), "unit").alias("h2"))
    classes = named.groupBy("h1", "h2").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("weight"), F.any_value("unit").alias("unit"))
    items = staged(classes.withColumn("item", F.col("h1")), "items")
    # Every length has its own range of projection numbers, so nothing below
    # can bring vectors of two lengths together. A lone item meets no other.
    models, end = {}, 0
    for r in items.groupBy(F.size("unit").alias("d")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").orderBy("d").collect():
        models[r["d"]] = end, calibrated(r["n"], r["d"], threshold, recall=recall)
        end += 2 * len(models[r["d"]][1].first) ** 2
    sent = spark.sparkContext.broadcast(models)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = pc.list_value_length(batch.column("unit")).to_numpy()
            for d in np.unique(size).tolist():
                if d not in sent.value:
                    continue
                start, own = sent.value[d]
                step = max(1, 1_000_000 // (2 * len(own.first)))       # bounded memory for any m
                alike = batch.filter(pa.array(size == d))
                for s in range(0, alike.num_rows, step):
                    part = alike.slice(s, step)
                    flat = part.column("unit").flatten().to_numpy().astype(np.float32).reshape(part.num_rows, -1)
                    number, value = own.outermost(flat)
                    k = number.shape[1]
                    yield pa.RecordBatch.from_arrays(
                        [part.column("item").take(pa.array(np.repeat(np.arange(part.num_rows), k))), pa.array(start + number.ravel()),
                         pa.array(value.ravel().astype(np.float32)), pa.array(np.full(number.size, own.least, np.int32))],
                        names=["item", "projection", "value", "least"])

    places = staged(items.select("item", "unit").mapInArrow(project, "item long, projection long, value float, least int"), "places")
    crowds = places.groupBy("projection").agg(F.count(F.lit(1)).alias("m")).filter("m > 1")
    hot = staged(crowds.filter(F.col("m") > HOT).select("projection", F.ceil(F.col("m") / TILE).cast("int").alias("blocks")), "hot")
    hot_places = staged(places.join(hot, "projection").select("item", "projection", "blocks"), "hot-places")
    own_hot = hot_places.groupBy("item").agg(F.sort_array(F.collect_set("projection")).alias("hot"))    # at most ``top`` entries
    own_hot = staged(own_hot, "own-hot")

    # Calm projections: pairs within each other's window, counted per pair.
    calm = staged(places.join(crowds.filter(F.col("m") <= HOT).select("projection"), "projection"), "calm")
    a, b = calm.alias("a"), calm.alias("b")
    meet = (a.join(b, F.col("a.projection") == F.col("b.projection"))
            .filter((F.col("a.item") < F.col("b.item")) & (F.abs(F.col("a.value") - F.col("b.value")) <= WIDTH)))
    pairs = (meet.groupBy(F.col("a.item").alias("x"), F.col("b.item").alias("y"))
             .agg(F.count(F.lit(1)).alias("n"), F.min("a.least").alias("least")).filter("n >= least").select("x", "y"))
    vec = items.select("item", "rep", "unit", "weight").join(own_hot, "item", "left")
    vec = staged(vec, "vectors")
    side = lambda k: vec.select(F.col("item").alias(k), F.col("unit").alias(f"{k}_unit"), F.col("weight").alias(f"{k}_weight"), F.col("rep").alias(f"{k}_rep"), F.col("hot").alias(f"{k}_hot"))
    dot = F.aggregate(F.zip_with("x_unit", "y_unit", lambda p, q: p * q), F.lit(0.0), lambda s, v: s + v)
    apart = F.col("x_hot").isNull() | F.col("y_hot").isNull() | ~F.arrays_overlap("x_hot", "y_hot")
    calm_links = staged(pairs.join(side("x"), "x").join(side("y"), "y").filter(apart).filter(dot >= threshold)
                        .select("x", "y", "x_weight", "y_weight", "x_rep", "y_rep"), "calm-links")

    # Hot projections: tiles, verified by matrix products.
    block = F.pmod(F.xxhash64("item"), F.col("blocks")).cast("int")
    tiles = (hot_places.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select("item", "projection", "block", F.least("block", "other").alias("side_a"), F.greatest("block", "other").alias("side_b"))
             .join(vec, "item"))

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for tile in sorted_groups(batches, TILE_KEYS):
            key, links, rep, label = _tile_links(tile, threshold)
            some = links > 0
            yield pa.RecordBatch.from_arrays([pa.array(key[some]), pa.array(links[some].astype(np.int64)), pa.array(rep[some]), pa.array(label[some])],
                                             names=["item", "links", "rep", "label"])

    hot_links = staged(tiles.repartitionByRange(*TILE_KEYS).sortWithinPartitions(*TILE_KEYS)
                       .mapInArrow(verify, "item long, links long, rep long, label long"), "hot-links")

    links = (calm_links.select(F.col("x").alias("item"), F.col("y_weight").alias("links"))
             .unionByName(calm_links.select(F.col("y").alias("item"), F.col("x_weight").alias("links")))
             .unionByName(hot_links.select("item", "links")).groupBy("item").agg(F.sum("links").alias("links")))
    edges = (calm_links.select(F.col("x_rep").alias("a"), F.col("y_rep").alias("b"))
             .unionByName(hot_links.select(F.col("rep").alias("a"), F.col("label").alias("b")))
             # Copies of one vector, and the vectors of one id, hang together.
             .unionByName(named.join(items.select("h1", "h2", "rep"), ["h1", "h2"]).select(F.col("vec_id").alias("a"), F.col("rep").alias("b"))))
    groups = connected_components(edges.filter("a <> b"))
    per_item = items.select("h1", "h2", "item", "weight").join(links, "item", "left").select(
        "h1", "h2", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n"))
    linked = named.drop("unit").join(per_item, ["h1", "h2"]).select(F.col("vec_id").alias("id"), "n")
    rest = units.filter(~linkable).select(F.col("vec_id").alias("id"), F.lit(0).cast("long").alias("n"))
    out = linked.unionByName(rest)
    component = F.coalesce("component", "id")
    return (out.join(groups, out["id"] == groups["node"], "left")
            .select(F.col("id").alias("vec_id"), F.col("n").cast("long").alias("n_links"), component.alias("component_id"),
                    F.coalesce(F.col("id") == component, F.lit(True)).alias("kept")))
