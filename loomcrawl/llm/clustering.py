"""Centroid clustering of integer vectors, filtered through ball trees.

Kept are vectors with exactly `dims` components, none null or non-finite; component x becomes the integer
floor(scale * x). The first centroids are the k kept vectors with the smallest sha256 of `1:<vec_id>`. A
round assigns every vector to the nearest centroid (ties: the smaller number) and replaces every centroid
that has vectors by the exact floor of their mean.

Each task builds metric trees of at most `tree` of its vectors; a ball stores its centre, radius, count and
integer sum. Trees are built once and written; a round reads them, and what it hands on are k counts and
sums a task. Going down a tree, a centroid is given up for a ball when the triangle inequality shows
that another is nearer to all of it; a ball with one centroid left is assigned whole, by its count and sum, and a
leaf with more is compared vector by vector. Balls are compared in floating point with a margin far above
its error, so that they only ever decide what exact arithmetic would; distances and sums are integers.

A null vec_id counts as an empty string in the draw. Repeated rows are vectors of their own; of rows with one vec_id
that of the smaller components comes first in the draw. With fewer than k vectors there are as many centroids; an
empty table gives an empty result. Components may be of any size up to 10^30; a distance or an inertia
that no long can hold is null. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import saved

#: Components up to this size have exact distances and sums in 64 bits.
SMALL = 1 << 26
#: Part of the coordinates' size that balls are told apart by; rounding errors are far below it.
MARGIN = 1e-9
LARGEST = (1 << 63) - 1


@dataclass(frozen=True)
class ClusterParams:
    k: int = 16
    rounds: int = 3
    dims: int = 64
    scale: int = 64
    #: Vectors of a tree, and of a leaf at most.
    tree: int = 4096
    leaf: int = 24


def integers(points: np.ndarray) -> np.ndarray:
    """Whole numbers held as doubles, as exact integers: 64-bit ones where squares fit, Python's otherwise."""
    if points.size == 0 or np.abs(points).max() <= SMALL:
        return points.astype(np.int64)
    return np.array([[int(x) for x in row] for row in points.tolist()], object).reshape(points.shape)


def distances(points: np.ndarray, centroids: list[list[int]]) -> np.ndarray:
    """Exact squared distances, a row a point."""
    fits = points.dtype == np.int64 and all(abs(x) <= SMALL for c in centroids for x in c)
    points = points if fits else points.astype(object)
    return np.stack([((points - np.array(c, points.dtype)) ** 2).sum(axis=1) for c in centroids], axis=1)


@dataclass
class BallTree:
    """points: a row a vector, in the tree's order; node i holds points[start[i]:end[i]] and has children low[i] and high[i] (0: a leaf)."""

    points: np.ndarray
    start: np.ndarray
    end: np.ndarray
    low: np.ndarray
    high: np.ndarray
    centre: np.ndarray
    radius: np.ndarray

    @classmethod
    def build(cls, points: np.ndarray, leaf: int) -> tuple[BallTree, np.ndarray]:
        """The tree of some vectors, and their order in it. A ball is parted at the median of its widest dimension."""
        order, nodes, todo = np.arange(len(points)), [[0, len(points), 0, 0]], [0]
        while todo:
            i = todo.pop()
            a, b = nodes[i][:2]
            some = points[order[a:b]]
            spread = some.max(axis=0) - some.min(axis=0)
            if b - a <= leaf or not spread.any():
                continue
            mid = (b - a) // 2
            order[a:b] = order[a:b][np.argpartition(some[:, spread.argmax()], mid)]
            nodes[i][2:] = [len(nodes), len(nodes) + 1]
            todo += nodes[i][2:]
            nodes += [[a, a + mid, 0, 0], [a + mid, b, 0, 0]]
        start, end, low, high = np.array(nodes, np.int64).T
        points = points[order]
        centre = np.stack([points[a:b].mean(axis=0) for a, b in zip(start, end)])
        radius = np.array([np.sqrt(((points[a:b] - c) ** 2).sum(axis=1).max()) for a, b, c in zip(start, end, centre)])
        return cls(points, start, end, low, high, centre, radius), order

    def sums(self, points: np.ndarray) -> np.ndarray:
        """The integer sum of each ball, from the leaves up."""
        out = np.zeros((len(self.start), points.shape[1]), points.dtype)
        for i in range(len(out) - 1, -1, -1):  # children come after their parent
            out[i] = out[self.low[i]] + out[self.high[i]] if self.low[i] else points[self.start[i] : self.end[i]].sum(axis=0)
        return out

    def filtered(self, centroids: list[list[int]]) -> Iterator[tuple[int, list[int]]]:
        """Balls that cover all vectors, each with the centroids that may be nearest to some of it: one, or several at a leaf."""
        middle = np.array(centroids, np.float64)
        apart = np.sqrt(((self.centre[:, None, :] - middle) ** 2).sum(axis=2))
        size = np.abs(self.centre).max(axis=1)[:, None] + np.abs(middle).max(axis=1) + self.radius[:, None] + 1
        near, far = apart - self.radius[:, None] - MARGIN * size, apart + self.radius[:, None] + MARGIN * size
        todo = [(0, np.arange(len(middle)))]
        while todo:
            i, left = todo.pop()
            left = left[near[i, left] <= far[i, left].min()]
            if len(left) == 1 or not self.low[i]:
                yield i, left.tolist()
            else:
                todo += [(int(self.high[i]), left), (int(self.low[i]), left)]


_PARTS = ("start", "end", "low", "high", "centre", "radius")


def _built(p: ClusterParams):
    """(vec_ids, points, …): trees of at most p.tree of a task's vectors."""

    def tree(ids: list, points: np.ndarray) -> pa.RecordBatch:
        t, order = BallTree.build(points, p.leaf)
        columns = [pa.array([[ids[k] for k in order]], pa.list_(pa.int64())), pa.array([t.points.tobytes()])]
        return pa.RecordBatch.from_arrays(columns + [pa.array([getattr(t, x).tobytes()]) for x in _PARTS], ["vec_ids", "points", *_PARTS])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, held = [], []
        for b in batches:
            ids += b.column(0).to_pylist()
            held.append(np.floor(p.scale * b.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.float64)).reshape(-1, p.dims))
            while len(ids) >= p.tree:
                points = np.concatenate(held)
                yield tree(ids[: p.tree], points[: p.tree])
                ids, held = ids[p.tree :], [points[p.tree :]]
        if ids:
            yield tree(ids, np.concatenate(held))

    return run


def _read(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[tuple[list, BallTree, np.ndarray]]:
    for b in batches:
        for row in b.to_pylist():
            ints = [np.frombuffer(row[x], np.int64) for x in _PARTS[:4]]
            floats = [np.frombuffer(row[x], np.float64) for x in ("points", "centre", "radius")]
            t = BallTree(floats[0].reshape(-1, dims), *ints, floats[1].reshape(-1, dims), floats[2])
            yield row["vec_ids"], t, integers(t.points)


def _kept(vectors: DataFrame, p: ClusterParams, vec_id: str, embedding: str) -> DataFrame:
    x = F.col(embedding).cast("array<double>")
    odd = lambda v: v.isNull() | F.isnan(v) | v.isin(float("inf"), float("-inf"))
    return vectors.where((F.size(embedding) == p.dims) & ~F.exists(x, odd)).select(F.col(vec_id).cast("long").alias("vec_id"), x.alias("x"))


def first_centroids(kept: DataFrame, p: ClusterParams) -> list[list[int]]:
    order = F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    return [[math.floor(p.scale * v) for v in r.x] for r in kept.orderBy(order, "x").limit(p.k).collect()]  # k rows


def _sums(trees: DataFrame, centroids: list[list[int]], p: ClusterParams) -> list:
    """(cluster, at, n, total) of every cluster with vectors and every dimension: k times dims rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = [0] * len(centroids), [[0] * p.dims for _ in centroids]
        for _, t, points in _read(batches, p.dims):
            whole = t.sums(points)
            for i, left in t.filtered(centroids):
                a, b = t.start[i], t.end[i]
                if len(left) == 1:
                    parts = [(left[0], int(b - a), whole[i])]
                else:
                    of = distances(points[a:b], [centroids[c] for c in left]).argmin(axis=1)
                    parts = [(left[j], int((of == j).sum()), points[a:b][of == j].sum(axis=0)) for j in set(of.tolist())]
                for c, count, s in parts:
                    n[c] += count
                    total[c] = [x + y for x, y in zip(total[c], s.tolist())]
        some = [c for c in range(len(n)) if n[c]]
        sums = pa.array([[Decimal(v) for v in total[c]] for c in some], pa.list_(pa.decimal128(38, 0)))
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([n[c] for c in some], pa.int64()), sums], ["cluster", "n", "sums"])

    rows = trees.mapInArrow(run, "cluster int, n long, sums array<decimal(38,0)>").select("cluster", "n", F.posexplode("sums").alias("at", "v"))
    return rows.groupBy("cluster", "at").agg(F.sum("n").alias("n"), F.sum("v").alias("total")).collect()


def _assigned(trees: DataFrame, centroids: list[list[int]], p: ClusterParams) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, t, points in _read(batches, p.dims):
            cluster, distance = np.zeros(len(ids), np.int32), np.zeros(len(ids), object)
            for i, left in t.filtered(centroids):
                here = slice(t.start[i], t.end[i])
                apart = distances(points[here], [centroids[c] for c in left])
                of = apart.argmin(axis=1)
                cluster[here] = np.array(left, np.int32)[of]
                distance[here] = apart[np.arange(len(of)), of]
            told = pa.array([int(d) if d <= LARGEST else None for d in distance.tolist()], pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(cluster), told], ["vec_id", "cluster", "distance"])

    return trees.mapInArrow(run, "vec_id long, cluster int, distance long")


def _whole(distance: Column) -> Column:
    """The sum of the distances as a long; null where one is missing or the sum is no long."""
    total = F.sum(distance.cast("decimal(38,0)"))
    return F.when((F.count(distance) == F.count("*")) & (total <= LARGEST), total).cast("long")


def cluster_vectors(vectors: DataFrame, params: ClusterParams = ClusterParams(), vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """One row per kept vector: vec_id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256."""
    spark, p = vectors.sparkSession, params
    kept = _kept(vectors, p, vec_id, embedding)
    centroids = first_centroids(kept, p)
    trees = saved(kept.mapInArrow(_built(p), "vec_ids array<long>, points binary, " + ", ".join(f"{x} binary" for x in _PARTS)), "ball-trees")
    for _ in range(p.rounds if centroids else 0):
        for r in _sums(trees, centroids, p):
            centroids[r["cluster"]][r["at"]] = int(r["total"]) // r["n"]
    assigned = saved(_assigned(trees, centroids, p), "clusters")
    totals = assigned.groupBy("cluster").agg(_whole(F.col("distance")).alias("cluster_inertia"))
    sums = {r["cluster"]: r["cluster_inertia"] for r in totals.collect()}  # k rows
    whole = None if None in sums.values() or sum(sums.values()) > LARGEST else sum(sums.values())
    rows = [(c, sums[c], whole, hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest()) for c in sums]
    told = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(told), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
