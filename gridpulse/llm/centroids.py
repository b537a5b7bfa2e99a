"""Centroid clustering: Lloyd's rounds with heap-ordered bounds.

Vectors of whole numbers lie in blocks. In a block each cluster keeps a heap of its vectors, ordered by the gap between a
lower bound of the distance to any other centroid and an upper bound of the distance to the own one. When centroids move,
no entry is touched: the sum of how far a cluster's own centroid and the farthest-moved other one have gone is added to
the cluster's drift, and an entry holds the gap plus the drift at the time it was pushed. Only vectors whose entry isn't
above the drift now are popped and compared with all centroids, exactly; all others keep their cluster by the triangle
inequality. What a block returns are the sums of the vectors that changed sides, so centroids come from exact whole sums.

Blocks are written once. After each round only the heaps (an entry for each vector) are written, beside the blocks and in
the same order, so no round shuffles vectors. The driver holds the centroids and their sums, k times the dimension.

Nulls and edge cases: vectors that are null, of another dimension or with null or non-finite components take no part; a
null id takes part but starts no centroid; rows that share an id are vectors of their own; where ids repeat among the
first centroids, ties of their hash go to the smaller vector; with fewer than k vectors there are as many centroids as
vectors; an empty table gives an empty result; equal vectors go to the smallest of equal centroids; distances and sums
beyond 64 bits become the greatest long. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
import pickle
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import RDD, TaskContext
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from .common import cut, ship
from .mtree import GREATEST, quantised

#: Vectors of a block. A task that pairs blocks with their heaps holds a hundred at a time.
BLOCK = 1024


def kept(embedding: Column, scale: int, dim: int) -> Column:
    """floor(scale * x) of each component as a whole double; null if the vector isn't kept."""
    return F.when(F.size(embedding) == dim, quantised(embedding, scale))


def _narrow(x: np.ndarray) -> np.ndarray:
    """The same whole numbers in two or four bytes, if they fit."""
    most = np.abs(x).max(initial=0)
    return x.astype(np.int16 if most < 1 << 15 else np.int32) if most < 1 << 31 else x


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        for start in range(0, batch.num_rows, BLOCK):
            part = batch.slice(start, BLOCK)
            x = part.column("v").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
            ids = pa.array([part.column("vec_id").to_pylist()], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array([number]), ids, pa.array([pickle.dumps(_narrow(x))], pa.binary())], names=["block", "ids", "x"])
            number += 1


def _root(squares: np.ndarray) -> np.ndarray:
    """Square roots as doubles; of squares beyond 10^300, that of 10^300, which leaves no gap."""
    return np.sqrt(np.minimum(squares, 10**300).astype(float) if squares.dtype == object else squares)


def _whole(x: np.ndarray) -> np.ndarray:
    """Python's whole numbers, of any size."""
    return np.array([[int(v) for v in r] for r in x], object).reshape(x.shape)


def distances(x: np.ndarray, centroids: list[list[int]]) -> np.ndarray:
    """Exact squared distances: doubles while all terms are below 2^53, else Python's whole numbers."""
    most = float(np.abs(x.astype(float)).max(initial=0)) + float(max((abs(v) for c in centroids for v in c), default=0))
    if most**2 * x.shape[1] < 2**53:
        x, c = x.astype(float), np.array(centroids, float).reshape(len(centroids), -1)
        return (x**2).sum(axis=1)[:, None] - 2 * x @ c.T + (c**2).sum(axis=1)
    x, c = _whole(x), np.array(centroids, object).reshape(len(centroids), -1)
    return np.array([((x - row) ** 2).sum(axis=1) for row in c], object).T


class Heaps:
    """The clusters of a block's vectors and a heap for each cluster."""

    def __init__(self, n: int, k: int):
        self.cluster = np.full(n, -1, np.int32)
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in range(k)]

    def expired(self, drift: list[float]) -> list[int]:
        """Pops the vectors whose gap the drift has used up; before the first round that is every vector."""
        if len(self.cluster) and self.cluster[0] < 0:
            return list(range(len(self.cluster)))
        out = []
        for heap, most in zip(self.heaps, drift):
            while heap and heap[0][0] <= most:
                out.append(heapq.heappop(heap)[1])
        return out

    def scan(self, x: np.ndarray, centroids: list[list[int]], drift: list[float]) -> tuple[np.ndarray, np.ndarray, int]:
        """Rescans what has expired; what each cluster has gained in vectors and in sums, and how many were rescanned."""
        due = self.expired(drift)
        k, dim = len(centroids), x.shape[1]
        wide = np.abs(x[due].astype(float)).max(initial=0) * max(len(due), 1) >= 2**62
        n, sums = np.zeros(k, np.int64), np.zeros((k, dim), object if wide else np.int64)
        if not due:
            return n, sums, 0
        rows = np.array(due)
        d = distances(x[rows], centroids)
        best = np.argmin(d, axis=1)  # the first of equal ones
        own = _root(d[np.arange(len(rows)), best])
        d[np.arange(len(rows)), best] = float("inf")
        other = _root(d.min(axis=1))
        gap = other - own - 1e-9 * (np.where(np.isfinite(other), other, 0) + own)
        for row, c, g in zip(due, best.tolist(), gap.tolist()):
            heapq.heappush(self.heaps[c], (g + drift[c], row))
        moved = np.flatnonzero(self.cluster[rows] != best)
        values = _whole(x[rows[moved]]) if wide else x[rows[moved]].astype(np.int64)
        np.add.at(n, best[moved], 1)
        np.add.at(sums, best[moved], values)
        old = self.cluster[rows[moved]]
        left = old >= 0
        np.add.at(n, old[left], -1)
        np.add.at(sums, old[left], -values[left])
        self.cluster[rows] = best
        return n, sums, len(rows)


def _paired(blocks: DataFrame, states: DataFrame) -> RDD:
    """The rows of two written tables with as many rows in each partition, side by side. The rows of a table come to Python
    in batches that their bytes decide, which `RDD.zip` would compare; mapped ones are batched alike on both sides."""
    return blocks.rdd.map(lambda r: r).zip(states.rdd.map(lambda r: r))


def _round(k: int, dim: int, centroids: list[list[int]], drift: list[float]):
    """The heaps of each block, with the last one what all blocks of the partition have gained."""

    def run(pairs: Iterator) -> Iterator[Row]:
        last, total = None, _nothing(k, dim)
        for block, state in pairs:
            if last is not None:
                yield Row(heaps=last, gained=None)
            x = pickle.loads(block.x)
            heaps = pickle.loads(state.heaps) if state else Heaps(len(x), k)
            total = _added(total, heaps.scan(x, centroids, drift))
            last = bytearray(pickle.dumps(heaps))
        if last is not None:
            yield Row(heaps=last, gained=bytearray(pickle.dumps(total)))

    return run


def _placed(centroids: list[list[int]]):
    def run(pairs: Iterator) -> Iterator[Row]:
        for block, state in pairs:
            x, at = pickle.loads(block.x), pickle.loads(state.heaps).cluster
            out = [0] * len(x)
            for c in np.unique(at).tolist():
                rows = np.flatnonzero(at == c)
                for i, d in zip(rows.tolist(), distances(x[rows], [centroids[c]])[:, 0].tolist()):
                    out[i] = min(int(d), GREATEST)
            yield Row(ids=block.ids, cluster=at.tolist(), distance=out)

    return run


def _nothing(k: int, dim: int) -> tuple:
    return np.zeros(k, np.int64), np.zeros((k, dim), object), 0


def _added(a: tuple, b: tuple) -> tuple:
    return a[0] + b[0], a[1] + b[1], a[2] + b[2]


def _drifted(old: list[list[int]], new: list[list[int]], drift: list[float]) -> list[float]:
    """How much closer than its gap a vector of each cluster may have come to another centroid, since the start."""
    squares = np.array([sum((a - b) ** 2 for a, b in zip(x, y)) for x, y in zip(old, new)], object)
    far = (_root(squares) * (1 + 1e-9)).tolist()
    first = max(range(len(far)), key=lambda c: far[c], default=0)
    second = max((f for c, f in enumerate(far) if c != first), default=0.0)
    return [d + far[c] + (second if c == first else far[first]) + 1e-9 for c, d in enumerate(drift)]


@dataclass
class Clustering:
    """rows: vec_id, cluster, distance (squared). centroids: whole numbers. scanned: how many vectors each assignment
    compared with all centroids."""

    rows: DataFrame
    centroids: list[list[int]]
    scanned: list[int] = field(default_factory=list)


def first_centroids(vectors: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The k vectors with the smallest SHA-256 of seed and id."""
    name = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    some = vectors.where("vec_id is not null").select(name.alias("h"), "v").orderBy("h", "v").limit(k)
    return [[int(x) for x in r.v] for r in some.collect()]  # k rows


def cluster(vectors: DataFrame, k: int = 40, rounds: int = 5, seed: int = 2) -> Clustering:
    """``vectors``: vec_id and v, an array of whole doubles of one dimension, null if it takes no part. ``rounds`` times
    all vectors go to the nearest centroid (ties to the smaller number) and each centroid that has vectors to the floor
    of their mean; then vectors are assigned once more."""
    spark = vectors.sparkSession
    ship(spark)
    vectors = vectors.where("v is not null").select(F.col("vec_id").cast("long").alias("vec_id"), "v")
    centroids = first_centroids(vectors, k, seed)
    if not centroids:
        return Clustering(spark.createDataFrame([], "vec_id long, cluster int, distance long"), [])
    blocks = cut(vectors.mapInArrow(_pack, "block long, ids array<long>, x binary"))
    k, dim = len(centroids), len(centroids[0])
    n, sums, drift, scanned = [0] * k, [[0] * dim for _ in range(k)], [0.0] * k, []
    states = None
    for number in range(rounds + 1):
        x = blocks.select("x")
        pairs = _paired(x, states) if states is not None else x.rdd.map(lambda b: (b, None))
        table = cut(spark.createDataFrame(pairs.mapPartitions(_round(k, dim, centroids, drift)), "heaps binary, gained binary", verifySchema=False))
        states = table.select("heaps")
        gained = table.where("gained IS NOT NULL").select("gained").rdd.map(lambda r: pickle.loads(r.gained)).treeAggregate(_nothing(k, dim), _added, _added)
        scanned.append(gained[2])
        n = [a + int(b) for a, b in zip(n, gained[0])]
        sums = [[a + int(b) for a, b in zip(x, y)] for x, y in zip(sums, gained[1])]
        if number < rounds:
            moved = [[s // n[c] for s in sums[c]] if n[c] else centroids[c] for c in range(k)]
            drift = _drifted(centroids, moved, drift)
            centroids = moved
    placed = spark.createDataFrame(_paired(blocks.select("ids", "x"), states).mapPartitions(_placed(centroids)), "ids array<long>, cluster array<int>, distance array<long>", verifySchema=False)
    rows = placed.select(F.explode(F.arrays_zip("ids", "cluster", "distance")).alias("r")).select(F.col("r.ids").alias("vec_id"), "r.cluster", "r.distance")
    return Clustering(cut(rows), centroids, scanned)


def with_inertia(found: Clustering) -> DataFrame:
    """The rows with cluster_inertia and inertia, sums of distance over the cluster and over all, and centroid_sha256, of
    the centroid's components joined by commas."""
    spark = found.rows.sparkSession
    sums = {r.cluster: int(r.s) for r in found.rows.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}  # k rows at most
    total = sum(sums.values())
    sha = lambda c: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()
    table = [(c, min(s, GREATEST), min(total, GREATEST), sha(found.centroids[c])) for c, s in sorted(sums.items())]
    about = spark.createDataFrame(table, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.rows.join(F.broadcast(about), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
