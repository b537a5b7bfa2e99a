import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridpulse.llm import centroids as C


def brute(rows, k, rounds, seed=2):
    """(id, cluster, distance) and centroids by plain rounds over whole numbers."""
    rows = [(i, [int(x) for x in v]) for i, v in rows]
    first = sorted((hashlib.sha256(f"{seed}:{i}".encode()).hexdigest(), v) for i, v in rows if i is not None)
    cents = [list(v) for _, v in first[:k]]
    assign = lambda: [min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(cents)) for _, v in rows]
    for _ in range(rounds):
        at = assign()
        for n in range(len(cents)):
            own = [v for (_, v), a in zip(rows, at) if a[1] == n]
            if own:
                cents[n] = [sum(col) // len(own) for col in zip(*own)]
    return sorted((i, n, d) for (i, _), (d, n) in zip(rows, assign())), cents


def got(found):
    return sorted(tuple(r) for r in found.rows.collect()), found.centroids


@pytest.mark.parametrize("kind", ["random", "equal", "clusters", "grid"])
def test_by_plain_rounds(spark, monkeypatch, kind):
    monkeypatch.setattr(C, "BLOCK", 50)
    rnd = np.random.default_rng(4)
    base = {
        "random": rnd.integers(-90, 90, (400, 5)),
        "equal": np.repeat([[3, -2, 1], [7, 7, 7]], 100, axis=0),
        "clusters": rnd.integers(-3, 3, (400, 4)) + 60 * rnd.integers(0, 4, (400, 1)),
        "grid": rnd.integers(0, 3, (400, 2)),  # many ties
    }[kind]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(base)]
    df = spark.createDataFrame(rows, "vec_id long, v array<double>")
    assert got(C.cluster(df, 7, 4)) == brute(rows, 7, 4)


def test_few_vectors_are_rescanned_once_clusters_are_settled(spark):
    rnd = np.random.default_rng(5)
    base = rnd.integers(-20, 20, (3000, 4)) + 4000 * rnd.integers(0, 5, (3000, 1))
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(base)]
    found = C.cluster(spark.createDataFrame(rows, "vec_id long, v array<double>"), 12, 8)
    assert got(found) == brute(rows, 12, 8)
    assert found.scanned[0] == 3000 and found.scanned[-1] < 1500


def test_heaps_pop_only_what_expires():
    x = np.array([[0], [1], [48], [100]], np.int16)
    heaps = C.Heaps(4, 2)
    assert heaps.scan(x, [[0], [100]], [0.0, 0.0])[2] == 4
    assert heaps.cluster.tolist() == [0, 0, 0, 1]
    assert heaps.expired([3.9, 3.9]) == [] and heaps.expired([4.0, 4.0]) == [2]  # 52 - 48


def test_odd_rows_and_empty_tables(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5]), (0, [1.0, 0.5]), (1, [nan, 1.0]), (2, [inf, 1.0]), (3, None), (4, [None, 1.0]), (5, []), (6, [-0.0001, 2.0]), (7, [1.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], "vec_id long, embedding array<float>, v string, cluster int")
    q = df.select("vec_id", C.kept(F.col("embedding"), 256, 2).alias("v"))
    found = C.cluster(q)
    assert len(found.centroids) == 3  # the row without an id starts none
    out = {(r.vec_id, r.distance) for r in found.rows.collect()}
    assert {i for i, _ in out} == {0, 6, None} and found.rows.count() == 4
    empty = C.cluster(q.limit(0))
    assert empty.rows.count() == 0 and C.with_inertia(empty).count() == 0


def test_large_whole_numbers_are_exact(spark):
    rnd = np.random.default_rng(6)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rnd.integers(-(2**52), 2**52, (60, 3)))]
    rows += [(100, [2.0**60, 1.0, 0.0]), (101, [-(2.0**70), 5.0, 0.0])]
    want, cents = brute(rows, 5, 3)
    assert got(C.cluster(spark.createDataFrame(rows, "vec_id long, v array<double>"), 5, 3)) == ([(i, n, min(d, 2**63 - 1)) for i, n, d in want], cents)


def test_many_blocks_in_one_partition(spark, monkeypatch):
    """Blocks are many times larger than their heaps, so that batches of as many bytes hold fewer of them."""
    monkeypatch.setattr(C, "BLOCK", 1000)
    rnd = np.random.default_rng(7)
    base = rnd.integers(-900, 900, (12, 600)).astype(float)
    rows = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(base)], "kind int, v array<double>")
    df = spark.range(0, 12_000, 1, 1).join(F.broadcast(rows), F.col("id") % 12 == F.col("kind")).select(F.col("id").alias("vec_id"), "v")
    found = C.cluster(df, 12, 1)
    assert found.rows.count() == 12_000 and found.rows.select("vec_id").distinct().count() == 12_000
    assert found.scanned[0] == 12_000
