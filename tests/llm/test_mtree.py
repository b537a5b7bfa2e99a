import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridpulse.llm import mtree


def brute(rows, queries, k):
    out = []
    for at, (q, v) in enumerate(rows):
        if queries(q):
            inside = lambda s: min(max(s, -(1 << 63)), (1 << 63) - 1)
            scored = sorted((-inside(sum(int(a) * int(b) for a, b in zip(v, w))), i) for j, (i, w) in enumerate(rows) if j != at and len(w) == len(v))
            out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("kind", ["random", "equal", "clusters"])
def test_trees_by_brute_force(spark, monkeypatch, kind):
    monkeypatch.setattr(mtree, "PAGE", 8)
    monkeypatch.setattr(mtree, "TREE", 120)
    monkeypatch.setattr(mtree, "QUERIES", 4)
    rnd = np.random.default_rng(1)
    base = {"random": rnd.integers(-50, 50, (300, 6)), "equal": np.repeat([[3, -2, 1]], 300, axis=0), "clusters": rnd.integers(-3, 3, (300, 4)) + 40 * rnd.integers(0, 3, (300, 1))}[kind]
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(base)]
    df = spark.createDataFrame(rows, "vec_id long, v array<double>")
    got = sorted(tuple(r) for r in mtree.top_k(df, F.col("vec_id") % 20 == 0, 5).collect())
    assert got == brute(rows, lambda i: i % 20 == 0, 5)


def test_search_opens_few_pages():
    rnd = np.random.default_rng(0)
    x = np.concatenate([rnd.integers(0, 20, (400, 3)) + c for c in ((0, 0, 0), (5000, 0, 0), (0, 5000, 0), (0, 0, 5000))]).astype(float)
    tree = mtree.Tree(np.arange(len(x)), np.arange(len(x)), x)
    seen = []
    pages = tree.pages
    tree.pages = type("Pages", (list,), {"__getitem__": lambda s, i: seen.append(i) or list.__getitem__(s, i)})(pages)
    place, score, ids = tree.search(np.array([450]), x[450:451], 3, np.array([mtree.LEAST]))
    assert [tuple(t) for t in zip(place, ids, score)] == [(0, i, s) for _, _, i, s in brute(list(enumerate(x.tolist())), lambda i: i == 450, 3)]
    assert len(set(seen)) < len(pages) / 2


def test_odd_rows_and_empty_tables(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5]), (0, [1.0, 0.5]), (1, [nan, 1.0]), (2, [inf, 1.0]), (3, None), (4, [None, 1.0]), (5, []), (6, [-0.0001, 2.0]), (7, [1.0]), (None, [1.0, 1.0]), (100, [0.0, 1.0])]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, v int")
    q = df.select("vec_id", mtree.quantised(F.col("embedding")).alias("v"))
    assert {r.vec_id: r.v and list(r.v) for r in q.collect() if r.vec_id in (6, 3, 1)} == {6: [-1.0, 2048.0], 3: None, 1: None}
    got = sorted(tuple(r) for r in mtree.top_k(q, F.col("vec_id") % 100 == 0).collect())
    good = [(0, [1024.0, 512.0]), (0, [1024.0, 512.0]), (6, [-1.0, 2048.0]), (7, [1024.0]), (100, [0.0, 1024.0])]
    assert got == brute(good, lambda i: i % 100 == 0, 10)
    assert mtree.top_k(q.limit(0), F.col("vec_id") % 100 == 0).count() == 0


def test_large_whole_numbers_are_exact(spark):
    rnd = random.Random(0)
    rows = [(i, [float(rnd.randrange(-(2**30), 2**30)) for _ in range(4)]) for i in range(30)]
    df = spark.createDataFrame(rows, "vec_id long, v array<double>")
    got = sorted(tuple(r) for r in mtree.top_k(df, F.col("vec_id") < 3, 4).collect())
    assert got == brute(rows, lambda i: i < 3, 4)


def test_components_are_floored_and_scores_stay_in_range(spark):
    values = [-1e-20, 1e-20, -0.5, 0.99999999, 1e15 + 0.5, -1e300]
    df = spark.createDataFrame([(values,)], "e array<double>").select(mtree.quantised(F.col("e")).alias("v"))
    assert list(df.first().v) == [float(math.floor(1024 * x)) for x in values]
    rows = [(100, [1e30, 1.0]), (1, [1e30, 5.0]), (2, [-1e30, 7.0]), (3, [1e200, 1e200]), (4, [3.0, 4.0])]
    df = spark.createDataFrame(rows, "vec_id long, v array<double>")
    assert sorted(tuple(r) for r in mtree.top_k(df, F.col("vec_id") == 100).collect()) == brute(rows, lambda i: i == 100, 10)


def test_rows_that_share_an_id_are_candidates_of_their_own(spark):
    rows = [(1, [9.0]), (1, [1.0]), (2, [5.0]), (100, [1.0]), (100, [2.0])]
    got = sorted(tuple(r) for r in mtree.top_k(spark.createDataFrame(rows, "vec_id long, v array<double>"), F.col("vec_id") == 100).collect())
    assert got == brute(rows, lambda i: i == 100, 10)


def test_far_trees_are_not_walked(spark, monkeypatch):
    """Clusters far apart: a query's best are in its own, whose trees bound all others away."""
    monkeypatch.setattr(mtree, "TREE", 100)
    met = []
    plain = mtree._meet
    monkeypatch.setattr(mtree, "_meet", lambda trees, asked, blocks, k: met.append((trees.count(), asked.count())) or plain(trees, asked, blocks, k))
    rnd = np.random.default_rng(3)
    centres = 3000 * np.eye(8)
    rows = [(i, [float(x) for x in centres[i % 8] + rnd.integers(-20, 20, 8)]) for i in range(2400)]
    df = spark.createDataFrame(rows, "vec_id long, v array<double>")
    got = sorted(tuple(r) for r in mtree.top_k(df, F.col("vec_id") % 100 == 0, 5).collect())
    assert got == brute(rows, lambda i: i % 100 == 0, 5)
    (trees, queries), (_, later) = met
    assert queries == 24 and later < 0.5 * queries * (trees - 1)


def test_trees_go_to_blocks_that_ask_for_them(spark, monkeypatch):
    """On clustered vectors the copies of trees that are sent are the pairs of tree and block with a query."""
    for name, n in (("TREE", 100), ("QUERIES", 8)):
        monkeypatch.setattr(mtree, name, n)
    sent = []
    meet = mtree._meet

    def counted(trees, asked, blocks, k):
        pairs = asked.join(blocks, ["dim", "home"]).withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"))
        sent.append((pairs.select("dim", "cell", "part", "home", "block").distinct().count(), trees.count(), pairs.select("home", "block").distinct().count()))
        return meet(trees, asked, blocks, k)

    monkeypatch.setattr(mtree, "_meet", counted)
    rnd = np.random.default_rng(4)
    rows = [(i, [float(x) for x in 3000 * np.eye(8)[i % 8] + rnd.integers(-20, 20, 8)]) for i in range(2400)]
    df = spark.createDataFrame(rows, "vec_id long, v array<double>")
    got = sorted(tuple(r) for r in mtree.top_k(df, F.col("vec_id") % 50 == 0, 5).collect())
    assert got == brute(rows, lambda i: i % 50 == 0, 5)
    (first, _, blocks), (later, trees, _) = sent
    assert first <= blocks + 1 and later < 0.5 * trees * blocks
