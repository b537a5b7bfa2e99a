import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridpulse.llm import mtree
from gridpulse.llm import negatives as N


def inside(x):
    return min(max(x, -(1 << 63)), (1 << 63) - 1)


def brute(rows, anchors):
    out = []
    for at, (a, label, v) in enumerate(rows):
        if not anchors(a):
            continue
        scored = [(-inside(sum(int(x) * int(y) for x, y in zip(v, w))), i, lab) for n, (i, lab, w) in enumerate(rows) if n != at and len(w) == len(v)]
        for p, i, lab in sorted(s for s in scored if s[2] == label)[:5]:
            low = [s for s in sorted(scored) if s[2] != label and 50 * -p <= 100 * -s[0] <= 95 * -p]
            out += [(a, i, n + 1, j, -p, -s) for n, (s, j, _) in enumerate(low[:3])]
    return sorted(out)


def mined(spark, rows, anchors):
    df = spark.createDataFrame(rows, "vec_id long, label long, v array<double>")
    return sorted(tuple(r) for r in N.mine(df, anchors).collect())


@pytest.mark.parametrize("kind", ["random", "equal", "clusters", "one label"])
def test_by_brute_force(spark, monkeypatch, kind):
    for name, n in (("ANCHORS", 8), ("BLOCK", 60), ("STEP", 16)):
        monkeypatch.setattr(N, name, n)
    rnd = np.random.default_rng(1)
    base = {
        "random": rnd.integers(-50, 50, (400, 6)),
        "equal": np.repeat([[3, -2, 1], [3, -1, 1], [0, 0, 0], [1, 1, 1]], 100, axis=0),
        "clusters": rnd.integers(-3, 3, (400, 4)) + 40 * np.eye(4, dtype=int)[rnd.integers(0, 4, 400)],
        "one label": rnd.integers(0, 50, (400, 3)),
    }[kind]
    rows = [(i, 0 if kind == "one label" else int(rnd.integers(0, 3)), [float(x) for x in v]) for i, v in enumerate(base)]
    want = brute(rows, lambda i: i % 10 == 0)
    assert mined(spark, rows, F.col("vec_id") % 10 == 0) == want
    assert want or kind == "one label"


def test_walks_end_early_where_the_bound_certifies():
    rnd = np.random.default_rng(2)
    x = np.concatenate([rnd.integers(0, 20, (500, 4)) + 1000 * e for e in np.eye(4, dtype=int)]).astype(float)
    ids = np.arange(len(x))
    rows = {"v": x, "row": ids, "vec_id": ids, "label": ids % 2}
    anchors = {k: v[:5] for k, v in rows.items()}
    band = np.full((5, 1), mtree.LEAST), np.full((5, 1), mtree.GREATEST)
    computed = []
    best = N.walk(anchors, rows, *band, 5, True, computed.append)
    for i in range(5):
        want = sorted((-int(x[i] @ x[j]), j) for j in range(len(x)) if j != i and (j - i) % 2 == 0)[:5]
        assert [(-s, j) for p, s, j in zip(best.place, best.score, best.id) if p == i] == want
    assert sum(computed) < 0.5 * 5 * len(x)


def test_only_pairs_that_an_anchor_asks_for_are_formed(spark, monkeypatch):
    for name, n in (("ANCHORS", 20), ("BLOCK", 100)):
        monkeypatch.setattr(N, name, n)
    asked = []
    plain = N.Space._met
    monkeypatch.setattr(N.Space, "_met", lambda self, a, k, alike: asked.append(a.count()) or plain(self, a, k, alike))
    rnd = np.random.default_rng(3)
    base = 3000 * np.eye(8)[np.arange(2400) % 8] + rnd.integers(0, 200, (2400, 8))
    rows = [(i, i // 8 % 2, [float(x) for x in v]) for i, v in enumerate(base)]
    got = mined(spark, rows, F.col("vec_id") % 50 == 0)
    assert got == brute(rows, lambda i: i % 50 == 0) and len(got) > 100
    own, others, _, _ = asked
    assert own == 48 and others < 0.5 * 48 * 23  # of 24 cells


def test_odd_rows_and_empty_tables(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [(0, 1, [1.0, 0.5]), (0, 1, [1.0, 0.5]), (1, 1, [nan, 1.0]), (2, 1, [inf, 1.0]), (3, 1, None), (4, 1, [None, 1.0]), (5, 1, []), (6, 2, [0.6, 0.7]), (7, 1, [1.0]), (None, 1, [1.0, 1.0]), (8, None, [1.0, 1.0]), (50, 2, [0.2, 1.0]), (51, 1, [0.3, 0.3])]
    df = spark.createDataFrame([(*r, 1, "x") for r in vectors], "vec_id long, label long, embedding array<float>, v int, band string")
    q = df.select("vec_id", "label", mtree.quantised(F.col("embedding"), 256).alias("v"), "band")
    good = [(i, lab, [float(np.floor(256 * np.float64(np.float32(x)))) for x in v]) for i, lab, v in vectors if i is not None and lab is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    got = sorted(tuple(r) for r in N.mine(q, F.col("vec_id") % 50 == 0).collect())
    assert got == brute(good, lambda i: i % 50 == 0) and got
    assert N.mine(q.limit(0), F.col("vec_id") % 50 == 0).count() == 0
    assert N.mine(q, F.col("vec_id") == 999).count() == 0


def test_large_whole_numbers_are_exact(spark):
    rnd = random.Random(0)
    rows = [(i, i % 3, [float(rnd.randrange(-(2**29), 2**30)) for _ in range(4)]) for i in range(60)]
    rows += [(100, 0, [1e30, 1.0]), (101, 0, [1e30, 5.0]), (102, 1, [2.0, 7.0]), (103, 1, [1e5, 1e5])]
    assert mined(spark, rows, F.col("vec_id") % 20 == 0) == brute(rows, lambda i: i % 20 == 0)
