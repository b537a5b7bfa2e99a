"""Betweenness and hops of random graphs against plain searches."""

import random
from collections import deque

import pytest

from gridpulse.operators import graph
from gridpulse.sources import sinks


@pytest.fixture(scope="module")
def network():
    rnd = random.Random(5)
    pairs = {tuple(sorted(rnd.sample(range(40), 2))) for _ in range(60)}
    near = {}
    for a, b in pairs:
        near.setdefault(a, set()).add(b)
        near.setdefault(b, set()).add(a)
    return sorted(pairs), near


def paths(near, start):
    """Distances and path counts from a node."""
    far, count, queue = {start: 0}, {start: 1}, deque([start])
    while queue:
        v = queue.popleft()
        for w in near[v]:
            if w not in far:
                far[w], count[w] = far[v] + 1, 0
                queue.append(w)
            if far[w] == far[v] + 1:
                count[w] += count[v]
    return far, count


def test_betweenness_from_all_pivots_is_the_share_of_shortest_paths(spark, network):
    pairs, near = network
    found = {v: paths(near, v) for v in near}
    want = {}
    for v in near:
        total = 0.0
        for s in near:
            far, count = found[s]
            for t in near:
                if v not in (s, t) and s != t and t in far and v in far and far[v] + found[v][0].get(t, 10**9) == far[t]:
                    total += count[v] * found[v][1][t] / count[t]
        want[v] = total / ((len(near) - 1) * (len(near) - 2))
    got = {r.node: r.betweenness for r in graph.betweenness(spark.createDataFrame(pairs, "a long, b long"), 500).collect()}
    assert got == {v: pytest.approx(x, abs=1e-12) for v, x in want.items()}


def test_hops_are_those_of_a_breadth_first_search(spark, network):
    pairs, near = network
    starts = spark.createDataFrame([(v, v) for v in near], "group long, node long")
    got = {(r.group, r.node): r.hop for r in graph.k_hop(starts, spark.createDataFrame(pairs, "a long, b long"), 2).collect()}
    assert got == {(v, w): d for v in near for w, d in paths(near, v)[0].items() if d <= 2}


def test_missing_features_are_reported(spark):
    df = spark.createDataFrame([("e", 1.0)], "NE_ID string, A double")
    assert sinks.missing_features(df, ["A", "B", "C"]) == ["B", "C"]
    assert list(sinks.export_entity_features(df, ["B", "A"]).first().features) == [0.0, 1.0]
