"""Components in one partition and in several."""

import random

import pytest

from gridpulse.operators import components


@pytest.mark.parametrize("edges", [components.EDGES, 40, 7])
def test_by_plain_search(spark, monkeypatch, edges):
    monkeypatch.setattr(components, "EDGES", edges)
    rnd = random.Random(4)
    pairs = [(rnd.randrange(200), rnd.randrange(200)) for _ in range(120)] + [(300 + i, 301 + i) for i in range(60)] + [(500, 501 + i) for i in range(40)]
    label = {x: x for p in pairs for x in p}
    for _ in label:
        for a, b in pairs:
            label[a] = label[b] = min(label[a], label[b])
    want = {n: r for n, r in label.items() if any(n in p for p in pairs if p[0] != p[1])}
    df = spark.createDataFrame([*pairs, (None, 1), (2, None)], "a long, b long").repartition(3)
    assert {r.node: r.root for r in components.components(df).collect()} == want


def test_a_small_graph_is_not_shuffled(spark):
    edges = components.cut(spark.createDataFrame([(2, 1), (3, 2), (9, 8)], "a long, b long").coalesce(1))
    both = components._dealt(edges, "a", 3)
    assert "Exchange" not in both.groupBy("a").count()._jdf.queryExecution().executedPlan().toString()
