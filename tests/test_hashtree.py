"""Inserted, deleted and changed rows are named exactly, and features follow from touched components alone."""

import random

import pytest
from pyspark.sql import functions as F

from gridpulse.operators import graph, hashtree

ROW = "ID long, name string, load double"


@pytest.mark.parametrize("n", [0, 3, 60])
def test_random_changes_are_named(spark, tmp_path, n):
    rnd = random.Random(n)
    rows = {i: (i, rnd.choice(["a", None, "b"]), rnd.random()) for i in range(800)}
    hashtree.save(hashtree.row_hashes(spark.createDataFrame(list(rows.values()), ROW), "ID"), f"{tmp_path}/t")
    want, after = {}, dict(rows)
    for i in rnd.sample(range(800), n):
        if rnd.random() < 0.5:
            del after[i]
            want[str(i)] = "deleted"
        else:
            after[i] = (i, "changed", after[i][2])
            want[str(i)] = "changed"
    for i in range(1000, 1000 + n):
        after[i] = (i, "new", 0.0)
        want[str(i)] = "inserted"
    new = spark.createDataFrame(rnd.sample(list(after.values()), len(after)), ROW).select("load", "ID", "name").repartition(3)
    got = {r.key: r.change for r in hashtree.changes_since(spark, f"{tmp_path}/t", new, "ID").collect()}
    assert got == want


def test_only_differing_buckets_are_compared(spark):
    rows = [(i, "x", float(i)) for i in range(3000)]
    old = hashtree.tree(hashtree.row_hashes(spark.createDataFrame(rows, ROW), "ID"))
    rows[7] = (7, "y", 7.0)
    new = hashtree.tree(hashtree.row_hashes(spark.createDataFrame(rows, ROW), "ID"))
    assert hashtree.changed_buckets(old, new).count() == 1 and hashtree.changed_buckets(old, old).count() == 0
    assert old.where("level = 0").first().n == 3000
    assert max(r["count"] for r in old.groupBy("level", F.floor(F.col("node") / hashtree.BRANCH)).count().where("level > 0").collect()) <= hashtree.BRANCH


def test_repeated_and_null_keys_and_empty_tables(spark, tmp_path):
    rows = [(1, "a", 1.0), (1, "a", 1.0), (None, "b", None), (2, None, 2.0)]
    table = spark.createDataFrame(rows, ROW)
    hashtree.save(hashtree.row_hashes(table, "ID"), f"{tmp_path}/t")
    changes = lambda df: {r.key: r.change for r in hashtree.changes_since(spark, f"{tmp_path}/t", df, "ID").collect()}
    assert changes(table) == {}
    assert changes(table.dropDuplicates()) == {"1": "changed"}
    assert changes(spark.createDataFrame([*rows[:2], (None, "~", None), (2, "null", 2.0)], ROW)) == {None: "changed", "2": "changed"}
    assert changes(table.limit(0)) == {"1": "deleted", None: "deleted", "2": "deleted"}
    hashtree.save(hashtree.row_hashes(table.limit(0), "ID"), f"{tmp_path}/e")
    assert {r.change for r in hashtree.changes_since(spark, f"{tmp_path}/e", table, "ID").collect()} == {"inserted"}


def test_graph_features_of_touched_components_alone(spark):
    rnd = random.Random(2)
    elements = spark.createDataFrame([(i,) for i in range(200)], "ID long")
    links = [(10 * g + rnd.randrange(10), 10 * g + rnd.randrange(10)) for g in range(20) for _ in range(12)]
    row = "src long, dst long"
    old, new = spark.createDataFrame(links, row), spark.createDataFrame(links[1:] + [(33, 44)], row)
    changed = spark.createDataFrame([(links[0][0],), (links[0][1],), (33,), (44,)], "node long")
    touched = hashtree.touched_elements(changed, old, new)
    assert {r.node // 10 for r in touched.collect()} == {0, 3, 4}
    some = touched.withColumnRenamed("node", "ID")
    part = graph.graph_features(elements.join(some, "ID", "left_semi"), new.join(touched.withColumnRenamed("node", "src"), "src", "left_semi"))
    before = graph.graph_features(elements, old)
    merged = before.join(some, "ID", "left_anti").unionByName(part)
    key = lambda df: sorted(tuple(r) for r in df.select(*sorted(df.columns)).collect())
    assert key(merged) == key(graph.graph_features(elements, new))
