import pytest
from pyspark.sql import functions as F

from gridpulse.llm import mixing


def water(sizes, weights=(5, 2, 1), cap=3):
    """Targets by repeated resharing."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    full, total = set(), sum(sizes.values())
    while True:
        left = total - sum(cap * sizes[s] for s in full)
        weight = sum(w[s] for s in names if s not in full)
        level = left / weight if weight else 0
        new = {s for s in names if s not in full and w[s] * level > cap * sizes[s]}
        if not new:
            return {s: float(cap * sizes[s]) if s in full else w[s] * level for s in names}
        full |= new


@pytest.mark.parametrize("sizes", [{"a": 10, "b": 10, "c": 10}, {"a": 1, "b": 1000, "c": 3, "d": 50, None: 7}, {"a": 0, "b": 5}, {"x": 4}])
def test_targets_by_brute_force(spark, sizes):
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r for r in mixing.targets(df).collect()}
    for s, t in water(sizes).items():
        assert got[s].target == pytest.approx(t) and got[s].rate <= 3


def test_odd_rows_and_empty_tables(spark, odd, none):
    got = mixing.plan(odd).collect()
    assert len(got) == 10 and all(r.taken <= 3 * r.size for r in got)
    assert mixing.mix(odd).columns == odd.columns
    assert mixing.plan(none).count() == mixing.mix(none).count() == 0


def test_the_mix_comes_near_its_targets_and_reruns_agree(spark):
    rows = spark.range(6000).select(
        F.col("id").alias("doc_id"), F.concat(F.lit("s"), F.least(F.col("id") % 9, F.lit(5))).alias("source"), F.repeat(F.lit("w "), (F.col("id") % 20 + 1).cast("int")).alias("text")
    )
    plan = mixing.plan(rows).join(rows.select("doc_id", "source"), "doc_id")
    for r in plan.groupBy("source").agg(F.sum("taken").alias("taken"), F.max("target").alias("target")).collect():
        assert r.taken == pytest.approx(r.target, rel=0.06)
    n = {r.doc_id: r.taken for r in plan.collect()}
    again = rows.repartition(7, "text")
    assert n == {r.doc_id: r.taken for r in mixing.plan(again).collect()}
    copies = {r.doc_id: r["count"] for r in mixing.mix(again).groupBy("doc_id").count().collect()}
    assert all(copies.get(i, 0) * (i % 20 + 1) == t for i, t in n.items())


def test_repeated_ids_draw_for_themselves(spark):
    """A source of one id, one of null ids, one of equal rows, and one of other ids."""
    kinds = {"one": "0", "none": "null", "same": "7", "rest": "id + 10"}
    weights = (1.1, 1.3, 0.9, 0.7)
    rows = None
    for source, id in kinds.items():
        text = "'w w w'" if source == "same" else "concat('w ', id, ' x')"
        some = spark.range(3000).selectExpr(f"{id} AS doc_id", f"'{source}' AS source", f"{text} AS text")
        rows = some if rows is None else rows.union(some)
    plan = mixing.plan(rows, weights)
    source = F.expr("case when doc_id is null then 'none' when doc_id = 0 then 'one' when doc_id = 7 then 'same' else 'rest' end")
    for r in plan.groupBy(source).agg(F.sum("taken").alias("taken"), F.max("target").alias("target"), F.countDistinct("taken").alias("kinds")).collect():
        assert r.taken == pytest.approx(r.target, rel=0.05) and r.kinds == 2
    digest = lambda df: sorted((r.doc_id if r.doc_id is not None else -1, r.taken, r["count"]) for r in df.groupBy("doc_id", "taken").count().collect())
    assert digest(plan) == digest(mixing.plan(rows.repartition(5), weights))
    mixed = mixing.mix(rows, weights).groupBy("doc_id").count()
    taken = plan.groupBy("doc_id").agg((F.sum("taken") / 3).cast("long").alias("count")).where("count > 0")
    assert sorted(mixed.collect(), key=str) == sorted(taken.collect(), key=str)
