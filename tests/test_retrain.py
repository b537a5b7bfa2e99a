"""Delta runs leave what full runs leave, compute only what changes ask for, and publish no worse classifier."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from gridpulse.operators import boosting, retrain, store

T0 = dt.datetime(2024, 1, 1)
COLUMNS = ["GRAPH_DEGREE", "COMPONENT_SIZE", "VENDOR_ENC", "LINK_HEALTH_SCORE"]


@pytest.fixture(scope="module")
def tables(spark):
    rnd = random.Random(3)
    n = 120
    elements = [(i, f"NE-{i}", "LTE", rnd.choice("VW"), None, None, None, None, None) for i in range(n)]
    links = sorted({(10 * g + rnd.randrange(10), 10 * g + rnd.randrange(10), "bgp", None, None, None, None, None, None, None) for g in range(n // 10) for _ in range(rnd.choice([3, 14]))}, key=str)
    degree = {i: sum(i in r[:2] for r in links) for i in range(n)}
    alarms = [(k, T0 + dt.timedelta(seconds=rnd.randrange(10 * 86_400)), f"NE-{(i := rnd.randrange(n))}", rnd.choice("abc"), "POWER" if degree[i] > 2 else "LINK") for k in range(900)]
    e = "ID long, NE_ID string, TECHNOLOGY string, VENDOR string, PARENT_NE_ID_FK long, GEOGRAPHY_L1_ID_FK long, GEOGRAPHY_L2_ID_FK long, GEOGRAPHY_L3_ID_FK long, GEOGRAPHY_L4_ID_FK long"
    l = "src long, dst long, link_type string, SOURCE_UTILIZATION double, SOURCE_ERROR_RATE double, SOURCE_DROP_RATE double, TARGET_UTILIZATION double, TARGET_ERROR_RATE double, TARGET_DROP_RATE double, SOURCE_UTILIZATION_SEVERITY string"
    a = "alarm_id long, alarm_time timestamp, entity_id string, alarm_code string, root_cause string"
    return tuple(spark.createDataFrame(rows, schema).cache() for rows, schema in ((elements, e), (links, l), (alarms, a)))


def key(df):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.select(*sorted(df.columns)).collect()), key=str)


def test_delta_runs(spark, tables, tmp_path):
    elements, links, alarms = tables
    fitted = []

    def fit(df):
        fitted.append(df.count())
        rounds, names = (1, ["absent"]) if len(fitted) == 3 else (4, COLUMNS)  # the third is of no use
        return boosting.BoostedTrees(names, rounds=rounds, depth=3).fit(df)

    def job(folder):
        return retrain.Retraining(store.ModelStore(spark, f"{tmp_path}/{folder}"), COLUMNS, fit, lambda path: boosting.BoostedTrees.load(spark, path), 1800, 100, 0.0, 0.0)

    delta = job("delta")
    some = alarms.where("alarm_id < 600")
    first = delta.run(elements, links, some)
    assert first.changed is None and first.recomputed == 120 and set(first.published) == {"cause", "graph", "elements", "links", "rules", "rule_state"}
    second = delta.run(elements, links, some)
    assert (second.changed, second.recomputed, second.published, len(fitted)) == (0, 0, [], 1)
    # A link between two components goes in, one of a third comes out, an element gets another vendor; few alarms are new.
    gone = links.where("src <> dst").orderBy("src", "dst").first()
    links2 = links.where(~((F.col("src") == gone.src) & (F.col("dst") == gone.dst))).unionByName(links.limit(1).withColumns({"src": F.lit(35).cast("long"), "dst": F.lit(47).cast("long")}))
    elements2 = elements.withColumn("VENDOR", F.when(F.col("ID") == 60, "X").otherwise(F.col("VENDOR")))
    third = delta.run(elements2, links2, alarms.where("alarm_id < 650"))
    assert third.changed == 3 and third.recomputed < 60 and third.new_alarms == 50 and third.published == ["cause", "graph", "elements", "links"]
    fourth = delta.run(elements2, links2, alarms)
    assert fourth.published == ["rules", "rule_state"] and fourth.new_alarms == 300
    full = job("full")
    last = full.run(elements2, links2, alarms)
    assert "rules" in last.published
    for name in ("graph", "rules"):
        assert key(spark.read.parquet(delta.store.current(name)["path"])) == key(spark.read.parquet(full.store.current(name)["path"]))
    before = delta.store.current("cause")
    fitted[:] = fitted[:2]  # so that the next is the third
    fifth = delta.run(elements2.withColumn("VENDOR", F.lit("Z")), links2, alarms)
    assert fifth.refused == ["cause"] and fifth.changed == 120 and delta.store.current("cause") == before and before["facts"]["accuracy"] > 0.8


def test_classifier_is_given_what_it_reads_only(spark, tables, tmp_path):
    """Rows for training hold the id, the label and the features; an alarm's own column counts as a feature, absent ones don't."""
    elements, _, alarms = tables
    seen = []

    def fit(df):
        seen.append((sorted(df.columns), df.count()))
        return boosting.BoostedTrees(["HOUR", "DEGREE"], rounds=1, depth=2).fit(df)

    columns = ["DEGREE", "HOUR", "NO_SUCH"]
    job = retrain.Retraining(store.ModelStore(spark, f"{tmp_path}/narrow"), columns, fit, lambda path: boosting.BoostedTrees.load(spark, path))
    report = retrain.Report()
    job._classifier(report, elements.withColumn("DEGREE", F.col("ID") % 7), alarms.withColumn("HOUR", F.hour("alarm_time")))
    assert report.published == ["cause"] and seen[0][0] == ["DEGREE", "HOUR", "alarm_id", "root_cause", "train"] and 600 < seen[0][1] < 900
