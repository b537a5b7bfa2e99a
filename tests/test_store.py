"""Models outlive their process; a running stream picks up what another process publishes, and never what is refused."""

import datetime as dt
import random
import subprocess
import sys
import textwrap
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gridpulse.operators import boosting, models, store
from gridpulse.streaming import streams

T0 = dt.datetime(2024, 1, 1)
RULE = "antecedent string, consequent string, count long, support double, confidence double, avg_delay_sec double, rank int"


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(1)
    data = [(i, rnd.random(), rnd.random()) for i in range(600)]
    df = spark.createDataFrame(data, "alarm_id long, x double, y double").withColumn("root_cause", F.when(F.col("x") > F.col("y"), "A").otherwise("B"))
    return models.stratified_split(df, "root_cause", "alarm_id").cache()


@pytest.mark.parametrize("kind", [models.RootCauseModel, boosting.BoostedTrees])
def test_saved_models_score_alike(spark, rows, tmp_path, kind):
    model = kind(["x", "y"], depth=3).fit(rows.where("train"))
    model.save(spark, f"{tmp_path}/m")
    again = kind.load(spark, f"{tmp_path}/m")
    key = lambda m: sorted((r.alarm_id, r.predicted_root_cause, r.confidence) for r in m.score(rows).collect())
    assert key(again) == key(model) and again.importances == model.importances


def test_a_worse_model_is_refused(spark, rows, tmp_path):
    models_ = store.ModelStore(spark, f"{tmp_path}/store")
    held = rows.where("not train")
    load = lambda path: boosting.BoostedTrees.load(spark, path)
    good = boosting.BoostedTrees(["x", "y"], rounds=6, depth=3).fit(rows.where("train"))
    bad = boosting.BoostedTrees(["x"], rounds=1, depth=1).fit(rows.where("train"))
    assert models_.current("cause") is None and models_.version() == ""
    first = store.gated(models_, "cause", held, "root_cause", bad, load)
    second = store.gated(models_, "cause", held, "root_cause", good, load)
    assert first["accepted"] and second["accepted"] and second["facts"]["accuracy"] > second["facts"]["before"] + 0.05
    third = store.gated(models_, "cause", held, "root_cause", bad, load)
    assert not third["accepted"] and models_.current("cause")["version"] == 2 and models_.version() == "cause=2"
    assert load(models_.current("cause")["path"]).columns == ["x", "y"]
    with pytest.raises(ValueError):
        models_.publish("a/b", lambda path: None)


PUBLISH = """
import sys, tempfile
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
from gridpulse.operators.store import ModelStore
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").config("spark.local.dir", tempfile.mkdtemp(prefix="spark-")).getOrCreate()
rules = spark.createDataFrame([("a", "b", 1, 0.1, 0.5, 1.0, 1), ("a", "c", 1, 0.1, 0.4, 1.0, 2)], sys.argv[3])
print(ModelStore(spark, sys.argv[2]).publish("rules", lambda path: rules.write.parquet(path), accepted=sys.argv[4] == "yes"))
"""


def test_another_process_publishes_and_the_stream_picks_it_up(spark, tmp_path):
    folder, path = f"{tmp_path}/store", f"{tmp_path}/in"
    for k in range(3):
        part = spark.createDataFrame([(10 * k + i, T0 + dt.timedelta(minutes=k), "e", "a", "MAJOR", None) for i in range(10)], streams.ALARMS)
        part.coalesce(1).write.mode("append").parquet(path)
    one = spark.createDataFrame([("a", "b", 1, 0.1, 0.5, 1.0, 1)], RULE)
    models_ = store.ModelStore(spark, folder)
    models_.publish("rules", lambda p: one.write.parquet(p))
    script = tmp_path / "publish.py"
    script.write_text(textwrap.dedent(PUBLISH))

    def load(version):
        from gridpulse.operators.rules import predict_propagation

        known = spark.read.parquet(models_.current("rules")["path"])
        return lambda batch: predict_propagation(batch, known).withColumn("version", F.lit(version))

    sink = streams.batch_sink(f"{tmp_path}/out")

    def and_publish(batch, number):
        sink(batch, number)
        # Refused while the first batch runs, accepted while the second does.
        if number < 2:
            said = subprocess.run([sys.executable, str(script), str(Path(__file__).resolve().parents[1]), folder, RULE, "no" if number == 0 else "yes"], capture_output=True, text=True, timeout=180)
            assert said.returncode == 0, said.stderr[-2000:]

    stream = streams.stream_alarms(spark, path, files=1)
    writer = streams.score_stream(stream, streams.Versioned(models_.version, load), and_publish)
    writer.option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start().awaitTermination()
    got = {(r.batch, r.version, r.propagation_count) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {(0, "rules=1", 1), (1, "rules=1", 1), (2, "rules=2", 2)}


def test_a_stream_stopped_before_its_commit_writes_each_alarm_once(spark, tmp_path):
    path = f"{tmp_path}/in"
    for k in range(3):
        part = spark.createDataFrame([(10 * k + i, T0 + dt.timedelta(minutes=10 * k + i), "e", "a", "MAJOR", None) for i in range(10)], streams.ALARMS)
        part.union(part.limit(4)).coalesce(1).write.mode("append").parquet(path)  # the sender repeats some
    sink, tries = streams.batch_sink(f"{tmp_path}/out"), []

    def killed(batch, number):
        sink(batch, number)
        tries.append(number)
        if tries.count(1) == 1 and number == 1:
            raise RuntimeError("stopped between write and commit")

    def run():
        stream = streams.distinct_alarms(streams.stream_alarms(spark, path, files=1))
        streams.score_stream(stream, lambda: lambda batch: batch, killed).option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start().awaitTermination()

    with pytest.raises(Exception, match="stopped between"):
        run()
    run()
    assert tries.count(1) == 2
    got = sorted(r.alarm_id for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert got == list(range(30))


def test_records_keep_their_place(spark):
    raw = spark.createDataFrame([(b'{"alarm_id": 5, "entity_id": "e"}', "alarms", 3, 17), (b"junk", "alarms", 3, 18)], "value binary, topic string, partition int, offset long")
    got = streams.from_json_records(raw).collect()
    assert [(r.alarm_id, r.topic, r.partition, r.offset) for r in got] == [(5, "alarms", 3, 17), (None, "alarms", 3, 18)]
    assert streams.from_json_records(raw.select("value")).columns == ["alarm_id", "alarm_time", "entity_id", "alarm_code", "severity", "probable_cause"]
