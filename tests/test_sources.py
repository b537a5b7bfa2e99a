"""Sources and small functions that no registered query covers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from gridpulse.operators import shared
from gridpulse.operators.sequences import label_index
from gridpulse.sources import loaders, sinks
from gridpulse.streaming import streams


def test_a_database_table_is_scanned_in_parallel(spark):
    """With the database that comes with Spark."""
    options = {"url": "jdbc:derby:memory:gridpulse;create=true", "driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver", "dbtable": "parts"}
    spark.range(100).selectExpr("id", "cast(id % 7 AS int) AS size").write.format("jdbc").options(**options).mode("overwrite").save()
    split = {"partitionColumn": "ID", "lowerBound": "0", "upperBound": "100", "numPartitions": "4"}
    df = loaders.read_table(spark, columns=["ID"], where="SIZE > 5", jdbc=options | split)
    assert sorted(r.ID for r in df.collect()) == [i for i in range(100) if i % 7 > 5]
    assert df.rdd.getNumPartitions() == 4


def test_records_are_read_as_alarms(spark):
    good = b'{"alarm_id": 7, "alarm_time": "2024-01-02T03:04:05Z", "entity_id": "e", "alarm_code": "c", "severity": "MAJOR"}'
    rows = streams.from_json_records(spark.createDataFrame([(good,), (b"no json",)], "value binary")).collect()
    assert tuple(rows[0]) == (7, dt.datetime(2024, 1, 2, 3, 4, 5), "e", "c", "MAJOR", None)
    assert set(rows[1]) == {None}


def test_results_are_read_up_to_a_limit(spark, tmp_path):
    names = [c.split()[0] for c in loaders.RESULT_SCHEMA.split(", ")]
    rows = spark.range(20).select(*[F.lit("2024-01-01 00:00:00").alias(c) if c == "open_time" else F.col("id").cast("string").alias(c) for c in names])
    sinks.write_csv(rows, f"{tmp_path}/r")
    assert loaders.read_results(spark, f"{tmp_path}/r", 5).count() == 5
    assert loaders.read_results(spark, f"{tmp_path}/r").count() == 20


@pytest.mark.parametrize("labels,want", [(["A", "UNKNOWN", "B"], [0, 2, 1, 1]), (["B", "A"], [1, 0, 0, 0])])
def test_label_index(spark, labels, want):
    df = spark.createDataFrame([("A",), (" B ",), ("odd",), (None,)], "label string")
    assert [r[0] for r in df.select(label_index("label", labels)).collect()] == want


def test_a_cluster_without_a_shared_folder_is_refused(monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda key, default=None: default)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared.checkpoint_dir(Session())
