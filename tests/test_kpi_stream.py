"""Streamed KPI features equal those of the table, through disorder and a restart, and a batch model scores them."""

import datetime as dt
import random

import pytest

from gridpulse.operators import kpi, models
from gridpulse.streaming import kpifeatures, seeded, streams

T0 = dt.datetime(2024, 1, 1)
ROW = "ne_id long, ts timestamp, kpi_value double"


@pytest.fixture(autouse=True)
def rocksdb(spark):
    name = "spark.sql.streaming.stateStore.providerClass"
    old = spark.conf.get(name)
    spark.conf.set(name, seeded.ROCKSDB)
    yield
    spark.conf.set(name, old)


def key(df, least=None):
    names = [c for c, t in df.dtypes if t in ("double", "int")]
    return sorted((r.ne_id, r.ts, *[None if r[c] is None else round(r[c], 6) for c in names]) for r in df.collect() if least is None or r.ts <= least)


def test_rows_equal_those_of_the_table(spark, tmp_path):
    rnd = random.Random(11)
    rows, t = [], 0
    for i in range(500):
        t += rnd.choice([60, 300, 1200])
        rows.append((i % 4, T0 + dt.timedelta(seconds=t), rnd.choice([rnd.gauss(70, 15), 0.0, None] if i % 9 == 0 else [rnd.gauss(70, 15)])))
    arrive = sorted(rows, key=lambda r: r[1] + dt.timedelta(seconds=rnd.randrange(590)))
    table = spark.createDataFrame(rows, ROW)
    batch = kpi.kpi_window_features(table, 80.0, 3600, 21_600).cache()
    columns = ["kpi_mean", "kpi_std", "kpi_trend", "kpi_pct_change_1h", "kpi_pct_change_24h", "kpi_z_score"]
    forest = models.IsolationForest(columns, trees=20).fit(batch, 0.05)
    for half in range(2):  # stopped and started again
        for k in range(2):
            at = 250 * half + 125 * k
            spark.createDataFrame(arrive[at : at + 125] + ([(9, T0, 1.0)] if at == 250 else []), ROW).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        stream = spark.readStream.schema(ROW).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        found = streams.score_kpi_stream(kpifeatures.kpi_feature_stream(stream, 80.0, 3600, 21_600), forest)
        found.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start().awaitTermination()
    mark = max(r[1] for r in rows) - dt.timedelta(minutes=10)
    got, want = spark.read.parquet(f"{tmp_path}/out"), forest.score(batch)
    assert len(key(want, mark)) > 480 and key(got) == key(want, mark)


def test_windows_of_one_series():
    us = [0, 10, 10, 25]
    got = list(kpifeatures.windows(us, [1.0, 3.0, 5.0, None], 0, 15, 100, 2))
    assert got[0] == (None, None, None, None, None, 0.0)
    assert got[1][:1] == (3.0,) and got[1][2:5] == (1.0, 5.0, 3.0) and got[2][5] == 2.0
    assert got[3] == (None, None, None, None, 3.0, 2.0)  # the two at 10 are 15 before


def test_odd_rows(spark, tmp_path):
    rows = [(None, T0, 1.0), (1, None, 1.0), (1, T0, None), (2, T0 + dt.timedelta(days=2), 5.0)]
    spark.createDataFrame(rows, ROW).coalesce(1).write.parquet(f"{tmp_path}/in")
    found = kpifeatures.kpi_feature_stream(spark.readStream.schema(ROW).parquet(f"{tmp_path}/in"))
    found.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/state").trigger(availableNow=True).start().awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out").collect()
    assert [(r.ne_id, r.kpi_mean, r.kpi_z_score) for r in got] == [(1, None, None)]
