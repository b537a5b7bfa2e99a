"""Helpers that several operators share."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only where none is named and all runs in one process."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if folder is None and not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
        sc.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spark-"))
    return sc.getCheckpointDir()


@contextmanager
def swept(spark: SparkSession) -> Iterator[None]:
    """Queries made inside delete the files of their shuffles as soon as they have run, not when the driver next
    collects its garbage."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def cut(df: DataFrame) -> DataFrame:
    """The same rows with their lineage cut: written to the shared checkpoint folder, so a lost executor costs
    no recomputation of what came before."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def stored(df: DataFrame, folder: str | None = None) -> DataFrame:
    """The same rows, written as Parquet in the shared checkpoint folder, or under ``folder``: as `cut`, but packed and read by
    column. The files of the query's shuffles are deleted."""
    path = f"{folder or checkpoint_dir(df.sparkSession)}/stored-{uuid.uuid4()}"
    with swept(df.sparkSession):
        df.select("*").write.parquet(path)  # the setting counts for queries made under it
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[str]:
    """A folder for `stored`, deleted at the end with all tables in it; queries made inside delete the files of their
    shuffles. So what a job leaves on disk doesn't wait for the driver to collect its garbage."""
    folder = f"{checkpoint_dir(spark)}/scratch-{uuid.uuid4()}"
    try:
        with swept(spark):
            yield folder
    finally:
        deleted(spark, folder)


def deleted(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


#: Tables of at most so many rows are broadcast.
SMALL = 100_000


def small(df: DataFrame, limit: int = SMALL) -> DataFrame:
    """The rows, written and counted; marked for broadcast if they are few, else left to a shuffled join."""
    df = cut(df)
    return F.broadcast(df) if df.count() <= limit else df


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the Python workers, once per application, so that they need no copy of their own.
    Spark serves the file from the driver to every executor."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    path = Path(tempfile.mkdtemp(prefix="spark-"), f"{package.name}.zip")
    with zipfile.ZipFile(path, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f.relative_to(package.parent))
    sc.addPyFile(str(path))
    _shipped.add(sc.applicationId)
