"""Sessions of alarms and the codes in them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import cut


def seconds(c: Column) -> Column:
    return F.unix_micros(c) / 1e6


def running_number(df: DataFrame, starts: Column, time: str, tie: str, bucket: str = "hour", keys: Sequence[str] = ()) -> DataFrame:
    """Adds ``number``: how many rows of the same keys up to this one, in order of (time, tie), are starts. Rows are
    summed within time buckets; only the table of buckets, a row for each, is summed over all of a key's time."""
    df = df.withColumn("__b", F.date_trunc(bucket, time)).withColumn("__s", starts.cast("long"))
    sums = df.groupBy(*keys, "__b").agg(F.sum("__s").alias("__n"))
    sums = sums.select(*keys, "__b", (F.sum("__n").over(W.partitionBy(*keys).orderBy("__b")) - F.col("__n")).alias("__before"))
    inner = F.sum("__s").over(W.partitionBy(*keys, "__b").orderBy(time, tie).rowsBetween(W.unboundedPreceding, 0))
    return df.withColumn("__i", inner).join(sums, [*keys, "__b"]).withColumn("number", F.col("__before") + F.col("__i")).drop("__b", "__s", "__i", "__before")


def with_previous(df: DataFrame, columns: Sequence[str], time: str, tie: str, bucket: str = "hour", keys: Sequence[str] = ()) -> DataFrame:
    """Adds ``previous``, a struct of the columns of the row before of the same keys, in order of (time, tie). Only the
    first row of a time bucket looks into the table of buckets."""
    df = df.withColumn("__b", F.date_trunc(bucket, time))
    fields = F.struct(*columns)
    last = df.groupBy(*keys, "__b").agg(F.max_by(fields, F.struct(time, tie)).alias("__last"))
    last = last.select(*keys, "__b", F.lag("__last").over(W.partitionBy(*keys).orderBy("__b")).alias("__last"))
    inner = F.lag(fields).over(W.partitionBy(*keys, "__b").orderBy(time, tie))
    return df.withColumn("__i", inner).join(last, [*keys, "__b"]).withColumn("previous", F.coalesce("__i", "__last")).drop("__b", "__i", "__last")


def sessionize(alarms: DataFrame, gap: int = 1800, partition_by: Sequence[str] = (), time: str = "alarm_time", tie: str = "alarm_id") -> DataFrame:
    """Adds session_id: a new session starts where the gap to the row before exceeds ``gap`` seconds (an equal gap
    stays together). With keys, session_id is a string of the keys and a number within them."""
    if partition_by:
        order = W.partitionBy(*partition_by).orderBy(time, tie)
        apart = F.coalesce(seconds(F.col(time)) - seconds(F.lag(time).over(order)) > gap, F.lit(True))
        df = alarms.withColumn("__apart", apart)
        number = F.sum(F.col("__apart").cast("long")).over(order.rowsBetween(W.unboundedPreceding, 0))
        return df.withColumn("session_id", F.concat_ws("#", *partition_by, number)).drop("__apart")
    df = with_previous(alarms, [time], time, tie)
    apart = F.coalesce(seconds(F.col(time)) - seconds(F.col(f"previous.{time}")) > gap, F.lit(True))
    df = cut(df.withColumn("__apart", apart).drop("previous"))
    return running_number(df, F.col("__apart"), time, tie).withColumn("session_id", F.col("number").cast("string")).drop("number", "__apart")


def session_codes(sessions: DataFrame, time: str = "alarm_time", tie: str = "alarm_id") -> DataFrame:
    """session_id, code, place (by first occurrence), first, last for sessions of two alarms or more."""
    many = sessions.groupBy("session_id").agg(F.count("*").alias("n")).where("n > 1").select("session_id")
    codes = (
        sessions.join(many, "session_id", "left_semi")
        .groupBy("session_id", F.col("alarm_code").alias("code"))
        .agg(F.min(F.struct(time, tie)).alias("first"), F.max(time).alias("last"))
    )
    place = F.row_number().over(W.partitionBy("session_id").orderBy("first"))
    return codes.withColumn("place", place).select("session_id", "code", "place", F.col(f"first.{time}").alias("first"), "last")
