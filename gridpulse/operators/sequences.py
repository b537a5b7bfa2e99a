"""Alarm sequences as fixed-length arrays of numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .shared import small

PAD, UNKNOWN = 0, 1


def build_vocab(incidents: DataFrame, sequence: str = "alarm_sequence") -> DataFrame:
    """code, index: the distinct trimmed codes in order, from 2. The window runs over a row per code."""
    codes = incidents.select(F.explode(sequence).alias("code")).select(F.trim("code").alias("code")).where("code != ''").distinct()
    return codes.select("code", (F.row_number().over(W.orderBy("code")) + 1).cast("int").alias("index"))


def encode_sequences(incidents: DataFrame, vocab: DataFrame, length: int = 20, key: str = "incident", sequence: str = "alarm_sequence") -> DataFrame:
    """The incidents with indices: the last ``length`` codes by the vocabulary, padded on the left. Only those codes
    are looked up."""
    steps = incidents.select(key, F.posexplode(F.slice(sequence, F.greatest(F.size(sequence) - length + 1, F.lit(1)), length)).alias("at", "code"))
    coded = (
        steps.withColumn("code", F.trim("code"))
        .join(small(vocab), "code", "left")
        .groupBy(key)
        .agg(F.transform(F.sort_array(F.collect_list(F.struct("at", F.coalesce("index", F.lit(UNKNOWN)).alias("i")))), lambda x: x["i"]).alias("some"))
    )
    some = F.coalesce("some", F.array().cast("array<int>"))
    padded = F.concat(F.array_repeat(F.lit(PAD), length - F.size(some)), some)
    return incidents.join(coded, key, "left").withColumn("indices", padded).drop("some")


def label_index(label: str, labels: Sequence[str]):
    """The place of a label among the labels; others count as UNKNOWN, or as the first if there is no such label."""
    other = labels.index("UNKNOWN") if "UNKNOWN" in labels else 0
    out = F.lit(other)
    for i, name in enumerate(labels):
        out = F.when(F.trim(label) == name, F.lit(i)).otherwise(out)
    return out
