"""Sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_table(df: DataFrame, path: str, time: str | None = None, mode: str = "overwrite") -> None:
    """Parquet, with a folder per day of ``time`` if given."""
    if time is None:
        df.write.mode(mode).parquet(path)
    else:
        df.withColumn("day", F.to_date(time)).write.mode(mode).partitionBy("day").parquet(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).csv(path, header=True, escape='"')


def nest_rules(rules: DataFrame) -> DataFrame:
    """antecedent, rules: its rules as an array, the most confident first."""
    order = F.struct((-F.col("confidence")).alias("o"), "consequent", "confidence", "support", "count", "avg_delay_sec", "std_delay_sec", "min_delay_sec", "max_delay_sec")
    nested = F.transform(F.sort_array(F.collect_list(order)), lambda r: r.dropFields("o"))
    return rules.groupBy("antecedent").agg(nested.alias("rules"))


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def export_entity_features(features: DataFrame, columns: Sequence[str], key: str = "NE_ID") -> DataFrame:
    """entity_id and features, an array in the given order; what is missing or no number is 0.0, entities
    without an id are left out."""
    def number(c: str):
        return F.coalesce(F.col(c).cast("string").try_cast("double"), F.lit(0.0)) if c in features.columns else F.lit(0.0)

    return features.where(F.trim(key) != "").select(F.trim(key).alias("entity_id"), F.array(*[number(c) for c in columns]).alias("features"))


def missing_features(features: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if c not in features.columns]
