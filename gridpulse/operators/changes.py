"""Change detection and incremental runs."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def table_fingerprint(df: DataFrame, key: str) -> DataFrame:
    """n, key_sum, row_hash (a sum over rows, so order doesn't matter) and fingerprint, their MD5; one row."""
    names = sorted(df.columns)
    row = F.conv(F.substring(F.md5(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("~")) for c in names])), 1, 10), 16, 10).cast("long")
    sums = df.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.col(key).cast("long")), F.lit(0)).alias("key_sum"), F.coalesce(F.sum(row), F.lit(0)).alias("row_hash"))
    return sums.withColumn("fingerprint", F.md5(F.concat_ws(":", "n", "key_sum", "row_hash")))


def changes_since(alarms: DataFrame, last_run: str, threshold: int = 100, time: str = "alarm_time") -> DataFrame:
    """new_alarms and retrain_needed; one row."""
    new = alarms.where(F.col(time) > F.lit(last_run).cast("timestamp")).agg(F.count("*").alias("new_alarms"))
    return new.withColumn("retrain_needed", F.col("new_alarms") > threshold)


def load_summary(tables: Mapping[str, DataFrame], label: str = "root_cause") -> DataFrame:
    """table, n, labelled; a row per table."""
    out = None
    for name, df in tables.items():
        labelled = F.count(label) if label in df.columns else F.lit(0).cast("long")
        row = df.agg(F.lit(name).alias("table"), F.count("*").alias("n"), labelled.alias("labelled"))
        out = row if out is None else out.union(row)
    return out


@dataclass
class State:
    """What the last run saw; None before the first."""

    elements: str | None = None
    links: str | None = None
    last_alarm: str | None = None


def incremental_run(elements: DataFrame, links: DataFrame, alarms: DataFrame, state: State, on_topology: Callable[[], None], on_alarms: Callable[[], None], threshold: int = 100) -> tuple[State, list[str]]:
    """Runs only the jobs whose inputs have changed: features and classifier for elements or links, rules for more
    than ``threshold`` alarms later than the last. Returns the new state and what ran."""
    seen = State(
        table_fingerprint(elements, "ID").first().fingerprint,
        table_fingerprint(links, "src").first().fingerprint,
        alarms.agg(F.max("alarm_time").cast("string")).first()[0] or state.last_alarm,
    )
    ran = []
    if (seen.elements, seen.links) != (state.elements, state.links):
        on_topology()
        ran.append("topology")
    new = changes_since(alarms, state.last_alarm or "1970-01-01", threshold).first()
    if new.retrain_needed:
        on_alarms()
        ran.append("alarms")
    else:
        seen.last_alarm = state.last_alarm
    return seen, ran
