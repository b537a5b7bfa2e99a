"""Incident reports from scored alarms (alarm_id, open_time, entity_id, alarm_code, severity, predicted_root_cause,
confidence, incident)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .graph import k_hop, undirected_edges


def incident_report(scored: DataFrame) -> DataFrame:
    """A row per incident: window, whole minutes, histograms, primary cause (the smallest of the most frequent),
    confidences. Histograms are counted in two steps, so a large incident is a few rows."""
    base = scored.groupBy("incident").agg(
        F.min("open_time").alias("from"),
        F.max("open_time").alias("to"),
        F.count("*").alias("alarm_count"),
        F.avg("confidence").alias("avg_confidence"),
        F.max("confidence").alias("max_confidence"),
        F.count_distinct("entity_id").alias("entities"),
    )
    counts = scored.groupBy("incident", F.col("predicted_root_cause").alias("v")).agg(F.count("*").alias("n"))
    best = counts.groupBy("incident").agg(F.max("n").alias("n"))
    primary = counts.join(best, ["incident", "n"]).groupBy("incident").agg(F.min("v").alias("primary_root_cause"))

    def histogram(value: Column, name: str) -> DataFrame:
        c = scored.groupBy("incident", value.alias("v")).agg(F.count("*").alias("n"))
        return c.groupBy("incident").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("v", "n")))).alias(name))

    minutes = F.floor((F.unix_micros("to") - F.unix_micros("from")) / 60_000_000).cast("long")
    return (
        base.withColumn("duration_minutes", minutes)
        .join(histogram(F.coalesce("predicted_root_cause", F.lit("UNKNOWN")), "root_cause_distribution"), "incident")
        .join(histogram(F.upper(F.coalesce("severity", F.lit("UNKNOWN"))), "severity_distribution"), "incident")
        .join(primary, "incident", "left")
        .withColumn("primary_root_cause", F.coalesce("primary_root_cause", F.lit("UNKNOWN")))
    )


def top_k(df: DataFrame, by: list[Column], k: int) -> DataFrame:
    return df.orderBy(*by).limit(k)


def top_incidents(scored: DataFrame, n: int = 100) -> DataFrame:
    """incident, alarm_count, number (INC-0001 for the largest; ties by incident) of the n largest."""
    sizes = scored.groupBy("incident").agg(F.count("*").alias("alarm_count"))
    order = [F.desc("alarm_count"), F.col("incident")]
    ranked = top_k(sizes, order, n).withColumn("rank", F.row_number().over(W.orderBy(*order)))  # n rows
    return ranked.select("incident", "alarm_count", F.format_string("INC-%04d", "rank").alias("number"))


def global_summary(scored: DataFrame) -> DataFrame:
    """metric, item, value: totals, histograms and the 20 entities with the most alarms."""
    total = scored.agg(F.count("*").cast("double").alias("alarms"), F.count_distinct("incident").cast("double").alias("incidents"), F.avg("confidence").alias("conf"))
    rows = F.array(*[F.struct(F.lit(m).alias("metric"), F.lit("").alias("item"), F.col(c).alias("value")) for m, c in (("total_alarms", "alarms"), ("total_incidents", "incidents"), ("avg_confidence", "conf"))])
    out = total.select(F.explode(rows).alias("r")).select("r.*")

    def counts(metric: str, value: Column) -> DataFrame:
        return scored.groupBy(value.alias("item")).agg(F.count("*").cast("double").alias("value")).select(F.lit(metric).alias("metric"), "item", "value")

    out = out.union(counts("root_cause", F.col("predicted_root_cause"))).union(counts("severity", F.upper("severity")))
    return out.union(top_k(counts("top_entity", F.col("entity_id")), [F.desc("value"), F.col("item")], 20))


def top_causes(scored: DataFrame, k: int = 10) -> DataFrame:
    return top_k(scored.groupBy("predicted_root_cause").agg(F.count("*").alias("n")), [F.desc("n"), F.col("predicted_root_cause")], k)


def incident_ne_details(scored: DataFrame, master: DataFrame) -> DataFrame:
    """incident, ne_id and the element's attributes, null for unknown elements."""
    pairs = scored.select("incident", F.col("entity_id").alias("ne_id")).distinct()
    names = [c for c in ("NE_NAME", "NE_TYPE", "TECHNOLOGY", "VENDOR", "DOMAIN", "TOPO_LAYER", "GRAPH_DEGREE") if c in master.columns]
    details = master.select(F.col("NE_ID").alias("ne_id"), *[F.col(c).alias(c.lower()) for c in names]).dropDuplicates(["ne_id"])
    return pairs.join(details, "ne_id", "left")


def at_risk_elements(scored: DataFrame, elements: DataFrame, links: DataFrame, hops: int = 2) -> DataFrame:
    """incident, ne_id: elements within some hops of an incident's elements that are not in it."""
    ids = elements.select("ID", "NE_ID")
    starts = scored.select("incident", "entity_id").distinct().join(ids, F.col("entity_id") == F.col("NE_ID")).select(F.col("incident").alias("group"), F.col("ID").alias("node"))
    near = k_hop(starts, undirected_edges(links), hops).where("hop > 0")
    return near.join(ids, near["node"] == ids["ID"]).select(F.col("group").alias("incident"), F.col("NE_ID").alias("ne_id"), "hop")


def write_report(scored: DataFrame, rules: DataFrame, master: DataFrame, elements: DataFrame, links: DataFrame, n: int = 100) -> DataFrame:
    """A nested row for each of the n largest incidents, ready for JSON."""
    some = scored.join(top_incidents(scored, n).select("incident", "number"), "incident")
    alarms = F.struct("open_time", "alarm_id", "entity_id", "alarm_code", "severity", "predicted_root_cause", "confidence")
    nested = some.groupBy("incident", "number").agg(F.sort_array(F.collect_list(alarms)).alias("alarms"))
    details = incident_ne_details(some, master)
    inner = F.struct(*[c for c in details.columns if c != "incident"])
    elements_of = details.groupBy("incident").agg(F.sort_array(F.collect_list(inner)).alias("affected_elements"))
    risk = at_risk_elements(some, elements, links).groupBy("incident").agg(F.sort_array(F.collect_set("ne_id")).alias("at_risk"))
    codes = some.select("incident", "alarm_code").distinct().join(rules, F.col("alarm_code") == F.col("antecedent"))
    rule = F.struct(F.col("alarm_code").alias("source"), F.col("consequent").alias("target"), "confidence", "count")
    expected = codes.groupBy("incident").agg(F.sort_array(F.collect_list(rule)).alias("propagation"))
    out = nested.join(incident_report(some), "incident").join(elements_of, "incident", "left")
    return out.join(risk, "incident", "left").join(expected, "incident", "left")
