"""Master features, training sets and feature arrays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.elements import static_features
from .graph import graph_features, hierarchy_features
from .links import link_health

# The declared model features, in order.
FEATURES = (
    "NE_TYPE_ENC", "TECHNOLOGY_ENC", "VENDOR_ENC", "DOMAIN_ENC", "NE_STATUS_ENC", "OPERATIONAL_STATE_ENC", "CATEGORY_ENC",
    "NE_STAGE_ENC", "ADMIN_STATE_ENC", "NE_AGE_DAYS", "WARRANTY_REMAINING_DAYS", "WARRANTY_EXPIRED", "TECH_GENERATION",
    "IS_VIRTUAL_NUM", "IS_SECURED_NUM", "BGP_STATUS_NUM", "OSPF_STATUS_NUM", "LLDP_STATUS_NUM", "PROTOCOL_HEALTH_SCORE",
    "GRAPH_DEGREE", "BETWEENNESS", "CLUSTERING_COEF", "COMPONENT_SIZE", "IS_LEAF", "IS_ISOLATED", "TOPO_LAYER",
    "HIERARCHY_DEPTH", "IS_ROOT_NODE", "GEO_COMPLETENESS", "GEOGRAPHY_L1_ID_FK", "GEOGRAPHY_L2_ID_FK", "GEOGRAPHY_L3_ID_FK",
    "GEOGRAPHY_L4_ID_FK", "SRC_MAX_UTILIZATION", "SRC_AVG_UTILIZATION", "SRC_MAX_ERROR_RATE", "SRC_MAX_DROP_RATE",
    "SRC_CRITICAL_LINKS", "SRC_WARNING_LINKS", "DST_MAX_UTILIZATION", "DST_MAX_ERROR_RATE", "LINK_HEALTH_SCORE",
    "AZIMUTH", "ELECTRICAL_TILT", "MECHANICAL_TILT",
)
# End of fixed values.


def build_master_features(elements: DataFrame, links: DataFrame, pivots: int = 0, seed: int = 0, graph: DataFrame | None = None) -> DataFrame:
    """Every element with its static, graph, hierarchy and link features; elements without links have zeros. ``graph``: the
    graph features, where they are known already."""
    health = link_health(links)
    hierarchy = hierarchy_features(elements)
    hierarchy = hierarchy.drop(*[c for c in hierarchy.columns if c != "ID" and c in elements.columns])
    df = (
        static_features(elements)
        .join(graph_features(elements, links, pivots, seed) if graph is None else graph, "ID", "left")
        .join(hierarchy, "ID", "left")
        .join(health, "ID", "left")
    )
    return df.fillna(0, subset=[c for c in health.columns if c != "ID"])


def training_set(alarms: DataFrame, master: DataFrame, key: str = "entity_id", label: str = "root_cause") -> DataFrame:
    """Labelled alarms with their element's features: by NE_ID if the key is a string, else by number."""
    master = master.drop(*[c for c in alarms.columns if c in master.columns and c != "NE_ID"])
    if dict(alarms.dtypes)[key] == "string":
        found = alarms.join(master, F.col(key) == master["NE_ID"])
    else:
        found = alarms.withColumn(key, F.col(key).cast("long")).dropna(subset=[key]).join(master, F.col(key) == master["ID"])
    return found.dropna(subset=[label])


def enrich_alarms(alarms: DataFrame, master: DataFrame, key: str = "entity_id") -> tuple[DataFrame, DataFrame]:
    """Alarms with features of their element, and those without an element. Elements are deduplicated by NE_ID."""
    lookup = master.withColumnRenamed("NE_ID", "__ne").dropDuplicates(["__ne"])
    lookup = lookup.drop(*[c for c in alarms.columns if c in lookup.columns])
    return (
        alarms.join(lookup, alarms[key] == F.col("__ne")).drop("__ne"),
        alarms.join(lookup.select("__ne"), alarms[key] == F.col("__ne"), "left_anti"),
    )


def assemble(df: DataFrame, columns: Sequence[str], out: str = "features") -> DataFrame:
    """An array of the columns in order; nulls, numbers that aren't and absent columns are 0."""
    def number(c: str):
        x = F.col(c).cast("string").try_cast("double")
        return F.coalesce(F.nanvl(x, F.lit(0.0)), F.lit(0.0)) if c in df.columns else F.lit(0.0)

    return df.withColumn(out, F.array(*[number(c) for c in columns]))


def standardize(df: DataFrame, columns: Sequence[str], eps: float = 1e-6) -> DataFrame:
    """(x - mean) / (population deviation + eps) for each column, nulls as 0; the statistics are one row."""
    x = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in columns}
    stats = df.agg(F.struct(*[F.struct(F.avg(x[c]).alias("m"), F.stddev_pop(x[c]).alias("s")).alias(c) for c in columns]).alias("s")).scalar()
    return df.withColumns({c: (x[c] - stats[c]["m"]) / (stats[c]["s"] + eps) for c in columns})


def feature_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """feature, known, lowest, mean, highest: one row per column, from one pass."""
    rows = df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x")) for c in columns])).alias("e"))
    return rows.groupBy("e.feature").agg(F.count("e.x").alias("known"), F.min("e.x").alias("lowest"), F.avg("e.x").alias("mean"), F.max("e.x").alias("highest"))


def node_labels(alarms: DataFrame, elements: DataFrame, default: str = "UNKNOWN") -> DataFrame:
    """ID, label: the most frequent root cause of each element's alarms, the smallest of equals; by NE_ID, or by ID
    where the entity is a number."""
    modal = alarms.groupBy("entity_id").agg(F.mode("root_cause", True).alias("label"))
    ids = elements.select("NE_ID", "ID").dropDuplicates(["NE_ID"])
    named = modal.join(ids, modal["entity_id"] == ids["NE_ID"], "left").select(F.coalesce("ID", F.col("entity_id").try_cast("bigint")).alias("ID"), "label")
    one = named.where("ID is not null").groupBy("ID").agg(F.min("label").alias("label"))
    return elements.select("ID").join(one, "ID", "left").fillna(default, subset=["label"])
