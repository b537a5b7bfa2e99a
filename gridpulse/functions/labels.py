"""Root-cause labels from alarm texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.shared import small

# The keyword tests of the label rules, in their order; the first that matches decides.
OUTAGE_RULES = (
    ("POWER_ISSUE", ("power", "fru", "supply")),
    ("LINK_CONGESTION", ("link", "optical", "fiber")),
)
DETERIORATION_RULES = (("PACKET_LOSS", ("error", "rate", "loss")),)
IDENTIFIER_RULES = (
    ("POWER_ISSUE", ("power", "supply", "voltage", "ups")),
    ("HARDWARE_FAILURE", ("fru", "fabric", "frupower", "frufailed", "fruoffline", "fruremoval")),
    ("LINK_CONGESTION", ("optical", "osnr", "bit_error", "fiber", "opticalpower")),
    ("BACKHAUL_ISSUE", ("backhaul", "cell", "ran", "lte", "5g")),
    ("CONFIGURATION_ERROR", ("ospf", "bgp", "isis", "lldp", "config", "auth", "statechange", "retransmit", "neighbor")),
    ("INTERFACE_ERROR", ("interface", "ifstate", "ifconfig", "ifauth", "ifrx", "iftx")),
    ("PACKET_LOSS", ("drop", "loss", "overflow", "congestion", "utilization")),
    ("LATENCY_HIGH", ("latency", "delay", "timeout", "detectiontime")),
    ("CONFIGURATION_ERROR", ("trap", "flooding", "snmp")),
)
FREE_TEXT_RULES = (
    ("POWER_ISSUE", ("power", "supply", "voltage")),
    ("HARDWARE_FAILURE", ("hardware", "fru", "fabric", "chassis")),
    ("CONFIGURATION_ERROR", ("ospf", "bgp", "config", "trap", "state")),
    ("LINK_CONGESTION", ("link", "optical", "fiber", "interface")),
)
# End of fixed values.


def _first_match(text: Column, rules: Sequence[tuple[str, Sequence[str]]], otherwise: str) -> Column:
    out = F.lit(otherwise)
    for label, keys in reversed(rules):
        hit = F.lit(False)
        for key in keys:
            hit = hit | text.contains(key)
        out = F.when(hit, F.lit(label)).otherwise(out)
    return out


def library_root_cause(identifier: Column, classification: Column, valid: Sequence[str] | None = None) -> Column:
    """The label of a library entry; labels outside ``valid``, if given, become UNKNOWN."""
    ident, cls = F.lower(identifier), F.upper(F.coalesce(classification, F.lit("")))
    label = (
        F.when(identifier.isNull(), F.lit("UNKNOWN"))
        .when(cls.contains("OUTAGE"), _first_match(ident, OUTAGE_RULES, "HARDWARE_FAILURE"))
        .when(cls.contains("DETERIORATION"), _first_match(ident, DETERIORATION_RULES, "LINK_CONGESTION"))
        .otherwise(_first_match(ident, IDENTIFIER_RULES, "UNKNOWN"))
    )
    if not valid:
        return label
    return F.when(label.isin(*valid), label).otherwise(F.lit("UNKNOWN"))


def raw_root_cause(text: Column) -> Column:
    """The label of a free-text cause; blank and null texts are UNKNOWN."""
    blank = text.isNull() | (F.trim(text) == "")
    return F.when(blank, F.lit("UNKNOWN")).otherwise(_first_match(F.lower(text), FREE_TEXT_RULES, "UNKNOWN"))


def label_alarms(alarms: DataFrame, library: DataFrame, min_raw_share: float = 0.1, valid: Sequence[str] | None = None) -> DataFrame:
    """Adds root_cause: from probable_cause if more than ``min_raw_share`` of the alarms have one, else from the
    library by alarm code. The library is deduplicated by code first, so no alarm is multiplied."""
    n, raw = alarms.agg(F.count("*"), F.count("probable_cause")).first()
    if n and raw > n * min_raw_share:
        return alarms.withColumn("root_cause", raw_root_cause(F.col("probable_cause")))
    known = library.groupBy(F.col("alarm_code").cast("string").alias("alarm_code")).agg(
        F.min(F.struct(library_root_cause(F.col("alarm_identifier"), F.col("classification"), valid).alias("label"))).alias("entry")
    )
    return (
        alarms.withColumn("alarm_code", F.col("alarm_code").cast("string"))
        .join(small(known), "alarm_code", "left")
        .withColumn("root_cause", F.coalesce("entry.label", F.lit("UNKNOWN")))
        .drop("entry")
    )
