"""Column resolution and row filters for tables whose names differ from site to site."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The names under which each alarm field may be found, in order of preference.
ALARM_ALIASES = {
    "ne_id": ("NE_ID_FK", "NE_ID", "ENTITY_ID", "NETWORK_ELEMENT_ID_FK", "NETWORK_ELEMENT_ID", "SOURCE_NE_ID", "MANAGED_OBJECT_ID", "NODE_ID", "ELEMENT_ID"),
    "alarm_code": ("ALARM_CODE", "ALARM_TYPE", "EVENT_TYPE", "FAULT_CODE", "SPECIFIC_PROBLEM", "ALARM_NAME", "ALARM_IDENTIFIER", "PROBABLE_CAUSE", "OID"),
    "severity": ("SEVERITY", "PERCEIVED_SEVERITY", "ALARM_SEVERITY", "PRIORITY", "IMPACT_LEVEL"),
    "timestamp": ("ALARM_TIME", "OPEN_TIME", "CREATION_TIME", "EVENT_TIME", "RAISED_AT", "OCCURRENCE_TIME", "FIRST_OCCURRENCE_TIME", "NOTIFICATION_TIME", "CREATION_DATE"),
    "root_cause": ("ROOT_CAUSE", "CAUSE_CODE", "PROBABLE_CAUSE", "FAULT_CAUSE", "RESOLUTION_CAUSE", "CORRECTIVE_ACTION_CODE", "FAILURE_CAUSE", "CAUSE", "ROOT_CAUSE_LABEL"),
    "status": ("STATUS", "ALARM_STATUS", "STATE", "LIFECYCLE_STATE", "CLEARANCE_STATUS", "ACKED"),
    "clear_time": ("CLEAR_TIME", "CLOSURE_TIME", "CLEARED_AT", "RESOLUTION_TIME", "LAST_OCCURRENCE_TIME", "END_TIME", "CLOSE_TIME"),
    "ne_type": ("NE_TYPE", "NETWORK_ELEMENT_TYPE", "MANAGED_OBJECT_CLASS", "ELEMENT_TYPE", "OBJECT_TYPE"),
    "domain": ("DOMAIN", "NE_DOMAIN", "NETWORK_DOMAIN", "TECHNOLOGY_DOMAIN"),
}
# End of fixed values.


def find_columns(columns: Sequence[str], aliases: Mapping[str, Sequence[str]] = ALARM_ALIASES, fallback: Mapping[str, str] | None = None) -> dict[str, str]:
    """Field to column: the first alias that is there in any case, else the configured column if it is there."""
    there = {c.upper(): c for c in columns}
    out = {}
    for field, names in aliases.items():
        configured = (fallback or {}).get(field)
        for name in (*names, *([configured] if configured else [])):
            if name.upper() in there:
                out[field] = there[name.upper()]
                break
    return out


def resolve_columns(df: DataFrame, aliases: Mapping[str, Sequence[str]] = ALARM_ALIASES, fallback: Mapping[str, str] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """One select with each field under its canonical name, null where no column stands for it."""
    found = find_columns(df.columns, aliases, fallback)
    fields = [(F.col(found[f]) if f in found else F.lit(None).cast("string")).alias(f) for f in aliases]
    return df.select(*[F.col(k) for k in keep], *fields)


def ensure_columns(df: DataFrame, defaults: Mapping[str, Column]) -> DataFrame:
    """Adds those columns that aren't there."""
    return df.withColumns({c: v for c, v in defaults.items() if c not in df.columns})


def active_only(df: DataFrame) -> DataFrame:
    """Rows that are not marked as deleted or disabled, by whichever of the marks the table has."""
    for c, want in (("IS_DELETED", 0), ("DELETED", 0), ("ENABLED", 1)):
        if c in df.columns:
            df = df.where(F.col(c) == want)
    return df
