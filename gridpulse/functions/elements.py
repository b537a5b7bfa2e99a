"""Static features of network elements."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.shared import SMALL, cut

# Generation by technology, status codes, severity codes.
GENERATIONS = {
    "GSM": 2, "T2G": 2, "UMTS": 3, "T3G": 3, "LTE": 4, "T4G": 4, "FDD": 4, "TDD": 4, "T5G": 5, "T4G_T5G": 5,
    "TDD10": 5, "TDD20": 5, "FIBER": 0, "Wireline": 0, "WIFI": 0, "COMMON": 0, "HARDWARE": 0,
}
STATUSES = {"UP": 1, "DOWN": 0, "YET_TO_START": -1}
SEVERITIES = {"HEALTHY": 0, "WARNING": 1, "CRITICAL": 2}
# End of fixed values.

CATEGORICAL = ("NE_TYPE", "TECHNOLOGY", "VENDOR", "DOMAIN", "NE_STATUS", "OPERATIONAL_STATE", "CATEGORY", "NE_STAGE", "ADMIN_STATE", "NE_CATEGORY")


def lookup(c: Column, values: dict[str, int], missing: int = 0) -> Column:
    pairs = [F.lit(x) for kv in values.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), c), F.lit(missing))


def tech_generation(technology: Column) -> Column:
    return lookup(technology, GENERATIONS)


def protocol_health(*statuses: Column) -> Column:
    """Sum of the status codes; an unknown status counts as -1."""
    total = F.lit(0)
    for s in statuses:
        total = total + lookup(s, STATUSES, -1)
    return total


def days_between(later: Column, earlier: Column) -> Column:
    """Whole days, rounded down."""
    return F.floor((F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))) / 86_400_000_000).cast("long")


def ne_age_features(df: DataFrame, as_of: str) -> DataFrame:
    """NE_AGE_DAYS (-1 if unknown), WARRANTY_REMAINING_DAYS (-999) and WARRANTY_EXPIRED at a given time."""
    now = F.lit(as_of).cast("timestamp")
    remaining = F.coalesce(days_between(F.col("WARRANTY_DATE"), now), F.lit(-999))
    made = F.coalesce("MANUFACTURE_DATE", "CREATED_TIME") if "CREATED_TIME" in df.columns else F.col("MANUFACTURE_DATE")
    return (
        df.withColumn("NE_AGE_DAYS", F.coalesce(days_between(now, made), F.lit(-1)))
        .withColumn("WARRANTY_REMAINING_DAYS", remaining)
        .withColumn("WARRANTY_EXPIRED", (remaining < 0).cast("int"))
    )


def encode_categoricals(df: DataFrame, columns: Sequence[str] = CATEGORICAL) -> DataFrame:
    """<column>_ENC: the place of the value among the column's sorted values, null as 'UNKNOWN'; 0 for a column
    that isn't there. All columns' values are found in one pass, a row per distinct value, and broadcast if they
    are few."""
    present = [c for c in columns if c in df.columns]
    for c in columns:
        if c not in present:
            df = df.withColumn(f"{c}_ENC", F.lit(0))
    if not present:
        return df
    value = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("UNKNOWN"))
    values = (
        df.select(F.explode(F.array(*[F.struct(F.lit(c).alias("c"), value(c).alias("v")) for c in present])).alias("x"))
        .select("x.*")
        .distinct()
        .withColumn("enc", F.row_number().over(W.partitionBy("c").orderBy("v")) - 1)
    )
    values = cut(values)
    few = values.count() <= SMALL
    for c in present:
        codes = values.where(F.col("c") == c).select(F.col("v").alias("__v"), F.col("enc").alias(f"{c}_ENC"))
        codes = F.broadcast(codes) if few else codes
        df = df.join(codes, value(c) == F.col("__v"), "left").drop("__v")
    return df


def static_features(df: DataFrame) -> DataFrame:
    """Encoded categories, flags and technology generation; missing source columns count as absent values."""
    def flag(c: str) -> Column:
        return F.coalesce(F.col(c).cast("int"), F.lit(0)) if c in df.columns else F.lit(0)

    parent = F.col("PARENT_NE_ID_FK").isNotNull().cast("int") if "PARENT_NE_ID_FK" in df.columns else F.lit(0)
    return (
        encode_categoricals(df)
        .withColumn("IS_VIRTUAL_NUM", flag("IS_VIRTUAL"))
        .withColumn("IS_SECURED_NUM", flag("IS_SECURED"))
        .withColumn("HAS_PARENT", parent)
        .withColumn("TECH_GENERATION", tech_generation(F.col("TECHNOLOGY")))
    )
