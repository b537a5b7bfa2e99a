"""Rolling features of KPI series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

PEAK_HOURS = (9, 10, 11, 19, 20, 21)


def kpi_window_features(kpi: DataFrame, threshold: float = 80.0, short: int = 3600, long: int = 86_400, min_points: int = 3) -> DataFrame:
    """One row per measurement with mean, deviation, extremes, trend, changes against the rolling means, z-score,
    threshold and calendar features. Windows are half open, (t - w, t], in seconds; all share one sort."""
    us = F.unix_micros("ts")
    by = W.partitionBy("ne_id").orderBy("us")
    near = by.rangeBetween(-(short * 1_000_000 - 1), 0)
    far = by.rangeBetween(-(long * 1_000_000 - 1), 0)
    last = by.rowsBetween(-12, 0)
    v = F.col("kpi_value")

    def rolled(agg, window):
        return F.when(F.count(v).over(window) >= min_points, agg.over(window))

    df = kpi.withColumn("us", us).withColumn("row", F.row_number().over(by).cast("double"))
    df = df.select(
        "*",
        rolled(F.avg(v), near).alias("m"),
        rolled(F.stddev_samp(v), near).alias("s0"),
        rolled(F.min(v), near).alias("low"),
        rolled(F.max(v), near).alias("high"),
        rolled(F.avg(v), far).alias("m_far"),
        F.when(F.count(v).over(last) >= 3, F.regr_slope(v, F.col("row")).over(last)).otherwise(0.0).alias("kpi_trend"),
    )
    return from_windows(df, threshold, [c for c in kpi.columns if c not in ("ne_id", "ts", "kpi_value")])


def from_windows(df: DataFrame, threshold: float, others: Sequence[str] = ()) -> DataFrame:
    """The features from what the windows of each measurement hold: m, s0, low and high (mean, deviation and extremes of the
    short one; null with too few points), m_far (mean of the long one), kpi_trend."""
    v = F.col("kpi_value")
    df = df.withColumn("s", F.greatest(F.coalesce("s0", F.lit(1.0)), F.lit(0.001)))
    m, far_mean, hour = F.col("m"), F.col("m_far"), F.hour("ts")
    return df.select(
        "ne_id",
        "ts",
        F.coalesce(m, v).alias("kpi_mean"),
        F.col("s").alias("kpi_std"),
        F.coalesce(F.nullif("low", F.lit(0.0)), v).alias("kpi_min"),
        F.coalesce(F.nullif("high", F.lit(0.0)), v).alias("kpi_max"),
        "kpi_trend",
        F.when(m != 0, (v - m) / m).when(m == 0, 0.0).alias("kpi_pct_change_1h"),
        F.when(far_mean != 0, (v - far_mean) / far_mean).otherwise(0.0).alias("kpi_pct_change_24h"),
        ((v - m) / F.col("s")).alias("kpi_z_score"),
        (v > threshold).cast("int").alias("kpi_above_threshold"),
        hour.alias("hour_of_day"),
        F.weekday("ts").alias("day_of_week"),
        hour.isin(*PEAK_HOURS).cast("int").alias("is_peak_hour"),
        *others,
    )
