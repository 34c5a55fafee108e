"""Scalars of a 24-hour curve, per series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadlake.functions.numeric import ratio, ratio_or_zero
from loadlake.operators.quantiles import sorted_nearest

# The evening windows whose share of energy is reported.
EVENING_SHARES = {"share_17_22": range(17, 23), "share_18_21": range(18, 22)}
METRICS = (
    "average_load_mw",
    "peak_load_mw",
    "minimum_load_mw",
    "peak_hour",
    "minimum_hour",
    "peak_to_average_ratio",
    "daily_energy_mwh",
    "load_factor",
    "share_17_22",
    "share_18_21",
    "peak_3h_energy_share",
    "peak_valley_mw",
)


def peak_hour(hour: Column, value: Column) -> Column:
    """Aggregate: hour of the greatest value, the lowest hour on ties."""
    return F.max_by(hour, F.struct(value, -hour))


def minimum_hour(hour: Column, value: Column) -> Column:
    return F.min_by(hour, F.struct(value, hour))


def load_metrics(profile: DataFrame, series: Sequence[str] = ("area",), value: str = "avg_mw") -> DataFrame:
    """One row of metrics per series. A profile has one row per hour, so a group holds 24 values."""
    v, hour = F.col(value), F.col("hour")
    known = F.when(v.isNotNull(), hour)
    grouped = profile.groupBy(*series).agg(
        F.avg(v).alias("average_load_mw"),
        F.max(v).alias("peak_load_mw"),
        F.min(v).alias("minimum_load_mw"),
        peak_hour(known, v).alias("peak_hour"),
        F.min_by(hour, F.when(v.isNotNull(), F.struct(v, hour))).alias("minimum_hour"),
        F.sum(v).alias("daily_energy_mwh"),
        *[
            F.coalesce(F.sum(F.when(hour.isin(list(hours)), v)), F.lit(0.0)).alias(f"__{name}")
            for name, hours in EVENING_SHARES.items()
        ],
        F.slice(F.sort_array(F.collect_list(v), asc=False), 1, 3).alias("__top"),
    )
    total = F.col("daily_energy_mwh")
    top3 = F.aggregate("__top", F.lit(0.0), lambda a, x: a + x)
    return grouped.withColumns(
        {
            "peak_to_average_ratio": ratio_or_zero(F.col("peak_load_mw"), F.col("average_load_mw")),
            "load_factor": ratio_or_zero(F.col("average_load_mw"), F.col("peak_load_mw")),
            **{name: ratio_or_zero(F.col(f"__{name}"), total) for name in EVENING_SHARES},
            "peak_3h_energy_share": ratio_or_zero(top3, total),
            "peak_valley_mw": F.col("peak_load_mw") - F.col("minimum_load_mw"),
        }
    ).select(*series, *METRICS)


def flexibility_candidates(profile: DataFrame, series: Sequence[str] = ("area",), value: str = "avg_mw") -> DataFrame:
    """Hours above the series' mean and above its p90, and by how much."""
    curve = Window.partitionBy(*series)
    v = F.col(value)
    with_levels = profile.withColumn("__mean", F.avg(v).over(curve)).withColumn(
        "__p90", sorted_nearest(F.sort_array(F.collect_list(v).over(curve)), 0.90)
    )
    above = {"above_daily_mean_mw": "__mean", "above_p90_mw": "__p90"}
    return with_levels.select(
        *series,
        "hour",
        v.alias("baseline_mw"),
        *[F.when(v.isNotNull(), F.greatest(v - F.col(m), F.lit(0.0))).alias(n) for n, m in above.items()],
        F.when(v > F.col("__mean"), "candidate_peak_shift").otherwise("baseline").alias("potential_shift_window"),
    )


def metrics_long(metrics: DataFrame, series: Sequence[str], names: Sequence[str] = METRICS) -> DataFrame:
    """Metric columns to ``(series, metric, value)`` rows."""
    cells = [F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names]
    return metrics.select(*series, F.inline(F.array(*cells)))


def compare_sources(
    left: DataFrame, right: DataFrame, keys: Sequence[str] = ("metric",)
) -> DataFrame:
    """Equivalent metrics of two sources side by side, each with its own scope, nothing adjusted.

    Both need ``keys, value, source, geographic_scope``; a metric only one of them has is kept.
    """

    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select(
            *keys,
            F.col("source").alias(f"source_{name}"),
            F.col("geographic_scope").alias(f"scope_{name}"),
            F.col("value").alias(f"value_{name}"),
        )

    joined = side(left, "a").join(side(right, "b"), list(keys), "full_outer")
    difference = F.col("value_b") - F.col("value_a")
    return joined.withColumns(
        {
            "difference": difference,
            "difference_pct": ratio(difference * 100, F.col("value_a")),
            "same_scope": F.col("scope_a").eqNullSafe(F.col("scope_b")),
        }
    )
