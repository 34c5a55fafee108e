"""Curve shapes scaled to monthly energy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadlake.functions.numeric import ratio
from loadlake.functions.temporal import hours_in_month


def average_monthly_power(
    monthly: DataFrame, energy: str = "energy_mwh", date: str = "month_start", name: str = "average_power_mw"
) -> DataFrame:
    """Energy of a month over its calendar hours; ``date`` is any day of the month."""
    return monthly.withColumn(name, F.col(energy) / hours_in_month(F.col(date)))


def day_counts_long(counts: DataFrame) -> DataFrame:
    """``day_type_counts`` as ``(year, month, day_type, n_days)`` rows."""
    cells = [
        F.struct(F.lit(k).alias("day_type"), F.col(k).cast("long").alias("n_days"))
        for k in ("weekday", "saturday", "sunday", "holiday")
    ]
    return counts.select("year", "month", F.inline(F.array(*cells)))


def calibrate(
    shapes: DataFrame,
    day_counts: DataFrame,
    energy: DataFrame,
    series: Sequence[str] = ("area",),
    period: Sequence[str] = ("year", "month"),
) -> DataFrame:
    """Scale normalised shapes so that they carry each period's energy.

    ``shapes``: series, day_type, hour, normalized_load. ``day_counts``: period, day_type, n_days (missing is 0).
    ``energy``: series, period, energy_mwh. The mean power is the energy over the hours of the day types
    supplied, not over the calendar's hours. Where these are zero hours, the load is null. A series without energy keeps
    its shape, with a null period and load.
    """
    one_period = Window.partitionBy(*series, *period)
    n_days = F.coalesce(F.col("n_days"), F.lit(0)).cast("long")
    hours = (
        shapes.join(energy, list(series), "left")
        .join(day_counts, [*period, "day_type"], "left")
        .withColumn("n_days_in_month", n_days)
        .withColumn("__types", F.collect_set(F.struct("day_type", "n_days_in_month")).over(one_period))
    )
    days = F.aggregate("__types", F.lit(0).cast("long"), lambda a, t: a + t["n_days_in_month"])
    mean_power = ratio(F.col("energy_mwh"), days * 24)
    return hours.select(
        *series,
        *period,
        "day_type",
        "hour",
        "normalized_load",
        (F.col("normalized_load") * mean_power).alias("estimated_load_mw"),
        "n_days_in_month",
        F.col("energy_mwh").alias("reference_energy_mwh"),
    )


def calibration_summary(
    curve: DataFrame, series: Sequence[str] = ("area",), period: Sequence[str] = ("year", "month")
) -> DataFrame:
    """Energy the calibrated curve adds up to, and its error against the reference energy."""
    summed = curve.groupBy(*series, *period).agg(
        F.sum(F.col("estimated_load_mw") * F.col("n_days_in_month")).alias("estimated_energy_mwh"),
        F.max("reference_energy_mwh").alias("reference_energy_mwh"),
    )
    reference = F.col("reference_energy_mwh")
    error = (F.col("estimated_energy_mwh") - reference) * 100
    return summed.withColumn("error_pct", F.when(reference == 0, F.lit(0.0)).otherwise(ratio(error, reference)))
