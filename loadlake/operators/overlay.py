"""Added demand laid over observed 24-hour curves, for any number of series and cases in one job."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadlake.functions.numeric import ratio, round_half_even
from loadlake.operators.metrics import peak_hour

# Relative weight of each hour when nothing steers the demand (not yet normalised).
UNCONTROLLED_WEIGHTS = {
    0: 0.010, 1: 0.008, 2: 0.006, 3: 0.005, 4: 0.005, 5: 0.006,
    6: 0.010, 7: 0.015, 8: 0.018, 9: 0.018, 10: 0.018, 11: 0.018,
    12: 0.020, 13: 0.020, 14: 0.020, 15: 0.025, 16: 0.045, 17: 0.075,
    18: 0.100, 19: 0.095, 20: 0.080, 21: 0.065, 22: 0.048, 23: 0.030,
}
STRATEGIES = ("uncontrolled", "smart", "offpeak_shifted")
SMALLEST_HEADROOM = 1e-6


@dataclass(frozen=True)
class Charging:
    """Parameters of the added demand; the defaults are the published assumptions."""

    kwh_per_unit: float = 2000.0
    peak_hours: Sequence[int] = (17, 18, 19, 20)
    peak_cut_pct_low: float = 6.0
    peak_cut_pct_high: float = 70.0
    offpeak_start: int = 0
    offpeak_end: int = 6
    weights: Mapping[int, float] = field(default_factory=lambda: UNCONTROLLED_WEIGHTS)

    @property
    def peak_cut(self) -> float:
        return (self.peak_cut_pct_low + self.peak_cut_pct_high) / 2 / 100


def normalize_weights(weights: DataFrame, keys: Sequence[str] = ("strategy",), weight: str = "weight") -> DataFrame:
    """Hour weights per strategy scaled to sum to 1."""
    return weights.withColumn(weight, ratio(F.col(weight), F.sum(weight).over(Window.partitionBy(*keys))))


def _uncontrolled(hour: Column, charging: Charging) -> Column:
    pairs = [F.lit(x) for h, w in charging.weights.items() for x in (h, float(w))]
    total = F.lit(float(sum(charging.weights.values())))
    return F.coalesce(F.try_element_at(F.create_map(*pairs), hour), F.lit(0.0)) / total


def _in_window(hour: Column, charging: Charging) -> Column:
    """Hours from the start to the end of the window, which may pass midnight; equal ends are the whole day."""
    return F.pmod(hour - charging.offpeak_start, F.lit(24)) < _window_hours(charging)


def _window_hours(charging: Charging) -> int:
    return (charging.offpeak_end - charging.offpeak_start) % 24 or 24


def charging_shapes(
    profiles: DataFrame, series: Sequence[str] = ("area",), value: str = "avg_mw", charging: Charging | None = None
) -> DataFrame:
    """Profile rows × strategy with ``weight``, the share of the day's added energy in that hour.

    ``smart`` cuts the peak hours and fills the valleys of the observed curve: an hour outside the peak gets
    the removed share in proportion to how far the curve lies below its maximum there.
    """
    charging = charging or Charging()
    day = Window.partitionBy(*series)
    hour = F.col("hour")
    in_peak = hour.isin(list(charging.peak_hours))
    free = _uncontrolled(hour, charging)
    cut = F.when(in_peak, free * charging.peak_cut).otherwise(0.0)

    measured = (
        profiles.select(*series, hour, F.col(value).alias("base_mw"))
        .withColumn("__max", F.max("base_mw").over(day))
        .withColumn("__free", free)
        .withColumn("__cut", cut)
    )
    room = F.when(~in_peak, F.greatest(F.col("__max") - F.col("base_mw"), F.lit(SMALLEST_HEADROOM)))
    filled = measured.withColumn("__room", room).withColumns(
        {"__removed": F.sum("__cut").over(day), "__rooms": F.sum("__room").over(day)}
    )
    smart = F.when(in_peak, F.col("__free") - F.col("__cut")).otherwise(
        F.col("__free") + F.col("__removed") * ratio(F.col("__room"), F.col("__rooms"))
    )
    flat = F.when(_in_window(hour, charging), F.lit(1.0 / _window_hours(charging)))
    weights = {"uncontrolled": F.col("__free"), "smart": smart, "offpeak_shifted": F.coalesce(flat, F.lit(0.0))}
    rows = [F.struct(F.lit(s).alias("strategy"), weights[s].alias("weight")) for s in STRATEGIES]
    return filled.select(*series, "hour", "base_mw", F.inline(F.array(*rows)))


def daily_energy_mwh(units: Column, kwh_per_unit: float) -> Column:
    return units * kwh_per_unit / 365 / 1000


def overlay_hourly(
    profiles: DataFrame,
    cases: DataFrame,
    series: Sequence[str] = ("area",),
    case: Sequence[str] = ("case",),
    value: str = "avg_mw",
    charging: Charging | None = None,
) -> DataFrame:
    """Observed, added and total MW per series, case, strategy and hour.

    ``cases`` has the series and case columns and ``n_vehicles``. Everything after the first exchange on the
    series stays in place, since each later grouping contains the series.
    """
    charging = charging or Charging()
    shapes = charging_shapes(profiles, series, value, charging)
    energy = daily_energy_mwh(F.col("n_vehicles"), charging.kwh_per_unit)
    added = shapes.join(cases, list(series)).withColumns(
        {"daily_energy_added_mwh": energy, "added_mw": energy * F.col("weight")}
    )
    total = added.withColumn("total_mw", F.col("base_mw") + F.col("added_mw"))
    curve = Window.partitionBy(*series, *case, "strategy")
    return total.select(
        *series,
        *case,
        *[c for c in cases.columns if c not in (*series, *case)],
        "strategy",
        "hour",
        "daily_energy_added_mwh",
        "base_mw",
        "added_mw",
        "total_mw",
        ratio(F.col("base_mw"), F.avg("base_mw").over(curve)).alias("base_normalized"),
        ratio(F.col("total_mw"), F.avg("total_mw").over(curve)).alias("total_normalized"),
    )


def overlay_summary(
    hourly: DataFrame, series: Sequence[str] = ("area",), case: Sequence[str] = ("case",), rounded: bool = True
) -> DataFrame:
    """Peaks before and after, per series, case and strategy; the lowest hour wins a tie."""
    hour = F.col("hour")
    peaks = hourly.groupBy(*series, *case, "strategy").agg(
        F.max("n_vehicles").alias("n_vehicles"),
        F.max("daily_energy_added_mwh").alias("daily_energy_added_mwh"),
        F.max("base_mw").alias("baseline_peak_mw"),
        peak_hour(hour, F.col("base_mw")).alias("baseline_peak_hour"),
        F.max("total_mw").alias("new_peak_mw"),
        peak_hour(hour, F.col("total_mw")).alias("new_peak_hour"),
    )
    increase = ratio((F.col("new_peak_mw") - F.col("baseline_peak_mw")) * 100, F.col("baseline_peak_mw"))
    complete = peaks.withColumns(
        {
            "peak_increase_pct": increase,
            "peak_hour_shifted": F.col("baseline_peak_hour") != F.col("new_peak_hour"),
        }
    )
    if not rounded:
        return complete
    digits = {"daily_energy_added_mwh": 2, "baseline_peak_mw": 1, "new_peak_mw": 1, "peak_increase_pct": 2}
    return complete.withColumns({c: round_half_even(F.col(c), d) for c, d in digits.items()})
