"""Average 24-hour curves of hourly load."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loadlake.functions.numeric import ratio
from loadlake.operators.quantiles import sorted_median, sorted_nearest


def profile(
    hourly: DataFrame, by: Sequence[str] = (), series: Sequence[str] = ("area",), value: str = "load_hourly_mw"
) -> DataFrame:
    """Mean, median, p05 and p95 per ``series``, ``by`` and hour.

    An hourly table has one row per series and local hour, so a group holds at most one value per day of
    history (36,525 in a century): its values are sorted in one array. Groups without that bound belong
    in ``exact_quantiles``. Rows are placed by (series, hour), which also serves any finer ``by``.
    """
    placed = hourly.select(*series, *by, "hour", value).repartition(*series, "hour")
    return _profile_of(placed, [*series, *by, "hour"], value)


def _profile_of(placed: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    values = F.sort_array(F.collect_list(F.col(value)))
    grouped = placed.groupBy(*keys).agg(F.avg(value).alias("avg_mw"), values.alias("__v"))
    return grouped.select(
        *keys,
        "avg_mw",
        sorted_median(F.col("__v")).alias("median_mw"),
        sorted_nearest(F.col("__v"), 0.05).alias("p05_mw"),
        sorted_nearest(F.col("__v"), 0.95).alias("p95_mw"),
    )


def with_normalized_load(
    curve: DataFrame, series: Sequence[str] = ("area",), value: str = "avg_mw", name: str = "normalized_load"
) -> DataFrame:
    """``value`` over the unweighted mean of its series' hours."""
    mean = F.avg(value).over(Window.partitionBy(*series)) if series else F.avg(value).over(Window.partitionBy(F.lit(0)))
    return curve.withColumn(name, ratio(F.col(value), mean))


def profile_24h(hourly: DataFrame, series: Sequence[str] = ("area",)) -> DataFrame:
    return with_normalized_load(profile(hourly, (), series), series)


def profile_by_day_type(hourly: DataFrame, series: Sequence[str] = ("area",)) -> DataFrame:
    return profile(hourly, ("day_type",), series)


def profile_by_month(hourly: DataFrame, series: Sequence[str] = ("area",), with_year: bool = False) -> DataFrame:
    """By calendar month; the years are merged unless ``with_year``."""
    return profile(hourly, ("year", "month") if with_year else ("month",), series)


def all_profiles(hourly: DataFrame, series: Sequence[str] = ("area",), value: str = "load_hourly_mw") -> DataFrame:
    """The three curves in one table, ``grain`` telling which; keys of other grains are null.

    One scan and one exchange of the rows: they are placed by (series, hour) first and given their three grains
    afterwards, where every group already has its rows together.
    """

    def grain(name: str, **keys: Column) -> Column:
        nothing = {"day_type": F.lit(None).cast("string"), "month": F.lit(None).cast("int")}
        return F.struct(F.lit(name).alias("grain"), *[keys.get(k, v).alias(f"__{k}") for k, v in nothing.items()])

    grains = F.array(
        grain("overall"), grain("day_type", day_type=F.col("day_type")), grain("month", month=F.col("month"))
    )
    placed = hourly.select(*series, "hour", "day_type", "month", value).repartition(*series, "hour")
    spread = placed.select(*series, "hour", value, F.inline(grains))
    curve = _profile_of(spread, [*series, "hour", "grain", "__day_type", "__month"], value)
    mean = F.avg("avg_mw").over(Window.partitionBy(*series, "grain"))
    normal = F.when(F.col("grain") == "overall", ratio(F.col("avg_mw"), mean))
    return curve.withColumn("normalized_load", normal).withColumnsRenamed(
        {"__day_type": "day_type", "__month": "month"}
    )
