"""Yearly demand scenarios: anchors made dense, scaled, turned into units and shared out to regions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlake.functions.numeric import ratio, round_half_even

# Names of the three scenarios and how each is obtained.
REFERENCE, MIDDLE, HIGH = "conservador", "intermediario", "acelerado"
OBSERVED, INTERPOLATED = "observed_anchor", "interpolated_exponential"
GEOMETRIC, CONSTANT_RATIO = "derived_geometric_mean", "derived_constant_ratio"
SHARED = "derived_proportional_national_share"


def interpolate(anchors: Column, year: Column) -> Column:
    """Value at ``year`` from a year-sorted array of ``(year, value)``: growth is constant between anchors.

    Outside the anchors the first or last two are extended. Where an end is not positive the line is straight.
    """
    n = F.size(anchors)
    reached = F.size(F.filter(anchors, lambda a: a["year"] <= year))
    lower = F.greatest(F.least(reached, n - 1), F.lit(1))
    a, b = F.get(anchors, lower - 1), F.get(anchors, lower)
    share = (year - a["year"]) / (b["year"] - a["year"])
    straight = a["value"] + share * (b["value"] - a["value"])
    positive = (a["value"] > 0) & (b["value"] > 0)
    growing = F.exp(F.ln(a["value"]) + share * (F.ln(b["value"]) - F.ln(a["value"])))
    exact = F.get(F.filter(anchors, lambda x: x["year"] == year), F.lit(0))["value"]
    return F.coalesce(exact, F.when(positive, growing).otherwise(straight))


def is_anchor(anchors: Column, year: Column) -> Column:
    return F.exists(anchors, lambda a: a["year"] == year)


def anchor_arrays(anchors: DataFrame, series: Sequence[str]) -> DataFrame:
    """One row per series with its sorted anchors; a series has at most one anchor per year."""
    point = F.struct(F.col("year").cast("int").alias("year"), F.col("value").cast("double").alias("value"))
    return anchors.groupBy(*series).agg(F.array_sort(F.collect_list(point)).alias("anchors"))


def _spine(first_year: int, last_year: int) -> Column:
    return F.explode(F.sequence(F.lit(first_year), F.lit(last_year)))


def densify(
    anchors: DataFrame, series: Sequence[str], first_year: int, last_year: int, digits: int | None = None
) -> DataFrame:
    """A value for every year of the span, marked as observed or interpolated."""
    spread = anchor_arrays(anchors, series).withColumn("year", _spine(first_year, last_year))
    valued = spread.withColumn("__value", interpolate(F.col("anchors"), F.col("year")))
    value = F.col("__value")
    return valued.select(
        *series,
        "year",
        (value if digits is None else round_half_even(value, digits)).alias("value"),
        F.when(is_anchor(F.col("anchors"), F.col("year")), OBSERVED).otherwise(INTERPOLATED).alias("value_type"),
    )


def scenario_table(
    anchors: DataFrame,
    alternative: DataFrame,
    series: Sequence[str],
    first_year: int,
    last_year: int,
    kwh_per_unit: float,
) -> DataFrame:
    """Three scenarios per series and year.

    ``alternative`` has one ``(year, value)`` point per series. Its ratio to the reference curve in that
    year scales the whole reference curve; the middle scenario is the geometric mean of the two. A series without that
    point keeps its reference rows and has nulls in the other two.
    """
    point = alternative.select(
        *series, F.col("year").cast("int").alias("__year"), F.col("value").cast("double").alias("__value")
    )
    based = anchor_arrays(anchors, series).join(point, list(series), "left")
    multiplied = based.withColumn("__ratio", ratio(F.col("__value"), interpolate(F.col("anchors"), F.col("__year"))))
    yearly = multiplied.withColumn("year", _spine(first_year, last_year)).withColumn(
        "__reference", interpolate(F.col("anchors"), F.col("year"))
    )
    reference = F.col("__reference")
    high = reference * F.col("__ratio")
    observed = F.when(is_anchor(F.col("anchors"), F.col("year")), OBSERVED).otherwise(INTERPOLATED)

    def row(name: str, value: Column, kind: Column) -> Column:
        return F.struct(F.lit(name).alias("scenario"), value.alias("__twh"), kind.alias("value_type"))

    rows = F.array(
        row(REFERENCE, reference, observed),
        row(MIDDLE, F.sqrt(reference * high), F.lit(GEOMETRIC)),
        row(HIGH, high, F.lit(CONSTANT_RATIO)),
    )
    return yearly.select(*series, "year", F.inline(rows)).select(
        *series,
        "year",
        "scenario",
        round_half_even(F.col("__twh"), 4).alias("demand_light_ev_twh"),
        implied_units(F.col("__twh"), kwh_per_unit).alias("implied_bev_phev_fleet_units"),
        "value_type",
    )


def implied_units(twh: Column, kwh_per_unit: float) -> Column:
    return round_half_even(twh * 1e9 / kwh_per_unit).cast("long")


def share_bounds(df: DataFrame, part: str, broad: str, narrow: str) -> DataFrame:
    """Low share (of the broad total), high share (of the narrow one) and their geometric mean."""
    low, high = ratio(F.col(part), F.col(broad)), ratio(F.col(part), F.col(narrow))
    return df.withColumns({"weight_low": low, "weight_high": high, "weight_central": F.sqrt(low * high)})


def allocate(scenarios: DataFrame, weights: DataFrame, series: Sequence[str], region: str = "region") -> DataFrame:
    """Each region's part of the national rows, for the low, central and high weight.

    ``weights`` has the national ``series`` columns, ``region`` and the three weights; already rounded national
    values are scaled and rounded again. A series without weights keeps its rows, with a null region and null values.
    """
    national = scenarios.drop("value_type")
    placed = national.join(weights.select(*series, region, "weight_low", "weight_central", "weight_high"), list(series), "left")
    cases = F.array(
        *[
            F.struct(F.lit(case).alias("rj_weight_case"), F.col(f"weight_{case}").alias("__w"))
            for case in ("low", "central", "high")
        ]
    )
    return placed.select("*", F.inline(cases)).select(
        *series,
        region,
        "year",
        "scenario",
        "rj_weight_case",
        round_half_even(F.col("demand_light_ev_twh") * F.col("__w"), 5).alias("demand_light_ev_twh"),
        round_half_even(F.col("implied_bev_phev_fleet_units") * F.col("__w"))
        .cast("long")
        .alias("implied_bev_phev_fleet_units"),
        F.lit(SHARED).alias("value_type"),
    )


def growth_rate(start: Column, end: Column, years: Column) -> Column:
    """Compound annual growth; null without a positive start or without years."""
    return F.when((start > 0) & (years > 0), F.pow(end / start, F.lit(1.0) / years) - 1)


def consistency_ratio(implied: DataFrame, official: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``implied_units`` over ``official_units`` of the same key; null where there is no official figure."""
    return implied.join(official, list(keys), "left").withColumn(
        "consistency_ratio", ratio(F.col("implied_units"), F.col("official_units"))
    )
