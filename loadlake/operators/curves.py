"""Consumer-class curves."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loadlake.functions.numeric import ratio
from loadlake.functions.parsing import clock_hour, decimal_comma
from loadlake.operators.keys import join_null_safe
from loadlake.operators.quantiles import exact_quantiles

# Category columns of the published class-curve files.
CATEGORY_COLUMNS = ("SigCcs", "NomSubGrupoTarifario", "DscDemandante", "DscTipoDia")
CURVE_KEYS = ("SigCcs", "DscDemandante", "NomSubGrupoTarifario", "DscTipoDia")
CURVE_QUANTILES = {"p05_mw": 0.05, "p25_mw": 0.25, "p75_mw": 0.75, "p95_mw": 0.95}


def type_class_curves(raw: DataFrame) -> DataFrame:
    """Clock columns as text, demand as double whichever decimal mark it uses."""
    return raw.withColumns(
        {
            "HorInicial": F.col("HorInicial").cast("string"),
            "HorFinal": F.col("HorFinal").cast("string"),
            "VlrDmd": decimal_comma(F.col("VlrDmd")),
        }
    )


def category_values(df: DataFrame, columns: Sequence[str] = CATEGORY_COLUMNS) -> DataFrame:
    """Distinct non-null ``(category, value)`` pairs of the category columns that exist."""
    pairs = [
        F.struct(F.lit(c).alias("category"), F.col(c).cast("string").alias("value"))
        for c in columns
        if c in df.columns
    ]
    return df.select(F.inline(F.array(*pairs))).where(F.col("value").isNotNull()).distinct()


def class_curve_stats(
    df: DataFrame, distributor: str = "SigCcs", start: str = "HorInicial", value: str = "VlrDmd"
) -> DataFrame:
    """Mean, median, quantiles, spread and count per distributor, class, subgroup, day type and hour."""
    keys = [distributor, *CURVE_KEYS[1:], "hour"]
    rows = df.withColumn("hour", clock_hour(F.col(start))).select(*keys, value)
    stats = exact_quantiles(
        rows, keys, value, CURVE_QUANTILES, "median_mw", count="n_observations", mean="mean_mw", std="std_mw"
    )
    return stats.select(*keys, "mean_mw", "median_mw", *CURVE_QUANTILES, "std_mw", "n_observations")


def normalize_class_curves(stats: DataFrame, keys: Sequence[str] = CURVE_KEYS) -> DataFrame:
    """Add the curve's ``daily_mean_mw`` and ``normalized_load``, whose mean over the hours is 1."""
    curve = Window.partitionBy(*keys)
    return stats.withColumn("daily_mean_mw", F.avg("mean_mw").over(curve)).withColumn(
        "normalized_load", ratio(F.col("mean_mw"), F.col("daily_mean_mw"))
    )


def class_report(normalized: DataFrame, label: str, column: str = "DscDemandante") -> DataFrame:
    """Mean curve of one class by hour."""
    return (
        normalized.where(F.col(column) == label)
        .groupBy("hour")
        .agg(F.avg("mean_mw").alias("avg_mw"), F.avg("normalized_load").alias("normalized_load"))
    )


def class_reports(normalized: DataFrame, labels: DataFrame, column: str = "DscDemandante") -> DataFrame:
    """Mean curves by ``label`` and hour of the classes listed, in one pass."""
    own = normalized.join(labels.select("label").distinct(), F.col(column) == F.col("label"), "left_semi")
    return own.groupBy(F.col(column).alias("label"), "hour").agg(
        F.avg("mean_mw").alias("avg_mw"), F.avg("normalized_load").alias("normalized_load")
    )


def rows_with_label(
    df: DataFrame, column: str, aliases: Sequence[str], first_only: bool = False
) -> DataFrame:
    """Rows whose ``column`` is, trimmed and lower-cased, one of ``aliases``.

    All spellings are kept; ``first_only`` keeps the first spelling in sort order. An empty result means
    that no spelling was found, which ``quality.table_checks`` reports as ``not_empty``.
    """
    matching = df.where(F.lower(F.trim(F.col(column))).isin([a.strip().lower() for a in aliases]))
    if not first_only:
        return matching
    first = matching.agg(F.min(column).alias("__label"))
    return matching.join(F.broadcast(first), F.col(column) == F.col("__label")).drop("__label")
