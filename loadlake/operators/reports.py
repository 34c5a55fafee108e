"""Freshness of the sources and lineage of the products."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadlake.operators.ledger import LINEAGE_SCHEMA, ORDER

# Days after which a source counts as stale, and the value for other sources.
EXPECTED_LAG_DAYS = {"ons": 3, "ccee": 45, "epe": 60, "samp": 60, "aneel_ctr": 400}
DEFAULT_LAG_DAYS = 30


def freshness(ledger: DataFrame, sources: DataFrame, as_of: Column) -> DataFrame:
    """One row per source of ``sources(source, expected_lag_days)``.

    ``days_since_latest_reference`` is the whole days since the newest retrieval, as the report has always
    named it; ``days_since_reference_period`` counts from the end of the newest period of that version.
    """
    shown = F.struct("retrieved_at", "resource_id", "reference_period", "source_modified_at", "validation_status")
    summary = ledger.groupBy("source").agg(
        F.max_by(F.when(F.col("is_latest_downloaded"), shown), _order("is_latest_downloaded")).alias("__latest"),
        F.max_by(F.when(F.col("is_latest_valid"), F.col("resource_id")), _order("is_latest_valid")).alias("__valid"),
    )
    joined = sources.join(summary, "source", "left")
    latest = F.col("__latest")
    lag = F.coalesce(F.col("expected_lag_days"), F.lit(DEFAULT_LAG_DAYS))
    seconds = as_of.cast("timestamp").cast("long") - latest["retrieved_at"].cast("long")
    days = F.floor(seconds / 86400).cast("int")
    period_end = F.last_day(F.try_to_timestamp(F.concat(latest["reference_period"], F.lit("-01")), F.lit("yyyy-MM-dd")))
    status = (
        F.when(latest.isNull(), "source_unavailable")
        .when(F.col("__valid").isNull(), "new_version_pending_validation")
        .when(days > lag, "stale")
        .when(days > lag * 0.5, "expected_lag")
        .otherwise("fresh")
    )
    return joined.select(
        "source",
        latest["reference_period"].alias("latest_reference_period"),
        latest["source_modified_at"].alias("latest_source_update"),
        as_of.cast("timestamp").alias("last_checked_at"),
        latest["retrieved_at"].alias("last_successful_download"),
        latest["resource_id"].alias("latest_downloaded_version"),
        F.col("__valid").alias("latest_valid_version"),
        days.alias("days_since_latest_reference"),
        F.datediff(F.to_date(as_of.cast("timestamp")), period_end).alias("days_since_reference_period"),
        status.alias("freshness_status"),
        F.coalesce(latest["validation_status"], F.lit("n/a")).alias("validation_status"),
    )


def _order(flag: str) -> Column:
    return F.when(F.col(flag), F.struct(*ORDER, "resource_id"))


def lineage(
    used: DataFrame, gold_dataset: str, gold_version: str, pipeline_version: str, created_at: Column
) -> DataFrame:
    """One row per source version among the rows a product read."""
    versions = used.select(
        "source", "resource_id", F.col("hash_sha256").alias("source_hash"), "reference_period"
    ).distinct()
    stamped = versions.withColumns(
        {
            "gold_dataset": F.lit(gold_dataset),
            "gold_version": F.lit(gold_version),
            "pipeline_version": F.lit(pipeline_version),
            "created_at": created_at.cast("timestamp"),
        }
    )
    return stamped.select(*LINEAGE_SCHEMA.names)
