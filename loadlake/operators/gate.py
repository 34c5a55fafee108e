"""The promotion gate: which version feeds the products."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlake.operators.keys import join_null_safe
from loadlake.operators.ledger import LEDGER_SCHEMA, ORDER, VERSION_KEY
from loadlake.operators.quality import OUTCOME

ACTIVE_KEY = ("source", "dataset", "reference_period")


def gate_decisions(outcomes: DataFrame, version: tuple[str, ...] = VERSION_KEY) -> DataFrame:
    """One decision per version: approved unless a check of severity ``error`` failed.

    ``reasons`` holds ``check: details`` of the failures and ``outcomes`` all rows; both hold one entry per
    check and are sorted.
    """
    blocking = ~F.col("passed") & (F.col("severity") == "error")
    reason = F.when(blocking, F.concat_ws(": ", "check_name", "details"))
    decided = outcomes.groupBy(*version).agg(
        F.every(~blocking).alias("approved"),
        F.array_sort(F.collect_list(reason)).alias("reasons"),
        F.array_sort(F.collect_list(F.struct(*OUTCOME))).alias("outcomes"),
    )
    return decided.withColumn("quarantine_reason", F.when(~F.col("approved"), F.array_join("reasons", "; ")))


def apply_gate(ledger: DataFrame, decisions: DataFrame) -> DataFrame:
    """Ledger states after the decisions.

    Per source, dataset and period one version is active: the newest of those approved now and of those active before
    and not decided again. Other approved ones, and the one that was active, are superseded; rejected ones are
    quarantined and never active. Undecided rows keep their other states, ``is_latest_valid`` among them.
    Decisions are per version, so rejecting a file that was delivered again leaves its earlier version alone.
    """
    judged = decisions.select(*VERSION_KEY, "approved", F.col("quarantine_reason").alias("__reason"))
    joined = ledger.join(judged, list(VERSION_KEY), "left")
    was_active = F.coalesce(F.col("is_active_for_gold"), F.lit(False))
    top = (
        joined.where(F.coalesce(F.col("approved"), was_active))
        .groupBy(*ACTIVE_KEY)
        .agg(F.max(F.struct(*ORDER, "resource_id")).alias("__top"))
    )
    marked = join_null_safe(joined, top, ACTIVE_KEY, "left")
    approved, rejected = F.col("approved"), ~F.col("approved")
    active = F.coalesce(
        F.coalesce(approved, was_active) & (F.struct(*ORDER, "resource_id") == F.col("__top")), F.lit(False)
    )
    states = {
        "is_active_for_gold": active,
        "is_latest_valid": F.coalesce(approved, F.col("is_latest_valid"), F.lit(False)),
        "lifecycle_status": F.when(active, "active")
        .when(approved | (approved.isNull() & was_active), "superseded")
        .when(rejected, "quarantined")
        .otherwise(F.col("lifecycle_status")),
        "validation_status": F.when(approved, "validated")
        .when(rejected, "invalid")
        .otherwise(F.col("validation_status")),
        "quarantine_reason": F.coalesce("__reason", "quarantine_reason"),
    }
    return marked.select(*[states.get(c, F.col(c)).alias(c) for c in LEDGER_SCHEMA.names])


def latest_decisions(log: DataFrame) -> DataFrame:
    """The newest decision per version from a log of decisions with ``decided_at``."""
    rest = [c for c in log.columns if c not in VERSION_KEY]
    order = F.struct("decided_at", "approved", "quarantine_reason")
    top = log.groupBy(*VERSION_KEY).agg(F.max_by(F.struct(*rest), order).alias("__r"))
    return top.select(*VERSION_KEY, "__r.*").select(*log.columns)
