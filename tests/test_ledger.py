from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from loadlake.operators import gate, ledger, reports

START = datetime(2026, 6, 1)
LANDED = "source string, dataset string, resource_id string, reference_period string, retrieved_at timestamp, hash_sha256 string"


def landed(spark, *versions):
    """(resource, period, hash) in order of arrival, a day apart."""
    data = [("ons", "carga", r, p, START + timedelta(days=i), h) for i, (r, p, h) in enumerate(versions)]
    return spark.createDataFrame(data, LANDED)


def ledger_of(spark, *versions):
    return ledger.with_latest_flag(ledger.as_ledger(ledger.first_arrivals(landed(spark, *versions))))


def test_same_content_is_registered_once(spark):
    df = ledger_of(spark, ("a", "1", "x"), ("a", "1", "x"), ("a", "1", "y"), ("b", "1", "x"))
    assert sorted((r.resource_id, r.hash_sha256) for r in df.collect()) == [("a", "x"), ("a", "y"), ("b", "x")]
    assert df.columns == ledger.LEDGER_SCHEMA.names
    assert df.where("resource_id = 'a' AND hash_sha256 = 'x'").first().retrieved_at == START


def test_new_versions_and_known_versions(spark):
    known = ledger_of(spark, ("a", "1", "x"))
    arrivals = landed(spark, ("a", "1", "x"), ("a", "1", "z"))
    assert [r.hash_sha256 for r in ledger.new_versions(arrivals, known).collect()] == ["z"]
    assert ledger.known_versions(known, arrivals).count() == 1
    assert ledger.new_versions(arrivals, ledger.empty_ledger(spark)).count() == 2


@pytest.mark.parametrize("period", ["2026-06", None])
def test_latest_flag_moves_on(spark, period):
    df = ledger_of(spark, ("a", period, "x"), ("a", period, "y"), ("a", "other", "w"))
    assert sorted(r.hash_sha256 for r in df.where("is_latest_downloaded").collect()) == ["w", "y"]
    assert sorted(r.hash_sha256 for r in ledger.newest(df).collect()) == ["w", "y"]


@pytest.mark.parametrize("period", ["2026-06", None])
def test_revisions(spark, period):
    df = ledger_of(spark, ("a", period, "x"), ("a", period, "y"), ("b", period, "q"), ("a", period, "z"))
    found = sorted((r.resource_id, r.old_hash, r.new_hash) for r in ledger.revisions(df).collect())
    assert found == [("a", "x", "y"), ("a", "y", "z")]
    assert ledger.revisions(df).columns == ledger.REVISION_SCHEMA.names


def test_revision_row_changes(spark):
    log = ledger.revisions(ledger_of(spark, ("a", "1", "x"), ("a", "1", "y"), ("a", "1", "z")))
    content = {"x": {1: "p", 2: "q", 3: None}, "y": {1: "p", 2: "changed", 4: "new"}, "z": {}}
    data = [("ons", "a", h, k, v) for h, records in content.items() for k, v in records.items()]
    rows = spark.createDataFrame(data, "source string, resource_id string, hash_sha256 string, k int, v string")
    changes = ledger.count_row_changes(log, rows, ["k"], "v")
    filled = {r.new_hash: (r.rows_added, r.rows_removed, r.rows_changed) for r in ledger.with_row_changes(log, changes).collect()}
    assert filled == {"y": (1, 1, 1), "z": (0, 3, 0)}


def outcome_rows(spark, *rows):
    data = [("ons", r, h, c, ok, severity, "broken", 1) for r, h, c, ok, severity in rows]
    return spark.createDataFrame(
        data,
        "source string, resource_id string, hash_sha256 string, check_name string, passed boolean, severity string,"
        " details string, rows_affected long",
    )


def test_gate_blocks_on_errors_only(spark):
    found = {
        r.resource_id: r
        for r in gate.gate_decisions(
            outcome_rows(spark, ("a", "x", "schema", True, "error"), ("a", "x", "gaps", False, "warning"),
                         ("b", "y", "schema", False, "error"), ("b", "y", "duplicates", False, "error"))
        ).collect()
    }
    assert found["a"].approved and found["a"].reasons == [] and found["a"].quarantine_reason is None
    assert not found["b"].approved and found["b"].quarantine_reason == "duplicates: broken; schema: broken"
    assert len(found["b"].outcomes) == 2


def gated(spark, versions, verdicts):
    rows = [(r, h, "schema", ok, "error") for (r, _, h), ok in zip(versions, verdicts, strict=True) if ok is not None]
    decided = gate.gate_decisions(outcome_rows(spark, *rows))
    return {r.hash_sha256: r for r in gate.apply_gate(ledger_of(spark, *versions), decided).collect()}


def test_rejected_version_leaves_the_active_one(spark):
    found = gated(spark, [("a", "1", "x"), ("a-v2", "1", "y")], [True, False])
    assert (found["x"].lifecycle_status, found["x"].is_active_for_gold) == ("active", True)
    assert (found["y"].lifecycle_status, found["y"].validation_status) == ("quarantined", "invalid")
    assert found["y"].quarantine_reason == "schema: broken" and not found["y"].is_active_for_gold


def test_rejecting_a_redelivery_leaves_the_earlier_version(spark):
    found = gated(spark, [("a", None, "x"), ("a", None, "y")], [True, False])
    assert found["x"].is_active_for_gold and found["x"].lifecycle_status == "active"


def test_newer_approved_version_supersedes(spark):
    found = gated(spark, [("a", None, "x"), ("b", None, "y"), ("c", "other", "z")], [True, True, None])
    assert (found["x"].lifecycle_status, found["x"].validation_status) == ("superseded", "validated")
    assert found["y"].is_active_for_gold and not found["x"].is_active_for_gold
    assert (found["z"].lifecycle_status, found["z"].validation_status) == ("raw_immutable", "downloaded")
    assert not found["z"].is_active_for_gold


def test_active_versions(spark):
    decided = gate.gate_decisions(outcome_rows(spark, ("a", "x", "s", True, "error"), ("b", "y", "s", True, "error")))
    df = gate.apply_gate(ledger_of(spark, ("a", "1", "x"), ("b", "2", "y")), decided)
    assert ledger.active_versions(df, "ons", "carga").count() == 2
    assert [r.hash_sha256 for r in ledger.active_versions(df, "ons", "carga", "2").collect()] == ["y"]
    assert ledger.files_of(df, "ons", "carga", "latest_downloaded").count() == 2


@pytest.mark.parametrize(
    ("days", "valid", "status"),
    [(0, True, "fresh"), (1, True, "fresh"), (2, True, "expected_lag"), (3, True, "expected_lag"), (4, True, "stale"),
     (9, False, "new_version_pending_validation")],
)
def test_freshness(spark, days, valid, status):
    df = ledger_of(spark, ("a", "2026-05", "x")).withColumn("is_latest_valid", F.lit(valid))
    sources = spark.createDataFrame([("ons", 3), ("epe", None)], "source string, expected_lag_days int")
    as_of = F.lit(str(START + timedelta(days=days, hours=23)))
    found = {r.source: r for r in reports.freshness(df, sources, as_of).collect()}
    assert found["ons"].freshness_status == status and found["ons"].days_since_latest_reference == days
    assert found["ons"].days_since_reference_period == days + 1
    assert found["epe"].freshness_status == "source_unavailable" and found["epe"].validation_status == "n/a"


def test_lineage(spark):
    used = ledger_of(spark, ("a", "1", "x"), ("a", "1", "y")).unionByName(ledger_of(spark, ("a", "1", "x")))
    df = reports.lineage(used, "load_hourly", "v1", "0.1.0", F.lit("2026-06-01"))
    assert sorted(r.source_hash for r in df.collect()) == ["x", "y"] and df.columns == ledger.LINEAGE_SCHEMA.names


def test_schema_hash(spark):
    import hashlib

    df = spark.createDataFrame([("a", 1, "y", "int"), ("a", 0, "x", "str")], "r string, position int, column_name string, column_type string")
    assert ledger.schema_hashes(df, ["r"]).first().schema_hash == hashlib.sha256(b"x:str|y:int").hexdigest()
