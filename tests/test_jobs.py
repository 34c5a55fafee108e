import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from loadlake.operators import calendar, ledger, quality
from loadlake.plans import jobs
from loadlake.sources import landed, tables
from loadlake.streaming.arrivals import register_into
from loadlake.streaming.hourly import hourly_stream

ARRIVAL = "source string, dataset string, resource_id string, reference_period string, local_path string, retrieved_at timestamp, row_count long"


def readings_file(root, name, area, day, loads, month=6):
    """Half-hour loads from local midnight (03:00 UTC) of a day on."""
    folder = root / "raw" / "ons"
    folder.mkdir(parents=True, exist_ok=True)
    records = [
        {"cod_areacarga": area, "din_referenciautc": f"{(datetime(2026, month, day, 3) + timedelta(minutes=30 * i)).isoformat()}Z", "val_cargaglobal": v}
        for i, v in enumerate(loads)
    ]
    (folder / name).write_text(json.dumps(records))
    return f"raw/ons/{name}"


def arrivals(spark, *rows):
    data = [("ons", "carga", r, p, path, datetime(2026, 7, at), n) for r, p, path, at, n in rows]
    return spark.createDataFrame(data, ARRIVAL)


@pytest.fixture
def lake(spark, tmp_path):
    s = readings_file(tmp_path, "s.json", "S", 2, [10, 20, 30, 40])
    n = readings_file(tmp_path, "n.json", "N", 2, [1, 3, 5, 0])
    late = readings_file(tmp_path, "s2.json", "S", 2, [12, 20])
    other = readings_file(tmp_path, "july.json", "S", 5, [7, 7], month=7)
    rows = [("s", "2026-06", s, 1, 4), ("n", "2026-06n", n, 1, 4), ("s2", "2026-06b", late, 2, 2), ("july", "2026-07", other, 2, None)]
    jobs.land(spark, str(tmp_path), arrivals(spark, *rows))
    return tmp_path


@pytest.fixture
def tmp_path(tmp_path):
    """A lake whose own path holds ``raw/`` and characters that URLs and patterns treat specially."""
    root = tmp_path / "raw" / "my lake+1"
    root.mkdir(parents=True)
    return root


def stored_ledger(spark, lake):
    return tables.read_or_empty(spark, tables.layer_path(str(lake), "metadata", "ledger"), ledger.LEDGER_SCHEMA)


def validated(spark, lake, broken=()):
    versions = stored_ledger(spark, lake)
    files = versions.select("local_path").where(~F.col("resource_id").isin(list(broken) or ["-"]))
    return jobs.validate(versions, jobs.presence_outcomes(versions, files))


def test_landing_twice_adds_nothing(spark, lake):
    again = arrivals(spark, ("s", "2026-06", "raw/ons/s.json", 9, 4))
    fresh, _ = jobs.land(spark, str(lake), again)
    assert stored_ledger(spark, lake).count() == 4


def test_changed_file_is_a_revision(spark, lake):
    path = readings_file(lake, "s_new.json", "S", 2, [10, 20, 30, 41])
    _, log = jobs.land(spark, str(lake), arrivals(spark, ("s", "2026-06", path, 3, 4)))
    assert [(r.resource_id, r.reference_period) for r in log.collect()] == [("s", "2026-06")]
    exported = jobs.export_revisions(spark, str(lake))
    assert exported.count() == 1


def test_validation_quarantines_a_missing_file(spark, lake):
    report, states = validated(spark, lake, broken=["n"])
    found = {r.resource_id: r for r in states.collect()}
    assert found["n"].lifecycle_status == "quarantined" and found["n"].quarantine_reason == "file_present: missing"
    assert found["s"].is_active_for_gold
    assert report.count() == 8 and {r.check_name for r in report.collect()} == {"rows_not_empty", "file_present"}


def build(spark, lake, **more):
    _, states = validated(spark, lake)
    active = states.where("is_active_for_gold")
    return jobs.build_load_products(
        spark, str(lake), active, calendar.holidays_between(spark, 2026, 2026), areas=("S", "N"),
        created_at=F.lit("2026-08-01"), **more,
    )


def test_products(spark, lake):
    paths = build(spark, lake)
    hourly = {(r.area, r.date.month, r.hour): r for r in spark.read.parquet(paths.hourly).collect()}
    assert hourly["S", 6, 0].load_hourly_mw == 16 and hourly["S", 6, 1].load_hourly_mw == 35
    assert hourly["N", 6, 1].quality_flag == "incomplete_hour" and ("S", 7, 0) in hourly
    system = {r.hour: r for r in spark.read.parquet(paths.system).collect()}
    assert (system[0].load_hourly_mw, system[0].quality_flag) == (18, "ok")
    assert (system[1].load_hourly_mw, system[1].quality_flag) == (40, "incomplete_hour")
    assert spark.read.parquet(paths.profiles).where("grain = 'overall'").count() == 4
    assert spark.read.parquet(paths.lineage).count() == 4
    assert (lake / "gold" / "average_24h_by_month").exists()


def test_incremental_build_replaces_only_the_changed_month(spark, lake):
    paths = build(spark, lake)
    before = {p.name for p in (lake / "gold" / "load_hourly").rglob("month=7/*.parquet")}
    path = readings_file(lake, "s3.json", "S", 2, [100, 100])
    jobs.land(spark, str(lake), arrivals(spark, ("s3", "2026-06c", path, 5, 2)))
    build(spark, lake, changed=stored_ledger(spark, lake).where("resource_id = 's3'"))
    hourly = {(r.area, r.month, r.hour): r.load_hourly_mw for r in spark.read.parquet(paths.hourly).collect()}
    assert hourly["S", 6, 0] == 100 and hourly["S", 6, 1] == 35 and hourly["S", 7, 0] == 7
    assert {p.name for p in (lake / "gold" / "load_hourly").rglob("month=7/*.parquet")} == before


def test_rows_of_a_superseded_version_disappear(spark, lake):
    paths = build(spark, lake)
    path = readings_file(lake, "july_new.json", "S", 5, [0, 9], month=7)
    jobs.land(spark, str(lake), arrivals(spark, ("july", "2026-07", path, 8, 2)))
    build(spark, lake, changed=stored_ledger(spark, lake).where("local_path LIKE '%july_new%'"))
    july = spark.read.parquet(paths.hourly).where("month = 7").collect()
    assert [(r.load_hourly_mw, r.n_intervals) for r in july] == [(9.0, 1)]
    months = {r.month for r in spark.read.parquet(paths.hourly).collect()}
    assert months == {6, 7}


def test_only_new_files_are_read(spark, lake):
    import os

    old = 1_600_000_000
    for file in (lake / "raw" / "ons").iterdir():
        os.utime(file, (old, old))
    path = readings_file(lake, "new.json", "S", 9, [1, 1])
    fresh = landed.fingerprints(spark, f"{lake}/raw/*/*", "2021-01-01T00:00:00")
    assert [r.file_path.rsplit("/", 1)[1] for r in fresh.collect()] == ["new.json"]
    jobs.land(spark, str(lake), arrivals(spark, ("s", "2026-06", "raw/ons/s.json", 1, 4)))  # takes note of the time
    file = lake / "raw" / "ons" / "s.json"
    file.write_text("x" * len(file.read_text()))  # same path, size and time: not read again
    os.utime(file, (old, old))
    rows = arrivals(spark, ("new", "2026-06", path, 9, 2), ("s", "2026-06", "raw/ons/s.json", 1, 4), ("gone", "2026-06", "raw/ons/gone.json", 9, 1))
    fresh, _ = jobs.land(spark, str(lake), rows)
    assert [r.resource_id for r in fresh.collect()] == ["new"] and stored_ledger(spark, lake).count() == 5


def test_rows_and_revision_counts_come_from_the_files(spark, lake):
    path = readings_file(lake, "s new.json", "S", 2, [10, 20, 30, 41, 50])
    rows = jobs.reading_rows(spark, str(lake))
    fresh, log = jobs.land(spark, str(lake), arrivals(spark, ("s", "2026-06", path, 3, None)), rows)
    assert [r.row_count for r in fresh.collect()] == [5]
    assert [(r.rows_added, r.rows_removed, r.rows_changed) for r in log.collect()] == [(1, 0, 1)]


def states_of(df):
    return {r.resource_id + r.hash_sha256[:4]: (r.lifecycle_status, r.is_active_for_gold, r.is_latest_valid) for r in df.collect()}


def judged(spark, lake, passed, day):
    versions = stored_ledger(spark, lake)
    cell = quality.outcome("c", "error", F.col("resource_id").isin(passed), F.lit("d"))
    outcomes = versions.select(*ledger.VERSION_KEY, F.inline(F.array(cell)))
    return jobs.promote(spark, str(lake), outcomes, F.lit(f"2026-08-{day:02d}").cast("timestamp"))[1].where("resource_id = 's'")


def test_rejected_newest_keeps_the_earlier_active(spark, lake):
    assert [v[:2] for v in states_of(judged(spark, lake, ["s", "n"], 1)).values()] == [("active", True)]
    path = readings_file(lake, "s_new.json", "S", 2, [10, 20, 30, 41])
    jobs.land(spark, str(lake), arrivals(spark, ("s", "2026-06", path, 3, 4)))
    after = {r.local_path: r for r in judged(spark, lake, [], 2).collect()}
    assert (after["raw/ons/s.json"].lifecycle_status, after["raw/ons/s.json"].is_active_for_gold, after["raw/ons/s.json"].is_latest_valid) == ("active", True, True)
    assert (after[path].lifecycle_status, after[path].is_active_for_gold, after[path].quarantine_reason) == ("quarantined", False, "c: d")


def test_approved_newest_supersedes_the_earlier(spark, lake):
    judged(spark, lake, ["s"], 1)
    path = readings_file(lake, "s_new.json", "S", 2, [10, 20, 30, 41])
    jobs.land(spark, str(lake), arrivals(spark, ("s", "2026-06", path, 3, 4)))
    after = {r.local_path: r for r in judged(spark, lake, ["s"], 2).collect()}
    assert (after["raw/ons/s.json"].lifecycle_status, after["raw/ons/s.json"].is_active_for_gold, after["raw/ons/s.json"].is_latest_valid) == ("superseded", False, True)
    assert (after[path].lifecycle_status, after[path].is_active_for_gold) == ("active", True)
    assert spark.read.parquet(tables.layer_path(str(lake), "metadata", "quality_report")).count() == 8


def test_checks_of_reading_files(spark, lake):
    (lake / "raw" / "ons" / "bad.json").write_text("<html>")
    jobs.land(spark, str(lake), arrivals(spark, ("bad", "2026-06", "raw/ons/bad.json", 4, None)))
    found = jobs.reading_outcomes(spark, str(lake), stored_ledger(spark, lake))
    told = {(r.resource_id, r.check_name): r.passed for r in found.collect()}
    assert not told["bad", "readable"] and not told["bad", "not_empty"] and told["s", "readable"] and told["s", "not_empty"]
    assert {"duplicates", "unexpected_nulls", "negative_values", "missing_hours"} <= {k for r, k in told if r == "s"}


def test_unreadable_files_and_lost_months(spark, lake):
    (lake / "raw" / "ons" / "cut off.json").write_text('[{"cod_areacarga": "S", "din_ref')
    jobs.land(spark, str(lake), arrivals(spark, ("cut", "2026-06x", "raw/ons/cut off.json", 4, 2)))
    paths = build(spark, lake)
    assert [r.problem for r in spark.read.parquet(paths.rejects).collect()] == ["not readable as JSON"]
    _, states = validated(spark, lake)
    june = states.where("is_active_for_gold AND resource_id <> 'july'")
    jobs.build_load_products(spark, str(lake), june, areas=("S", "N"), created_at=F.lit("2026-08-02"))
    assert {r.month for r in spark.read.parquet(paths.hourly).collect()} == {6}


def test_superseded_files_are_not_opened(spark, lake):
    build(spark, lake)
    (lake / "raw" / "ons" / "s.json").write_text("not even JSON")
    _, states = validated(spark, lake)
    some = states.where("is_active_for_gold AND resource_id <> 's'")
    paths = jobs.build_load_products(spark, str(lake), some, areas=("S", "N"), created_at=F.lit("2026-08-02"))
    assert spark.read.parquet(paths.rejects).count() == 0 and spark.read.parquet(paths.readings).where("area = 'S' AND month = 6").count() == 2


def test_metrics_are_stored(spark, lake):
    build(spark, lake)
    other = spark.createDataFrame([("S", h, 1.0 + h, "other", "x") for h in range(24)], "area string, hour int, avg_mw double, source string, geographic_scope string")
    jobs.report_load_metrics(spark, str(lake), other)
    for name in ("load_metrics", "flexibility_candidates", "source_comparison"):
        assert spark.read.option("header", True).csv(tables.layer_path(str(lake), "gold", name)).count() > 0


def test_stored_tables_are_pruned(spark, lake):
    paths = build(spark, lake)

    def scan(df):
        mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        return df._jdf.queryExecution().explainString(mode)

    hourly = scan(spark.read.parquet(paths.hourly).where("year = 2026 AND month = 7").select("load_hourly_mw"))
    assert "PartitionFilters: [isnotnull(year" in hourly and "Filter" not in hourly.split("PartitionFilters")[0] and "ReadSchema: struct<load_hourly_mw:double>" in hourly
    pruned = scan(spark.read.parquet(paths.hourly).where((F.col("year") * 100 + F.col("month")).isin([202607])))
    assert "* 100) + month" in pruned.split("PartitionFilters: ")[1]
    versions = scan(ledger.files_of(stored_ledger(spark, lake), "ons", "carga", "latest_downloaded").select("local_path"))
    assert "EqualTo(source,ons)" in versions and "EqualTo(dataset,carga)" in versions


def test_freshness_report(spark, lake):
    _, states = validated(spark, lake)
    sources = spark.createDataFrame([("ons", 3)], "source string, expected_lag_days int")
    report = jobs.report_freshness(spark, str(lake), states, sources, F.lit("2026-07-03"))
    assert report.first().freshness_status == "fresh"


def test_windows_to_fetch(spark, lake):
    sources = spark.createDataFrame([("ons", 40)], "source string, recheck_days int")
    found = jobs.month_windows_to_fetch(sources, stored_ledger(spark, lake), F.lit("2026-08-10").cast("date"))
    assert {r.reference_period: r.already_landed for r in found.collect()} == {"2026-07": True, "2026-08": False}


def test_scenario_report(spark, tmp_path):
    def points(values):
        return spark.createDataFrame([("brasil", y, v) for y, v in values.items()], "country string, year int, value double")

    weights = spark.createDataFrame([("brasil", "rj", 0.039295, 0.0994810126582, 0.06252325)],
                                    "country string, region string, weight_low double, weight_high double, weight_central double")
    curves = spark.createDataFrame([(r, h, m * (1000.0 + h)) for r, m in (("brasil", 90), ("rj", 6)) for h in range(24)],
                                   "region string, hour int, avg_mw double")
    report = jobs.scenario_report(points({2026: 0.7, 2030: 1.8, 2035: 3.4}), points({2034: 5.0}), points({2025: 0.627, 2035: 7.8}),
                                  weights, curves, first_year=2026, last_year=2035, impact_year=2035)
    found = {(r.region, r.case, r.strategy): r for r in report.summary.collect()}
    assert len(found) == 12 and report.hourly.count() == 288
    assert found["brasil", "central", "smart"].n_vehicles == 2196924
    assert found["rj", "upper_bound", "smart"].n_vehicles == 282437
    assert found["brasil", "central", "uncontrolled"].daily_energy_added_mwh == 12037.94
    context = {r.year: r.value for r in report.context.collect()}
    assert (context[2026], context[2030], context[2035]) == (0.8068, 2.2115, 7.8)
    jobs.store_scenarios(report, str(tmp_path))
    assert spark.read.option("header", True).csv(str(tmp_path / "gold" / "scenarios_summary")).count() == 12


def test_class_curves(spark, tmp_path):
    folder = tmp_path / "raw" / "aneel_ctr"
    folder.mkdir(parents=True)
    header = ";".join(landed.CLASS_CURVE_FIELDS)
    for name, value in (("old", "1,0"), ("new", "10,5")):
        line = f"2026-01-01;1;LIGHT;2026;x;B1;Residencial;Dia Útil;00:00;01:00;{value}"
        (folder / f"{name}.csv").write_text(f"{header}\n{line}\n{line.replace('00:00;01:00', '01:00;02:00')}\n")
    data = [("aneel_ctr", "consumidor_tipo", n, None, f"raw/aneel_ctr/{n}.csv", datetime(2026, 7, i), None)
            for i, n in ((1, "old"), (2, "new"))]
    jobs.land(spark, str(tmp_path), spark.createDataFrame(data, ARRIVAL))
    versions = stored_ledger(spark, tmp_path)
    assert jobs.build_class_curves(spark, str(tmp_path), versions) is None
    _, states = jobs.validate(versions, jobs.presence_outcomes(versions, versions))
    out = jobs.build_class_curves(spark, str(tmp_path), states, ["Residencial"])
    assert [(r.mean_mw, r.normalized_load) for r in spark.read.parquet(out).collect()] == [(10.5, 1.0)] * 2
    report = next((tmp_path / "gold" / "class_average_24h").glob("*.csv")).read_text()
    assert report == "label,hour,avg_mw,normalized_load\nResidencial,0,10.5,1.0\nResidencial,1,10.5,1.0\n"


def test_monthly_energy_calibrates_an_area(spark):
    rows = spark.createDataFrame([("20260601", "RJ", 600.0), ("20260601", " rj", 120.0), ("2026-07-01", "Rio de Janeiro", 744.0),
                                  ("20260601", "SP", 9e9), ("?", "RJ", 5.0)], "Data string, UF string, Consumo double")
    energy = jobs.monthly_energy_of(rows, ("rj", "rio de janeiro"), "RJ")
    assert {r.month: r.average_power_mw for r in energy.collect()} == {6: 1.0, 7: 1.0}
    flat = [("RJ", t, h, 1.0) for t in ("weekday", "saturday", "sunday", "holiday") for h in range(24)]
    shapes = spark.createDataFrame(flat, "area string, day_type string, hour int, normalized_load double")
    curve, summary = jobs.calibrate_area(shapes, energy, calendar.holidays_between(spark, 2026, 2026))
    assert {round(r.estimated_load_mw, 9) for r in curve.collect()} == {1.0}
    assert {r.month: round(r.estimated_energy_mwh, 6) for r in summary.collect()} == {6: 720.0, 7: 744.0}


def test_stream_of_readings(spark, tmp_path):
    schema = "area string, ts timestamp, load_mw double, retrieved_at timestamp"
    source = str(tmp_path / "in")

    def arrive(*rows):
        spark.createDataFrame([(a, datetime.fromisoformat(t), v, datetime(2026, 7, day)) for a, t, v, day in rows], schema).coalesce(
            1
        ).write.mode("append").parquet(source)

    arrive(("S", "2026-06-02T13:00:00", 10.0, 1))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source)
    hourly = hourly_stream(stream, calendar.holidays_between(spark, 2026, 2026))
    query = (
        hourly.writeStream.outputMode("update").format("memory").queryName("hours")
        .option("checkpointLocation", str(tmp_path / "cp")).start()
    )
    try:
        query.processAllAvailable()
        arrive(("S", "2026-06-02T13:30:00", 30.0, 1), ("S", "2026-06-02T13:00:00", 20.0, 2))
        query.processAllAvailable()
    finally:
        query.stop()
    found = [(r.hour, r.load_hourly_mw, r.n_intervals, r.quality_flag, r.day_type) for r in spark.table("hours").collect()]
    assert found == [(10, 10.0, 1, "incomplete_hour", "weekday"), (10, 25.0, 2, "ok", "weekday")]


def test_stream_of_arrivals(spark, tmp_path):
    path, source = str(tmp_path / "ledger"), str(tmp_path / "in")
    schema = "source string, resource_id string, hash_sha256 string, retrieved_at timestamp, local_path string"
    data = [("ons", "a", h, datetime(2026, 6, 1), f"raw/{i}") for i, h in enumerate("xxy")]
    spark.createDataFrame(data, schema).write.parquet(source)
    register = register_into(path)
    query = (
        spark.readStream.schema(schema).parquet(source).writeStream.foreachBatch(register)
        .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    )
    query.awaitTermination(120)
    register(spark.read.parquet(source), 1)  # a replay
    assert sorted(r.hash_sha256 for r in spark.read.parquet(path).collect()) == ["x", "y"]


def written_again(root, name, area, loads):
    """Other content under the same path, with a later modification time."""
    import os

    path = readings_file(root, name, area, 2, loads)
    os.utime(root / path, (2_000_000_000, 2_000_000_000 + len(loads)))
    return path


def test_new_content_under_an_old_path_is_a_version_and_a_revision(spark, lake):
    path = written_again(lake, "s.json", "S", [10, 20, 30, 99])
    fresh, log = jobs.land(spark, str(lake), arrivals(spark, ("s", "2026-06", path, 5, 4)), jobs.reading_rows(spark, str(lake)))
    assert fresh.count() == 1 and fresh.first().row_count == 4 and stored_ledger(spark, lake).count() == 5
    row = log.first()
    assert log.count() == 1 and (row.resource_id, row.rows_added) == ("s", None)  # the old content is gone
    fresh, log = jobs.land(spark, str(lake), arrivals(spark, ("s", "2026-06", path, 6, 4)))
    assert fresh.count() == 0 and log.count() == 1
    with pytest.raises(ValueError, match="newer content"):
        jobs.typed_rows(spark, str(lake), stored_ledger(spark, lake).where("resource_id = 's'"))


@pytest.mark.parametrize("ends_at", ["ledger", "source_revision_log", "landed_files"])
def test_a_landing_that_ended_between_writes_is_completed(spark, lake, monkeypatch, ends_at):
    path = readings_file(lake, "s_new.json", "S", 2, [10, 20, 30, 41])
    append = tables.append

    def ending(df, to):
        append(df, to)
        if to.endswith(ends_at):
            raise RuntimeError("the job ends here")

    monkeypatch.setattr(tables, "append", ending)
    with pytest.raises(RuntimeError):
        jobs.land(spark, str(lake), arrivals(spark, ("s", "2026-06", path, 3, 4)))
    monkeypatch.setattr(tables, "append", append)
    _, log = jobs.land(spark, str(lake), arrivals(spark, ("s", "2026-06", path, 3, 4)))
    assert stored_ledger(spark, lake).count() == 5 and [r.resource_id for r in log.collect()] == ["s"]


@pytest.mark.parametrize("ends_at", ["quality_report", "gate_decisions"])
def test_a_promotion_that_ended_between_writes_is_completed_once(spark, lake, monkeypatch, ends_at):
    versions = stored_ledger(spark, lake)
    outcomes = jobs.presence_outcomes(versions, versions.select("local_path"))
    at = F.lit("2026-08-01 00:00:00")
    append = tables.append

    def ending(df, to):
        append(df, to)
        if to.endswith(ends_at):
            raise RuntimeError("the job ends here")

    monkeypatch.setattr(tables, "append", ending)
    with pytest.raises(RuntimeError):
        jobs.promote(spark, str(lake), outcomes, at)
    monkeypatch.setattr(tables, "append", append)
    _, states = jobs.promote(spark, str(lake), outcomes, at)
    assert states.where("is_active_for_gold").count() == 4
    for name, rows in (("quality_report", 8), ("gate_decisions", 4)):
        assert spark.read.parquet(tables.layer_path(str(lake), "metadata", name)).count() == rows


def test_every_check_can_fail_a_version(spark, tmp_path):
    """One version per check that fails it, judged together from one parse."""
    day = [10.0] * 48
    loads = {"fine": day, "negative": [-1.0, *day[1:]], "short": day[:10], "stale": day, "shrunk": day}
    rows = []
    for name, values in loads.items():
        rows.append((name, None, readings_file(tmp_path, f"{name}.json", "S", 20, values), 1, None))
    for at in range(2, 6):  # earlier versions of other sizes, and one that reached further
        rows.append(("shrunk", None, readings_file(tmp_path, f"shrunk{at}.json", "S", 20, [10.0 + at] * (48 - at % 2)), at, None))
    rows.append(("shrunk", None, readings_file(tmp_path, "shrunk9.json", "S", 20, [1.0, 2.0]), 9, None))
    rows.append(("stale", None, readings_file(tmp_path, "stale2.json", "S", 19, day), 2, None))
    folder = tmp_path / "raw" / "ons"
    record = {"cod_areacarga": "S", "din_referenciautc": "2026-06-20T03:00:00Z", "val_cargaglobal": 1}
    texts = {
        "twice": json.dumps([record, record]), "nulls": json.dumps([record, {**record, "cod_areacarga": None}]), "broken": "[{",
        "fieldless": json.dumps([{**record, "val_cargaglobal": None}]), "empty": "[]",
    }
    for name, text in texts.items():
        (folder / f"{name}.json").write_text(text)
        rows.append((name, None, f"raw/ons/{name}.json", 1, None))
    jobs.land(spark, str(tmp_path), arrivals(spark, *rows))
    versions = stored_ledger(spark, tmp_path)
    for _ in range(2):  # a repeated run adds nothing to the history
        outcomes = jobs.gate_outcomes(spark, str(tmp_path), versions, F.lit("2026-06-21").cast("date"))
        failed = {(r.resource_id, r.check_name) for r in outcomes.where("NOT passed").collect()}
    expected = {
        ("negative", "negative_values"), ("short", "missing_hours"), ("twice", "duplicates"), ("nulls", "unexpected_nulls"), ("broken", "readable"),
        ("fieldless", "schema"), ("empty", "not_empty"), ("stale", "coverage_regression"), ("stale", "completeness_window"), ("shrunk", "row_count_anomaly"),
    }
    assert expected <= failed and not {name for name, _ in failed} & {"fine"}
    names = {r.check_name for r in outcomes.where("resource_id = 'fine'").collect()}
    assert names == {"not_empty", "duplicates", "unexpected_nulls", "negative_values", "missing_hours", "completeness_window", "readable", "schema",
                     "energy_power_consistency", "coverage_regression", "row_count_anomaly"}
    _, states = jobs.promote(spark, str(tmp_path), outcomes, F.lit("2026-08-01"))
    status = {r.resource_id: r.lifecycle_status for r in states.where("is_latest_downloaded").collect()}
    assert status["fieldless"] == status["broken"] == status["stale"] == "quarantined" and status["fine"] != "quarantined"
