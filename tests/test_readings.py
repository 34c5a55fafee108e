import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from loadlake.operators import calendar, readings
from loadlake.sources import landed


def record(utc, load, area="RJ", **more):
    return {"cod_areacarga": area, "dat_referencia": utc[:10], "din_referenciautc": utc, "val_cargaglobal": load, **more}


MORNING = [
    record("2026-06-02T13:00:00", 1000.0, val_consistencia="Não Consistida", val_cargaglobalsmmg=990.0),
    record("2026-06-02T13:30:00", 1010.0),
    record("2026-06-02T14:00:00", 1020.0),
    record("2026-06-02T14:30:00", 1030.0),
    record("2026-06-02T15:00:00", 1040.0),
]
EVENING = [record("2026-09-26T02:00:00.000Z", 6255.6074, val_consistencia=0), record("2026-09-26T02:30:00.000Z", 0)]


@pytest.fixture
def silver(spark, tmp_path):
    def make(**files):
        for name, payload in files.items():
            (tmp_path / f"{name}.json").write_text(json.dumps(payload, indent=1), encoding="utf-8")
        raw = landed.read_readings(spark, str(tmp_path))
        return readings.type_readings(raw, calendar.holidays_between(spark, 2026, 2026))

    return make


def hour_row(df, hour):
    return readings.hourly_load(df).where(F.col("hour") == hour).first()


def test_mean_energy_and_flag(silver):
    df = silver(a=MORNING)
    assert df.count() == 5
    full, single = hour_row(df, 10), hour_row(df, 12)
    assert (full.load_hourly_mw, full.energy_hourly_mwh, full.quality_flag) == (1005.0, 1005.0, "ok")
    assert hour_row(df, 11).load_hourly_mw == 1025.0
    assert (single.n_intervals, single.quality_flag, single.energy_hourly_mwh) == (1, "incomplete_hour", 520.0)


def test_zero_is_a_placeholder(silver):
    df = silver(a=EVENING)
    assert [r.load_mw for r in df.orderBy("ts_utc").collect()] == [6255.6074, None]
    row = hour_row(df, 23)
    assert (row.load_hourly_mw, row.n_intervals, row.quality_flag) == (6255.6074, 1, "incomplete_hour")
    assert readings.placeholder_counts(df).first().n_placeholders == 1


def test_hour_without_readings_has_null_mean_and_no_energy(silver):
    row = hour_row(silver(a=[record("2026-06-02T13:00:00Z", 0)]), 10)
    assert row.load_hourly_mw is None and row.energy_hourly_mwh == 0.0 and row.n_intervals == 0


def test_envelopes_and_empty_files(silver):
    df = silver(a={"data": MORNING[:2]}, b={"result": MORNING[2:3]}, c=[], d={"data": []}, e={"other": 1},
                f={"data": MORNING[3:4], "result": MORNING[4:]})
    usable, rejected = readings.split_rejects(df)
    assert sorted(r.load_mw for r in usable.collect()) == [1000.0, 1010.0, 1020.0, 1030.0]
    assert rejected.count() == 1  # the object without records


def test_system_total_of_many_areas(spark):
    names = [f"area{i}" for i in range(200)]
    row = "date date, year int, month int, day int, hour int, day_type string, area string, load_hourly_mw double, energy_hourly_mwh double, quality_flag string"
    data = [(None, 2026, 6, 1, h, "weekday", a, 1.0, 1.0, "ok") for h in (0, 1) for a in names if (h, a) != (1, "area7")]
    total = readings.system_hourly(spark.createDataFrame(data, row), names).collect()
    assert [(r.hour, r.load_hourly_mw) for r in total] == [(0, 200.0)]


def test_holidays_of_any_year(spark):
    days = spark.sql("SELECT explode(array(DATE '1985-12-25', DATE '2101-12-25', DATE '2150-04-21', DATE '1985-12-26', NULL)) AS date")
    kinds = [r.day_type for r in calendar.with_day_type(days).collect()]
    assert kinds == ["holiday", "holiday", "holiday", "weekday", None]


def test_unreadable_fields_become_null_and_timestamps_rejects(silver):
    df = silver(a=[record("not a time", 5.0), record("2026-06-02T13:00:00Z", "n/d")])
    usable, rejected = readings.split_rejects(df)
    assert usable.first().load_mw is None and rejected.first().load_mw == 5.0


def test_provenance(silver):
    row = silver(a=MORNING).first()
    assert (row.source, row.dataset, row.geographic_scope) == ("ons", "carga_verificada", "ONS_load_area")
    assert (row.geographic_precision, row.observation_type, row.area) == ("approximate", "observed", "RJ")


def test_overlapping_files_keep_the_last_retrieved(spark):
    at = datetime(2026, 6, 2, 13)
    data = [("RJ", at, float(i % 7), datetime(2026, 7, 1, i % 24), f"h{i:03d}", f"r{i}") for i in range(500)]
    data.append(("RJ", at, 99.0, datetime(2026, 8, 1), "h", "last"))
    data.append(("SP", at, 1.0, None, None, None))
    schema = "area string, ts_utc timestamp_ntz, load_mw double, retrieved_at timestamp, hash_sha256 string, resource_id string"
    df = spark.createDataFrame(data, schema).repartition(7)
    found = {r.area: (r.load_mw, r.resource_id) for r in readings.latest_readings(df).collect()}
    assert found == {"RJ": (99.0, "last"), "SP": (1.0, None)}


def test_autumn_hour_holds_four_readings(spark, silver):
    # 2018-02-18: 24:00 local became 23:00, so local hour 23 lasts from 01:00 to 03:00 UTC.
    times = ["2018-02-18T01:00:00Z", "2018-02-18T01:30:00Z", "2018-02-18T02:00:00Z", "2018-02-18T02:30:00Z"]
    row = hour_row(silver(a=[record(t, 10.0 * (i + 1)) for i, t in enumerate(times)]), 23)
    assert (row.n_intervals, row.load_hourly_mw, row.energy_hourly_mwh) == (4, 25.0, 50.0)


def hourly_of(spark, data):
    schema = "area string, hour int, load_hourly_mw double, energy_hourly_mwh double, quality_flag string"
    df = spark.createDataFrame(data, schema)
    fixed = {"date": F.lit("2026-06-02").cast("date"), "year": F.lit(2026), "month": F.lit(6), "day": F.lit(2)}
    return df.withColumns({**fixed, "day_type": F.lit("weekday")})


def test_system_needs_every_area(spark):
    df = hourly_of(spark, [("S", 1, 1.0, 1.0, "ok"), ("N", 1, 2.0, 2.0, "ok"), ("S", 2, 1.0, 1.0, "ok"),
                           ("S", 3, None, 0.0, "incomplete_hour"), ("N", 3, 2.0, 2.0, "ok"), ("X", 2, 9.0, 9.0, "ok")])
    found = {r.hour: r for r in readings.system_hourly(df, ("S", "N")).collect()}
    assert set(found) == {1, 3}
    assert (found[1].load_hourly_mw, found[1].quality_flag) == (3.0, "ok")
    assert (found[3].load_hourly_mw, found[3].energy_hourly_mwh) == (None, 2.0)
    assert found[3].quality_flag == "incomplete_hour" and found[1].observation_type == "derived"


def test_system_is_empty_without_an_area(spark):
    assert readings.system_hourly(hourly_of(spark, [("S", 1, 1.0, 1.0, "ok")]), ("S", "N")).count() == 0


def test_system_takes_one_shuffle(spark):
    df = hourly_of(spark, [("S", 1, 1.0, 1.0, "ok")])
    plan = readings.system_hourly(df, ("S", "N", "NE", "SECO"))._jdf.queryExecution().toString()
    physical = plan[plan.index("Physical Plan") :]
    assert physical.count("Exchange hashpartitioning") == 1 and "Join" not in physical
