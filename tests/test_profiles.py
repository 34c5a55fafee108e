import random
from datetime import date, timedelta

import pytest

from loadlake.operators import metrics, profiles


@pytest.fixture
def hourly(spark):
    rng = random.Random(1)
    data = []
    for area, days in (("A", 40), ("B", 3)):
        for d in range(days):
            day = date(2026, 1, 1) + timedelta(days=d)
            kind = ("weekday", "saturday")[d % 7 == 2]
            data += [(area, day, day.year, day.month, h, kind, rng.uniform(50, 90) + h) for h in range(24)]
    data.append(("A", date(2026, 3, 1), 2026, 3, 0, "sunday", None))
    schema = "area string, date date, year int, month int, hour int, day_type string, load_hourly_mw double"
    return spark.createDataFrame(data, schema)


def by_hand(data, q):
    s = sorted(data)
    return s[int((len(s) - 1) * q + 0.5)]


def test_profile_values(hourly):
    at = [r.load_hourly_mw for r in hourly.where("area = 'A' AND hour = 5").collect()]
    row = profiles.profile_24h(hourly).where("area = 'A' AND hour = 5").first()
    assert row.avg_mw == pytest.approx(sum(at) / len(at))
    assert (row.p05_mw, row.p95_mw) == (by_hand(at, 0.05), by_hand(at, 0.95))
    assert row.median_mw == pytest.approx((sorted(at)[19] + sorted(at)[20]) / 2)


def test_normalized_load_averages_to_one(hourly):
    for area in "AB":
        loads = [r.normalized_load for r in profiles.profile_24h(hourly).where(f"area = '{area}'").collect()]
        assert len(loads) == 24 and sum(loads) / 24 == pytest.approx(1)


def test_grains(hourly, rows):
    whole = profiles.all_profiles(hourly)
    columns = ("area", "hour", "avg_mw", "median_mw", "p05_mw", "p95_mw")
    assert rows(whole.where("grain = 'month'"), "month", *columns) == rows(
        profiles.profile_by_month(hourly), "month", *columns
    )
    assert rows(whole.where("grain = 'day_type'"), "day_type", *columns) == rows(
        profiles.profile_by_day_type(hourly), "day_type", *columns
    )
    assert profiles.profile_by_month(hourly, with_year=True).columns[:3] == ["area", "year", "month"]
    empty = profiles.profile_by_month(hourly).where("month = 3").first()
    assert (empty.avg_mw, empty.median_mw, empty.p05_mw) == (None, None, None)


def test_grains_need_one_exchange_of_the_rows(hourly):
    physical = profiles.all_profiles(hourly)._jdf.queryExecution().executedPlan().toString()
    assert physical.count("Exchange hashpartitioning") == 2  # rows by (area, hour), then 24 means by area
    assert physical.count("Scan") == 1


def test_row_order_does_not_matter(hourly, rows):
    mixed = hourly.orderBy("load_hourly_mw").repartition(5)
    assert rows(profiles.profile_24h(hourly), "area", "hour", "median_mw", "p05_mw") == rows(
        profiles.profile_24h(mixed), "area", "hour", "median_mw", "p05_mw"
    )


def curve(spark, values, area="A"):
    return spark.createDataFrame([(area, h, float(v)) for h, v in enumerate(values)], "area string, hour int, avg_mw double")


def test_load_metrics(spark):
    row = metrics.load_metrics(curve(spark, [100] * 17 + [200, 220, 210] + [100] * 4)).first()
    assert (row.peak_load_mw, row.peak_hour, row.minimum_load_mw, row.minimum_hour) == (220, 18, 100, 0)
    assert row.peak_valley_mw == 120 and row.daily_energy_mwh == 2730
    assert row.load_factor == pytest.approx(2730 / 24 / 220)
    assert row.peak_3h_energy_share == pytest.approx(630 / 2730)
    assert row.share_17_22 == pytest.approx(930 / 2730) and row.share_18_21 == pytest.approx(630 / 2730)


def test_metrics_of_a_flat_zero_curve(spark):
    row = metrics.load_metrics(curve(spark, [0] * 24)).first()
    assert (row.load_factor, row.peak_to_average_ratio, row.share_17_22, row.peak_3h_energy_share) == (0, 0, 0, 0)
    assert (row.peak_hour, row.minimum_hour) == (0, 0)


def test_flexibility_candidates(spark):
    values = list(range(24))
    found = metrics.flexibility_candidates(curve(spark, values)).orderBy("hour").collect()
    assert found[23].above_daily_mean_mw == pytest.approx(23 - 11.5) and found[0].above_daily_mean_mw == 0
    assert found[23].above_p90_mw == 2 and found[20].above_p90_mw == 0
    assert [r.potential_shift_window for r in found].count("candidate_peak_shift") == 12


def test_compare_sources_keeps_both_scopes(spark):
    schema = "metric string, value double, source string, geographic_scope string"
    a = spark.createDataFrame([("peak", 100.0, "ons", "ONS_load_area"), ("only_a", 1.0, "ons", "ONS_load_area")], schema)
    b = spark.createDataFrame([("peak", 110.0, "aneel", "RJ_state")], schema)
    found = {r.metric: r for r in metrics.compare_sources(a, b).collect()}
    assert found["peak"].difference == 10 and found["peak"].difference_pct == pytest.approx(10)
    assert not found["peak"].same_scope and found["only_a"].value_b is None
