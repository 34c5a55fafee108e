import math

import pytest
from pyspark.sql import functions as F

from loadlake.operators import overlay, scenarios

POINTS = {2026: 0.7, 2030: 1.8, 2035: 3.4}


def anchors(spark, points=None, country="brasil"):
    data = [(country, y, float(v)) for y, v in (points or POINTS).items()]
    return spark.createDataFrame(data, "country string, year int, value double")


def dense(spark, points, first, last):
    return {r.year: r for r in scenarios.densify(anchors(spark, points), ["country"], first, last).collect()}


def test_anchors_are_kept_and_growth_is_constant_between_them(spark):
    found = dense(spark, POINTS, 2024, 2037)
    assert all(found[y].value == v and found[y].value_type == "observed_anchor" for y, v in POINTS.items())
    assert found[2028].value == pytest.approx(math.sqrt(0.7 * 1.8)) and found[2028].value_type == "interpolated_exponential"
    assert found[2037].value == pytest.approx(3.4 * (3.4 / 1.8) ** (2 / 5))
    assert found[2024].value == pytest.approx(0.7 * (0.7 / 1.8) ** (2 / 4))


def test_straight_line_where_an_end_is_not_positive(spark):
    found = dense(spark, {2020: 0.0, 2022: 4.0, 2024: 16.0}, 2019, 2024)
    assert [found[y].value for y in (2019, 2021, 2023)] == pytest.approx([-2.0, 2.0, 8.0])


def test_one_anchor_only_knows_its_year(spark):
    found = dense(spark, {2020: 5.0}, 2020, 2021)
    assert (found[2020].value, found[2021].value) == (5.0, None)


@pytest.fixture
def national(spark):
    point = anchors(spark, {2034: 5.0})
    return scenarios.scenario_table(anchors(spark), point, ["country"], 2026, 2035, 2000.0)


def test_scenarios(national):
    found = {(r.scenario, r.year): r for r in national.collect()}
    assert len(found) == 30
    end = {s: found[s, 2035] for s in ("conservador", "intermediario", "acelerado")}
    assert [r.demand_light_ev_twh for r in end.values()] == [3.4, 4.3938, 5.6782]
    assert [r.implied_bev_phev_fleet_units for r in end.values()] == [1700000, 2196924, 2839104]
    assert found["acelerado", 2034].demand_light_ev_twh == 5.0
    assert found["conservador", 2030].value_type == "observed_anchor"
    assert found["conservador", 2031].value_type == "interpolated_exponential"
    assert found["acelerado", 2030].value_type == "derived_constant_ratio"
    assert found["intermediario", 2030].value_type == "derived_geometric_mean"
    for year in range(2026, 2036):
        low, middle, high = (found[s, year].demand_light_ev_twh for s in end)
        assert low < middle < high


def weights(spark):
    df = spark.createDataFrame([("brasil", "rj", 39295, 1_000_000, 395_000)], "country string, region string, rj long, broad long, narrow long")
    return scenarios.share_bounds(df, "rj", "broad", "narrow")


def test_shares(spark):
    row = weights(spark).first()
    assert (row.weight_low, row.weight_high) == (39295 / 1_000_000, 39295 / 395_000)
    assert row.weight_central == pytest.approx(math.sqrt(row.weight_low * row.weight_high))


def test_allocation(spark, national):
    found = {
        (r.scenario, r.rj_weight_case): r
        for r in scenarios.allocate(national, weights(spark), ["country"]).where("year = 2035").collect()
    }
    assert len(found) == 9
    assert found["intermediario", "central"].implied_bev_phev_fleet_units == 137358
    assert found["acelerado", "high"].implied_bev_phev_fleet_units == 282437
    assert {r.value_type for r in found.values()} == {"derived_proportional_national_share"}


def test_growth_rate(spark):
    df = spark.createDataFrame([(3263.0, 30000.0, 4), (0.0, 5.0, 4), (1.0, 2.0, 0)], "a double, b double, n int")
    found = [r[0] for r in df.select(scenarios.growth_rate(F.col("a"), F.col("b"), F.col("n"))).collect()]
    assert found == [pytest.approx((30000 / 3263) ** 0.25 - 1), None, None]


def test_consistency_ratio(spark, national):
    implied = national.where("year = 2035").select("country", "scenario", F.col("implied_bev_phev_fleet_units").alias("implied_units"))
    official = spark.createDataFrame([("brasil", 3_700_000)], "country string, official_units long")
    found = {r.scenario: r.consistency_ratio for r in scenarios.consistency_ratio(implied, official, ["country"]).collect()}
    assert found["acelerado"] == pytest.approx(2839104 / 3_700_000)


def curve(spark, *areas):
    shape = [50 - 20 * math.cos((h - 4) / 24 * 2 * math.pi) for h in range(24)]
    data = [(a, h, (i + 1) * 100 * v) for i, a in enumerate(areas) for h, v in enumerate(shape)]
    return spark.createDataFrame(data, "area string, hour int, avg_mw double")


def by_strategy(df):
    found = {}
    for r in df.collect():
        found.setdefault((r.area, r.strategy), {})[r.hour] = r
    return found


def test_every_strategy_keeps_the_energy(spark):
    shapes = by_strategy(overlay.charging_shapes(curve(spark, "A", "B")))
    assert len(shapes) == 6
    for hours in shapes.values():
        assert sum(r.weight for r in hours.values()) == pytest.approx(1)


def test_smart_cuts_the_peak_and_fills_the_valley(spark):
    shapes = by_strategy(overlay.charging_shapes(curve(spark, "A")))
    free, smart = shapes["A", "uncontrolled"], shapes["A", "smart"]
    for h in (17, 18, 19, 20):
        assert smart[h].weight == pytest.approx(free[h].weight * 0.62)
    gained = {h: smart[h].weight - free[h].weight for h in range(24) if h not in (17, 18, 19, 20)}
    assert max(gained, key=gained.get) == 4 and min(gained.values()) >= 0


def test_shifted_demand_stays_in_its_window(spark):
    shifted = by_strategy(overlay.charging_shapes(curve(spark, "A")))["A", "offpeak_shifted"]
    assert [h for h, r in shifted.items() if r.weight > 0] == list(range(6))


@pytest.fixture
def overlaid(spark):
    cases = spark.createDataFrame([("A", "x", 1000), ("A", "y", 0), ("B", "x", 10**6)], "area string, case string, n_vehicles long")
    return overlay.overlay_hourly(curve(spark, "A", "B"), cases)


def test_overlay_adds_the_daily_energy(overlaid):
    for r in overlaid.groupBy("area", "case", "strategy").agg(F.sum("added_mw").alias("s"), F.max("n_vehicles").alias("n"),
                                                              F.avg("total_normalized").alias("m")).collect():
        assert r.s == pytest.approx(r.n * 2000 / 365 / 1000) and r.m == pytest.approx(1)


def test_summary(overlaid):
    found = {(r.area, r.case, r.strategy): r for r in overlay.overlay_summary(overlaid, rounded=False).collect()}
    assert len(found) == 9
    idle = found["A", "y", "uncontrolled"]
    assert idle.peak_increase_pct == 0 and not idle.peak_hour_shifted and idle.baseline_peak_hour == 16
    big = {s: found["B", "x", s] for s in overlay.STRATEGIES}
    assert big["smart"].new_peak_mw < big["uncontrolled"].new_peak_mw
    assert big["uncontrolled"].peak_hour_shifted and big["uncontrolled"].new_peak_hour == 17


def test_lowest_hour_wins_a_tie(spark):
    flat = spark.createDataFrame([("A", h, 10.0) for h in range(24)], "area string, hour int, avg_mw double")
    cases = spark.createDataFrame([("A", "x", 0)], "area string, case string, n_vehicles long")
    row = overlay.overlay_summary(overlay.overlay_hourly(flat, cases)).first()
    assert (row.baseline_peak_hour, row.new_peak_hour) == (0, 0)


def test_normalize_weights(spark):
    df = spark.createDataFrame([("a", 0, 1.0), ("a", 1, 3.0), ("b", 0, 0.0)], "strategy string, hour int, weight double")
    found = {(r.strategy, r.hour): r.weight for r in overlay.normalize_weights(df).collect()}
    assert found == {("a", 0): 0.25, ("a", 1): 0.75, ("b", 0): None}
