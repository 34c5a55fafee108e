import random
import statistics
from datetime import date

import pytest
from pyspark.sql import functions as F

from loadlake.operators import quality
from loadlake.operators.keys import with_previous


def outcomes(df):
    return {r.check_name: r for r in df.collect()}


def table(spark, data, schema="r string, key int, load_mw double, date date, hour int"):
    return spark.createDataFrame(data, schema)


def full_day(r="a", day=1, hours=range(24)):
    return [(r, day * 100 + h, 1.0, date(2026, 1, day), h) for h in hours]


CHECKS = {"key": ["key"], "required": ["load_mw", "absent"], "value": "load_mw", "date": "date", "hour": "hour"}


def test_clean_table_passes(spark):
    found = outcomes(quality.table_checks(table(spark, full_day()), ["r"], **CHECKS))
    assert set(found) == {"not_empty", "duplicates", "unexpected_nulls", "negative_values", "missing_hours"}
    assert all(r.passed for r in found.values()) and found["not_empty"].rows_affected == 24


def test_problems_are_counted(spark):
    data = full_day() + full_day(day=2, hours=range(23)) + [("a", 100, -5.0, date(2026, 1, 1), 0), ("a", 999, None, None, None)]
    found = outcomes(quality.table_checks(table(spark, data), ["r"], min_rows=100, **CHECKS))
    assert {n: r.rows_affected for n, r in found.items()} == {
        "not_empty": 49, "duplicates": 1, "unexpected_nulls": 1, "negative_values": 1, "missing_hours": 2,
    }
    assert not any(r.passed for r in found.values())
    assert {n for n, r in found.items() if r.severity == "error"} == {"not_empty", "duplicates", "unexpected_nulls"}


def test_null_keys_are_equal(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", None, 1), ("a", None, 2)], "r string, k string, n int")
    found = outcomes(quality.table_checks(df, ["r"], key=["k", "n"]))
    assert found["duplicates"].rows_affected == 1


def test_negative_values_not_applicable(spark):
    df = table(spark, [("a", 1, -1.0, None, None)])
    assert outcomes(quality.table_checks(df, ["r"], value="absent"))["negative_values"].passed
    assert outcomes(quality.table_checks(df, ["r"], value="load_mw", allow_negative=True))["negative_values"].passed


def test_expected_resource_without_rows(spark):
    expected = spark.createDataFrame([("a",), ("b",)], "r string")
    end = F.lit("2026-01-02").cast("date")
    found = quality.table_checks(table(spark, full_day()), ["r"], expected=expected, expected_end=end, **CHECKS)
    by = {(r.r, r.check_name): r.passed for r in found.collect()}
    assert by["a", "not_empty"] and by["a", "completeness_window"]
    assert not by["b", "not_empty"] and not by["b", "completeness_window"]
    assert by["b", "duplicates"] and by["b", "missing_hours"]


def test_completeness_window_is_one_day_lenient(spark):
    def passed(end):
        end = F.lit(end).cast("date")
        return outcomes(quality.table_checks(table(spark, full_day()), ["r"], date="date", expected_end=end))[
            "completeness_window"
        ].passed

    assert passed("2026-01-02") and not passed("2026-01-03")


def test_schema(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "x"), ("b", "z")], "r string, column_name string")
    found = {r.r: r for r in quality.schema_checks(df, ["r"], ["x", "y"]).collect()}
    assert found["a"].passed and found["a"].details == "as expected"
    assert not found["b"].passed and found["b"].details == "missing: y; extra: z"


def test_coverage_regression_across_blocks(spark):
    days = [None, 5, 7, 6, 6, None, 9]
    data = [("a", i, None if d is None else date(2026, 1, d)) for i, d in enumerate(days)]
    df = spark.createDataFrame(data, "r string, v int, max_date date")
    for size in (1, 2, 100):
        found = quality.coverage_regression(df, ["r"], ["v"], F.floor(F.col("v") / size)).orderBy("v").collect()
        assert [r.passed for r in found] == [True, True, True, False, True, True, True]


def test_previous_matches_a_plain_loop_with_a_hot_key(spark):
    rng = random.Random(5)
    data = [(rng.choice(["hot"] * 8 + ["b", None]), i, rng.choice([None, "x", "y", "z"])) for i in range(800)]
    expected, last = [], {}
    for k, i, v in data:
        expected.append((i, last.get(k)))
        last[k] = v
    df = spark.createDataFrame(data, "k string, i int, v string").repartition(6)
    found = with_previous(df, ["k"], ["i"], ["v"], F.floor(F.col("i") / 50)).orderBy("i").collect()
    assert [(r.i, r.previous_v) for r in found] == expected


@pytest.mark.parametrize(
    ("history", "current", "passed"),
    [
        ([100, 101, 99, 100, 102], 100, True),
        ([100, 101, 99, 100, 102], 1000, False),
        ([100, 100, 100], 100, True),
        ([100, 100, 100], 101, False),
        ([100, 101], 9999, True),
    ],
)
def test_row_count_anomaly(spark, history, current, passed):
    data = [("a", i, n) for i, n in enumerate([*history, current])]
    row = quality.row_count_anomaly(spark.createDataFrame(data, "r string, v int, row_count long"), ["r"], ["v"]).first()
    assert row.passed is passed and row.severity == "warning" and row.row_count == current
    if len(history) >= 3:
        centre = statistics.median(history)
        assert row.median_row_count == centre
        assert row.mad_row_count == statistics.median([abs(x - centre) for x in history])


def test_energy_power_consistency(spark):
    data = [("a", 100.0, 100.5), ("a", 100.0, 102.0), ("a", 0.0, 0.0), ("a", 0.0, 1.0), ("a", None, 5.0)]
    df = spark.createDataFrame(data, "r string, load_hourly_mw double, energy_hourly_mwh double")
    row = quality.energy_power_consistency(df, ["r"]).first()
    assert row.rows_affected == 2 and not row.passed and row.details.startswith("2 of 4 rows")
    half = quality.energy_power_consistency(df, ["r"], hours=F.lit(0.5)).first()
    assert half.rows_affected == 3


def test_allowed_values(spark):
    df = spark.createDataFrame([("a", "active"), ("a", None), ("b", "odd")], "r string, s string")
    found = {r.r: r.passed for r in quality.allowed_values(df, ["r"], "s", ["active"]).collect()}
    assert found == {"a": True, "b": False}
