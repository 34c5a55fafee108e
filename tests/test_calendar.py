from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from loadlake.functions import temporal
from loadlake.operators import calendar


def local(spark, text, zone=temporal.DEFAULT_ZONE):
    df = spark.createDataFrame([(text,)], "t string").select(temporal.parse_utc(F.col("t")).alias("ts"))
    return calendar.with_local_calendar(df, "ts", zone).first()


@pytest.mark.parametrize(
    ("text", "hour", "day"),
    [
        ("2026-06-02T13:00:00", 10, date(2026, 6, 2)),
        ("2026-06-02T13:00:00.000Z", 10, date(2026, 6, 2)),
        ("2026-06-02T13:00:00+03:00", 7, date(2026, 6, 2)),
        ("2015-10-20T13:00:00Z", 11, date(2015, 10, 20)),
        ("2026-01-01T02:59:59Z", 23, date(2025, 12, 31)),
    ],
)
def test_utc_text_to_local_hour(spark, text, hour, day):
    row = local(spark, text)
    assert (row.hour, row.date) == (hour, day)


def test_bad_timestamp_is_null(spark):
    row = local(spark, "yesterday")
    assert row.ts is None and row.hour is None and row.date is None


def test_result_does_not_depend_on_the_session_zone(spark):
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        assert local(spark, "2015-10-20T13:00:00Z").hour == 11
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_local_source_takes_the_earlier_of_two_hours(spark):
    df = spark.sql("SELECT TIMESTAMP_NTZ '2018-02-17 23:30:00' AS ts")
    row = calendar.with_local_calendar(df, "ts", source_is_utc=False).first()
    assert row.timestamp_utc == datetime(2018, 2, 18, 1, 30)


@pytest.mark.parametrize(
    ("year", "expected"),
    [(1995, date(1995, 4, 16)), (2000, date(2000, 4, 23)), (2019, date(2019, 4, 21)), (2024, date(2024, 3, 31)),
     (2026, date(2026, 4, 5)), (2038, date(2038, 4, 25)), (1818, date(1818, 3, 22))],
)
def test_easter(spark, year, expected):
    assert spark.createDataFrame([(year,)], "y int").select(temporal.easter_sunday("y")).first()[0] == expected


def test_day_types(spark):
    days = ["2026-12-25", "2026-06-01", "2026-06-06", "2026-06-07", "2026-09-07", "2026-06-04"]
    df = spark.createDataFrame([(d,) for d in days], "d string").select(F.to_date("d").alias("date"))
    typed = calendar.with_day_type(df, calendar.holidays_between(spark, 2026, 2026))
    found = {str(r.date): r.day_type for r in typed.collect()}
    assert found == dict(zip(days, ["holiday", "weekday", "saturday", "sunday", "holiday", "weekday"], strict=True))


def test_day_type_accepts_any_table_of_dates(spark):
    own = spark.createDataFrame([(date(2026, 6, 1),), (date(2026, 6, 1),), (None,)], "date date")
    df = spark.createDataFrame([(date(2026, 6, 1),), (None,)], "date date")
    assert [r.day_type for r in calendar.with_day_type(df, own).orderBy("date").collect()] == [None, "holiday"]


def test_day_type_counts_sum_to_the_month(spark):
    months = spark.createDataFrame([(2026, 6), (2024, 2), (2026, 9)], "year int, month int")
    found = calendar.day_type_counts(months).collect()
    totals = {(r.year, r.month): r.weekday + r.saturday + r.sunday + r.holiday for r in found}
    assert totals == {(2026, 6): 30, (2024, 2): 29, (2026, 9): 30}
    assert next(r.holiday for r in found if r.month == 9) == 1


def test_month_windows_are_clipped(spark):
    ranges = spark.createDataFrame([("a", date(2025, 11, 20), date(2026, 1, 5)), ("b", date(2026, 2, 2), date(2026, 2, 1))],
                                   "source string, start date, end date")
    found = calendar.month_windows(ranges).orderBy("window_start").collect()
    assert [(r.reference_period, r.window_start, r.window_end) for r in found] == [
        ("2025-11", date(2025, 11, 20), date(2025, 11, 30)),
        ("2025-12", date(2025, 12, 1), date(2025, 12, 31)),
        ("2026-01", date(2026, 1, 1), date(2026, 1, 5)),
    ]


def test_recheck_windows(spark):
    sources = spark.createDataFrame([("ons", 40)], "source string, recheck_days int")
    found = calendar.recheck_windows(sources, F.lit("2026-03-10").cast("date")).orderBy("window_start").collect()
    assert [r.window_start for r in found] == [date(2026, 1, 29), date(2026, 2, 1), date(2026, 3, 1)]
    assert found[-1].window_end == date(2026, 3, 10)


def test_hours_in_month(spark):
    df = spark.createDataFrame([(date(2024, 2, 10),)], "d date")
    assert df.select(temporal.hours_in_month(F.col("d"))).first()[0] == 29 * 24
