"""Local calendar columns, holidays, day types and month windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlake.functions import temporal

CALENDAR_COLUMNS = ("timestamp_local", "timestamp_utc", "date", "year", "month", "day", "hour", "minute", "weekday")

# Public holidays of Brazil and of Rio de Janeiro state.
# (name, month, day, days after Easter, first year); month and day or the Easter distance is set.
HOLIDAY_RULES: tuple[tuple[str, int | None, int | None, int | None, int], ...] = (
    ("New Year", 1, 1, None, 1900),
    ("Carnival Tuesday", None, None, -47, 2004),
    ("Good Friday", None, None, -2, 1900),
    ("Tiradentes", 4, 21, None, 1933),
    ("Saint George", 4, 23, None, 2008),
    ("Labour Day", 5, 1, None, 1925),
    ("Independence", 9, 7, None, 1900),
    ("Our Lady Aparecida", 10, 12, None, 1980),
    ("All Souls", 11, 2, None, 1900),
    ("Republic", 11, 15, None, 1900),
    ("Black Awareness", 11, 20, None, 2002),
    ("Christmas", 12, 25, None, 1922),
)


def with_local_calendar(
    df: DataFrame, timestamp: str, zone: str = temporal.DEFAULT_ZONE, source_is_utc: bool = True
) -> DataFrame:
    """Add the calendar columns of ``zone``.

    A TIMESTAMP is an instant. A TIMESTAMP_NTZ is a wall clock: UTC when ``source_is_utc``, else of ``zone``.
    Rows with a null timestamp get null calendar columns.
    """
    source = F.col(timestamp)
    if isinstance(df.schema[timestamp].dataType, T.TimestampType):
        utc = temporal.utc_wall_clock(source)
    elif source_is_utc:
        utc = source.cast("timestamp_ntz")
    else:
        utc = temporal.utc_from_local(source.cast("timestamp_ntz"), zone)
    local = F.col("timestamp_local")
    return (
        df.withColumn("timestamp_utc", utc)
        .withColumn("timestamp_local", temporal.local_from_utc(F.col("timestamp_utc"), zone))
        .withColumns(
            {
                "date": F.to_date(local),
                "year": F.year(local),
                "month": F.month(local),
                "day": F.dayofmonth(local),
                "hour": F.hour(local),
                "minute": F.minute(local),
                "weekday": F.weekday(local),
            }
        )
    )


def is_holiday(date: Column, easter: Column, rules: Sequence[tuple] = HOLIDAY_RULES) -> Column:
    """Whether the rules name the date, in any year, given its year's Easter Sunday."""
    hit = F.lit(False)
    for _, month, day, after_easter, first_year in rules:
        if after_easter is None:
            same = (F.month(date) == month) & (F.dayofmonth(date) == day)
        else:
            same = date == F.date_add(easter, after_easter)
        hit = hit | (same & (F.year(date) >= first_year))
    return F.coalesce(hit, F.lit(False))


def with_day_type(df: DataFrame, holidays: DataFrame | None = None, date: str = "date") -> DataFrame:
    """Add ``day_type``. Holidays follow the rules, for any year, or are the ``date`` column of a table.

    A table is broadcast as distinct dates: at most 366 per calendar year covered, whatever the readings' size.
    """
    if holidays is None:
        dated = df.withColumn("__year", F.year(date)).withColumn("__easter", temporal.easter_sunday("__year"))
        kind = temporal.day_type(F.weekday(F.col(date)), is_holiday(F.col(date), F.col("__easter")))
        return dated.withColumn("day_type", F.when(F.col(date).isNotNull(), kind)).drop("__year", "__easter")
    dates = holidays.where(F.col("date").isNotNull()).select(F.col("date").alias("__holiday")).distinct()
    joined = df.join(F.broadcast(dates), F.col(date) == F.col("__holiday"), "left")
    kind = temporal.day_type(F.weekday(F.col(date)), F.col("__holiday").isNotNull())
    return joined.withColumn("day_type", F.when(F.col(date).isNotNull(), kind)).drop("__holiday")


def holiday_calendar(years: DataFrame, rules: Sequence[tuple] = HOLIDAY_RULES) -> DataFrame:
    """``(year, date, holiday)`` for every distinct ``year`` of the input."""

    def listed(rule: tuple) -> str:
        name, month, day, after_easter, first_year = rule
        fields = ((month, "m"), (day, "d"), (after_easter, "after"), (first_year, "since"))
        numbers = ", ".join(f"CAST({'NULL' if n is None else n} AS INT) AS {alias}" for n, alias in fields)
        return f"struct('{name}' AS holiday, {numbers})"

    spine = years.select(F.col("year").cast("int").alias("year")).where(F.col("year").isNotNull()).distinct()
    dated = spine.select(
        "year",
        temporal.easter_sunday("year").alias("__easter"),
        F.expr(f"explode(array({', '.join(listed(r) for r in rules)}))").alias("__rule"),
    )
    moving = F.date_add(F.col("__easter"), F.col("__rule.after"))
    fixed = F.make_date(F.col("year"), F.col("__rule.m"), F.col("__rule.d"))
    return (
        dated.where(F.col("year") >= F.col("__rule.since"))
        .select("year", F.coalesce(moving, fixed).alias("date"), F.col("__rule.holiday").alias("holiday"))
    )


def holidays_between(spark: SparkSession, first_year: int, last_year: int) -> DataFrame:
    """The calendar of a span of years, made from the rules alone: about a dozen rows per year."""
    return holiday_calendar(spark.range(first_year, last_year + 1, 1, 1).select(F.col("id").alias("year")))


def day_type_counts(months: DataFrame, holidays: DataFrame | None = None) -> DataFrame:
    """Days of each type per ``(year, month)``; the four columns sum to the days of the month."""
    first = F.make_date(F.col("year"), F.col("month"), F.lit(1))
    days = (
        months.select("year", "month").distinct()
        .withColumn("date", F.explode(F.sequence(first, F.last_day(first))))
    )
    typed = with_day_type(days, holidays)
    return typed.groupBy("year", "month").agg(
        *[
            F.count_if(F.col("day_type") == kind).alias(kind)
            for kind in ("weekday", "saturday", "sunday", "holiday")
        ]
    )


def month_windows(ranges: DataFrame, start: str = "start", end: str = "end") -> DataFrame:
    """One row per calendar month touched by ``[start, end]``, clipped to it; other columns are kept."""
    others = [c for c in ranges.columns if c not in (start, end)]
    valid = ranges.where(F.col(start) <= F.col(end))
    month = F.explode(
        F.sequence(F.trunc(F.col(start), "MM"), F.trunc(F.col(end), "MM"), F.expr("INTERVAL 1 MONTH"))
    )
    return valid.select(*others, start, end, month.alias("__month")).select(
        *others,
        F.date_format("__month", "yyyy-MM").alias("reference_period"),
        F.greatest(F.col("__month"), F.col(start)).alias("window_start"),
        F.least(F.last_day("__month"), F.col(end)).alias("window_end"),
    )


def recheck_windows(sources: DataFrame, as_of: Column, days: str = "recheck_days") -> DataFrame:
    """Month windows to read again: from ``as_of`` minus each source's ``recheck_days`` up to ``as_of``."""
    ranges = sources.withColumns({"start": F.date_sub(as_of, F.col(days)), "end": as_of})
    return month_windows(ranges)
