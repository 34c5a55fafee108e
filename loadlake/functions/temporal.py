"""Time-zone and calendar expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_ZONE = "America/Sao_Paulo"


def parse_utc(text: Column) -> Column:
    """ISO text to a UTC wall clock (TIMESTAMP_NTZ); text without an offset is UTC, bad text is null."""
    has_offset = text.rlike(r"(?i)(Z|[+-]\d{2}:?\d{2})$")
    instant = F.when(has_offset, text).otherwise(F.concat(text, F.lit("Z"))).try_cast("timestamp")
    return utc_wall_clock(instant)


def utc_wall_clock(instant: Column) -> Column:
    """TIMESTAMP to its UTC wall clock, whatever the session zone is."""
    return F.convert_timezone(None, F.lit("UTC"), instant.cast("timestamp_ntz"))


def local_from_utc(utc: Column, zone: str = DEFAULT_ZONE) -> Column:
    """UTC wall clock to the wall clock of ``zone``, with that zone's historic offsets."""
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), utc)


def utc_from_local(local: Column, zone: str = DEFAULT_ZONE) -> Column:
    """Wall clock of ``zone`` to UTC; an ambiguous hour takes the earlier instant."""
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), local)


def day_type(weekday: Column, is_holiday: Column) -> Column:
    """Holiday wins over saturday (5) and sunday (6); weekday counts from Monday = 0."""
    return (
        F.when(is_holiday, "holiday")
        .when(weekday == 5, "saturday")
        .when(weekday == 6, "sunday")
        .otherwise("weekday")
    )


def hours_in_month(day: Column) -> Column:
    return F.dayofmonth(F.last_day(day)) * 24


def easter_sunday(year: str) -> Column:
    """Gregorian Easter of the integer column ``year``, by integer arithmetic."""
    golden, century, rest = f"{year} % 19", f"{year} DIV 100", f"{year} % 100"
    correction = f"({century} - ({century} + 8) DIV 25 + 1) DIV 3"
    lunar = f"((19 * ({golden}) + {century} - {century} DIV 4 - {correction} + 15) % 30)"
    shift = f"((32 + 2 * ({century} % 4) + 2 * (({rest}) DIV 4) - {lunar} - ({rest}) % 4) % 7)"
    late = f"(({golden} + 11 * {lunar} + 22 * {shift}) DIV 451)"
    offset = f"CAST({lunar} + {shift} - 7 * {late} + 114 AS INT)"
    return F.expr(f"make_date({year}, CAST({offset} DIV 31 AS INT), {offset} % 31 + 1)")
