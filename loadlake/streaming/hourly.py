"""Hourly load of a stream of readings."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlake.functions import temporal
from loadlake.operators.calendar import with_day_type, with_local_calendar
from loadlake.operators.readings import INTERVAL_HOURS


def hourly_stream(
    readings: DataFrame,
    holidays: DataFrame | None = None,
    *,
    timestamp: str = "ts",
    delay: str = "6 hours",
    zone: str = temporal.DEFAULT_ZONE,
) -> DataFrame:
    """Running hourly load per area and UTC hour, for output mode ``update``.

    ``readings`` has ``area``, a TIMESTAMP column, ``load_mw`` (null for a placeholder) and ``retrieved_at``. Each
    half hour keeps its last retrieved reading (the larger load on a tie), so a correction replaces the value instead of
    adding to it. The batch operator groups by local hour: where the clock goes back, it has one row of four readings
    for what are two rows here. An
    hour is ``incomplete_hour`` until its second half hour has arrived. State is dropped ``delay`` after the hour.
    """
    second = F.minute(timestamp) >= 30
    halves = (
        readings.withWatermark(timestamp, delay)
        .groupBy("area", F.window(timestamp, "1 hour").alias("__w"))
        .agg(
            F.max_by("load_mw", F.when(~second, F.struct("retrieved_at", "load_mw"))).alias("__a"),
            F.max_by("load_mw", F.when(second, F.struct("retrieved_at", "load_mw"))).alias("__b"),
        )
    )
    a, b = F.col("__a"), F.col("__b")
    total = F.coalesce(a, F.lit(0.0)) + F.coalesce(b, F.lit(0.0))
    count = a.isNotNull().cast("long") + b.isNotNull().cast("long")
    hourly = halves.select(
        "area",
        F.col("__w.start").alias("hour_start_utc"),
        F.when(count > 0, total / count).alias("load_hourly_mw"),
        count.alias("n_intervals"),
        (total * INTERVAL_HOURS).alias("energy_hourly_mwh"),
        F.when(count >= 2, "ok").otherwise("incomplete_hour").alias("quality_flag"),
    )
    dated = with_day_type(with_local_calendar(hourly, "hour_start_utc", zone), holidays)
    return dated.drop("timestamp_utc", "timestamp_local", "minute", "weekday")
