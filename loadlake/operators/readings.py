"""From landed readings to hourly load per area and for the whole system."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlake.functions import temporal
from loadlake.operators.calendar import with_day_type, with_local_calendar

HOUR_KEYS = ("date", "year", "month", "day", "hour", "day_type")
PROVENANCE = ("source", "dataset", "geographic_scope", "geographic_precision")
INTERVAL_HOURS = 0.5
# Load columns of the published readings besides the one that becomes ``load_mw``.
LOAD_FIELDS = (
    "val_cargaglobalcons",
    "val_cargaglobalsmmg",
    "val_cargaglobalsmmgd",
    "val_cargammgd",
    "val_cargasupervisionada",
    "val_carganaosupervisionada",
)


def type_fields(raw: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Landed text fields to typed columns, without calendar and provenance; see ``type_readings``. Columns in ``keep``
    stay as they are."""

    def optional(name: str, dtype: str) -> Column:
        return (F.col(name) if name in raw.columns else F.lit(None)).try_cast(dtype).alias(name)

    load = F.col("val_cargaglobal").try_cast("double")
    stamp = F.col("din_referenciautc")
    if isinstance(raw.schema["din_referenciautc"].dataType, T.StringType):
        stamp = temporal.parse_utc(stamp)
    elif isinstance(raw.schema["din_referenciautc"].dataType, T.TimestampType):
        stamp = temporal.utc_wall_clock(stamp)
    return raw.select(
        F.col("cod_areacarga").alias("area"),
        stamp.alias("ts_utc"),
        F.nullif(load, F.lit(0.0)).alias("load_mw"),
        F.coalesce(load == 0, F.lit(False)).alias("is_placeholder"),
        optional("dat_referencia", "string"),
        optional("din_atualizacao", "string"),
        *[optional(name, "double") for name in LOAD_FIELDS],
        optional("val_consistencia", "string"),
        optional("resource_id", "string"),
        optional("retrieved_at", "timestamp"),
        optional("hash_sha256", "string"),
        *keep,
    )


def with_context(
    typed: DataFrame,
    holidays: DataFrame | None = None,
    *,
    source: str = "ons",
    dataset: str = "carga_verificada",
    zone: str = temporal.DEFAULT_ZONE,
) -> DataFrame:
    """Adds calendar and provenance columns to typed readings."""
    dated = with_day_type(with_local_calendar(typed, "ts_utc", zone), holidays)
    return dated.withColumns(
        {
            "source": F.lit(source),
            "dataset": F.lit(dataset),
            "geographic_scope": F.lit("ONS_load_area"),
            "geographic_precision": F.lit("approximate"),
            "observation_type": F.lit("observed"),
        }
    )


def type_readings(raw: DataFrame, holidays: DataFrame | None = None, **context: str) -> DataFrame:
    """Landed text fields to typed 30-minute readings with calendar and provenance columns.

    Needs ``cod_areacarga, din_referenciautc, val_cargaglobal``; the other published columns and
    ``resource_id, retrieved_at, hash_sha256`` are null where absent. Text that does not parse becomes null. A load of
    exactly zero marks an interval the publisher has not consolidated: it becomes null and is flagged in
    ``is_placeholder``. Fields that are typed already (parquet) are taken as they are. Rows without a timestamp stay,
    see ``split_rejects``.
    """
    return with_context(type_fields(raw), holidays, **context)


def split_rejects(silver: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(usable, rejected): readings whose timestamp did not parse cannot be placed in an hour."""
    return silver.where(F.col("ts_utc").isNotNull()), silver.where(F.col("ts_utc").isNull())


def placeholder_counts(silver: DataFrame) -> DataFrame:
    return silver.groupBy("resource_id").agg(F.count_if("is_placeholder").alias("n_placeholders"))


def latest_readings(silver: DataFrame, keys: Sequence[str] = ("area", "ts_utc")) -> DataFrame:
    """One reading per key, the one retrieved last (then the greatest hash), where files overlap.

    An aggregate, not a ranking window: copies of a key are merged before the shuffle, so one interval
    that was delivered over and over does not fill a task.
    """
    rest = [c for c in silver.columns if c not in keys]
    # The trailing fields only settle full ties, so that the result never depends on row order.
    order = F.struct("retrieved_at", "hash_sha256", "resource_id", "load_mw")
    newest = silver.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("__r"))
    return newest.select(*keys, "__r.*").select(*silver.columns)


def hourly_load(readings: DataFrame) -> DataFrame:
    """Mean MW, energy and completeness per area and local hour.

    MW are averaged, never added; energy adds half an hour of each reading and is 0 without readings.
    """
    grouped = readings.groupBy("area", *HOUR_KEYS, *PROVENANCE).agg(
        F.avg("load_mw").alias("load_hourly_mw"),
        F.count("load_mw").alias("n_intervals"),
        F.coalesce(F.sum(F.col("load_mw") * INTERVAL_HOURS), F.lit(0.0)).alias("energy_hourly_mwh"),
    )
    return grouped.withColumns(
        {
            "quality_flag": F.when(F.col("n_intervals") >= 2, "ok").otherwise("incomplete_hour"),
            "observation_type": F.lit("aggregated"),
        }
    )


def system_hourly(hourly: DataFrame, areas: Sequence[str], dataset: str = "carga_verificada_nacional") -> DataFrame:
    """Sum of ``areas`` per hour, only for hours in which each of them has a row.

    One aggregation for any number of areas. A null area load makes the total null, and the hour is ``ok``
    only if every area is. The set of areas seen per hour is no longer than the list given.
    """
    if not areas:
        raise ValueError("at least one area is needed")
    members = hourly.where(F.col("area").isin(list(areas)))
    summed = members.groupBy(*HOUR_KEYS).agg(
        F.size(F.collect_set("area")).alias("__areas"),
        F.when(F.every(F.col("load_hourly_mw").isNotNull()), F.sum("load_hourly_mw")).alias("load_hourly_mw"),
        F.sum("energy_hourly_mwh").alias("energy_hourly_mwh"),
        F.when(F.every(F.col("quality_flag") == "ok"), "ok").otherwise("incomplete_hour").alias("quality_flag"),
    )
    complete = summed.where(F.col("__areas") == len(set(areas))).drop("__areas")
    return complete.withColumns(
        {
            "source": F.lit("ons"),
            "dataset": F.lit(dataset),
            "geographic_scope": F.lit("ONS_load_area"),
            "geographic_precision": F.lit("exact"),
            "observation_type": F.lit("derived"),
        }
    )
