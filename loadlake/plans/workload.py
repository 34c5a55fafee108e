"""The operators applied to the sample tables, one function per registered query.

The sample tables stand in for the lake: events are readings of areas (their type), line items are class-curve
observations, orders are monthly energy and resource names, documents are file versions, parts are published
resources, pages are publication pages. Every query reads its tables whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlake.functions.numeric import ratio
from loadlake.functions.parsing import clock_hour, decimal_comma
from loadlake.operators import (
    calendar,
    calibration,
    catalog,
    curves,
    gate,
    ledger,
    metrics,
    overlay,
    profiles,
    quality,
    quantiles,
    readings,
    reports,
    scenarios,
)
from loadlake.plans import jobs
from loadlake.session import configure, work_folder
from loadlake.sources import delimited, landed, tables
from loadlake.streaming import keyed
from loadlake.streaming.hourly import hourly_stream

AREAS = ("click", "error", "purchase", "signup", "view")
AS_OF = "2024-06-01 00:00:00"
RECHECK_AS_OF = "2001-08-01"
YEARS = (1994, 2001)
ANCHOR_YEARS = (1995, 1998, 2000)
ALTERNATIVE_YEAR = 1999
KWH_PER_UNIT = 2000.0
LAGS = {"en": 3, "fr": 45, "de": 400}
LINK_ENDINGS = ("en", "e")
CURRENT_LINK_ENDINGS = ("ion", "er")
FALLBACK_URL = "https://example.org/files/current.xlsx"
EXPECTED_PROPS = ("k", "unit")
LANDED_FOLDERS = 256
PRICE_LEVEL = 1000.0

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to fixed decimals, since sums of doubles depend on their order.

    Means of two-decimal values often lie halfway between two results; a shift far below the last digit sends
    all of these the same way.
    """
    shift = 10.0 ** -(digits + 2)
    doubles = [f.name for f in df.schema if isinstance(f.dataType, T.DoubleType)]
    return df.withColumns({c: F.round(F.col(c) + shift, digits) for c in doubles}) if doubles else df


# Readings -----------------------------------------------------------------------------------------------------


def _k(column: str = "props") -> Column:
    return F.get_json_object(F.col(column), "$.k").cast("int")


def raw_events(spark: SparkSession, folder: str) -> DataFrame:
    """Every event as a landed text record: two timestamp forms, some broken fields, some placeholders.

    The load columns besides the main one hold ``k`` and the user's number, one of them as text that is no number.
    """
    k = F.col("__k")
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")
    return table(spark, folder, "events").withColumn("__k", _k()).select(
        "event_id",
        F.col("event_type").alias("cod_areacarga"),
        F.when(k == 99, "soon").when(k < 50, F.concat(text, F.lit("Z"))).otherwise(text).alias("din_referenciautc"),
        F.when(k == 98, "n/d").when(k == 0, "0").otherwise(F.col("value").cast("string")).alias("val_cargaglobal"),
        F.date_format("ts", "yyyy-MM-dd").alias("dat_referencia"),
        text.alias("din_atualizacao"),
        k.cast("string").alias("val_cargammgd"),
        F.when(k < 90, F.col("user_id").cast("string")).otherwise("n/d").alias("val_cargasupervisionada"),
        F.concat(F.lit("user-"), F.col("user_id").cast("string")).alias("resource_id"),
        F.col("ts").alias("retrieved_at"),
    )


def slots(spark: SparkSession, folder: str) -> DataFrame:
    """Half-hour readings per area: the mean of the slot's events, or a placeholder 0 if any has ``k`` = 0."""
    return _slots(table(spark, folder, "events"))


def _slots(events: DataFrame) -> DataFrame:
    slot = F.timestamp_seconds(F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 1800) * 1800)
    return (
        events.groupBy(F.col("event_type").alias("cod_areacarga"), slot.cast("timestamp_ntz").alias("din_referenciautc"))
        .agg(F.when(F.bool_or(_k() == 0), F.lit(0.0)).otherwise(F.avg("value")).alias("val_cargaglobal"))
    )


def hourly(spark: SparkSession, folder: str) -> DataFrame:
    return readings.hourly_load(readings.type_readings(slots(spark, folder)))


def silver_readings(spark: SparkSession, folder: str) -> DataFrame:
    raw = raw_events(spark, folder)
    silver = readings.type_readings(raw)
    usable, _ = readings.split_rejects(silver)
    return rounded(
        usable.select(
            "area", "ts_utc", "timestamp_local", "load_mw", "is_placeholder", "resource_id", "date", "year",
            "month", "day", "hour", "minute", "weekday", "day_type", "source", "dataset", "geographic_scope",
            "geographic_precision", "observation_type", "dat_referencia", "din_atualizacao", "val_cargaglobalsmmg",
            "val_cargammgd", "val_cargasupervisionada",
        )
    )


def rejected_readings(spark: SparkSession, folder: str) -> DataFrame:
    silver = readings.type_readings(raw_events(spark, folder))
    _, rejected = readings.split_rejects(silver)
    return rejected.groupBy("area").agg(F.count(F.lit(1)).alias("n_rejected"))


def placeholder_counts(spark: SparkSession, folder: str) -> DataFrame:
    silver = readings.type_readings(raw_events(spark, folder))
    return readings.placeholder_counts(silver)


def latest_readings(spark: SparkSession, folder: str) -> DataFrame:
    """Events of one area and half hour are deliveries of one reading; the last one counts."""
    slot = F.timestamp_seconds(F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 1800) * 1800)
    delivered = table(spark, folder, "events").select(
        F.col("event_type").alias("area"),
        slot.cast("timestamp_ntz").alias("ts_utc"),
        F.col("value").alias("load_mw"),
        F.col("ts").alias("retrieved_at"),
        F.sha2(F.col("event_id").cast("string"), 256).alias("hash_sha256"),
        F.col("event_id").cast("string").alias("resource_id"),
    )
    return rounded(readings.latest_readings(delivered).select("area", "ts_utc", "load_mw", "resource_id"))


def hourly_load(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(hourly(spark, folder))


def incremental_months(spark: SparkSession, folder: str) -> DataFrame:
    """Hourly load read back from a table by month: built whole without the odd events of the newest thirty days, then
    with them, which builds anew the months they touch and leaves the others."""
    events = table(spark, folder, "events")
    newest = events.agg(F.max("ts").alias("newest"))
    late = (F.col("event_id") % 2 == 1) & (F.col("ts") > F.col("newest") - F.expr("INTERVAL 30 DAYS"))
    marked = events.join(F.broadcast(newest), F.lit(True), "left").withColumn("late", F.coalesce(late, F.lit(False)))
    path = work_folder(spark, "hourly")

    def typed(rows: DataFrame) -> DataFrame:
        return readings.type_readings(_slots(rows))

    tables.overwrite_partitions(readings.hourly_load(typed(marked.where("NOT late"))), path, whole=True)
    jobs.refresh_months(typed(marked), typed(marked.where("late")), readings.hourly_load, path)
    return rounded(spark.read.parquet(path).select(*hourly(spark, folder).columns))


def hourly_stream_result(spark: SparkSession, folder: str) -> DataFrame:
    """The events as a stream of files, one batch after another into a table by batch; the newest row of each hour.

    All rows of a batch are in time for that batch: the watermark moves between batches only.
    """
    path = f"{folder}/events.parquet"
    schema = spark.read.parquet(path).schema
    raw = spark.readStream.schema(schema).parquet(f"{path}*")
    stamped = raw.select(
        F.col("event_type").alias("area"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.when(_k() != 0, F.col("value")).alias("load_mw"),
        F.col("ts").cast("timestamp").alias("retrieved_at"),
    )
    home = work_folder(spark, "hours")
    hours = hourly_stream(stamped, delay="3650 days")
    query = (
        hours.writeStream.outputMode("update").foreachBatch(keyed.batches_into(f"{home}/table"))
        .option("checkpointLocation", f"{home}/state").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    done = keyed.folded(keyed.batches(spark, f"{home}/table", hours.schema), ["area", "hour_start_utc"])
    return rounded(
        done.select(
            "area", F.col("hour_start_utc").cast("timestamp_ntz").alias("hour_start_utc"), "date", "hour", "load_hourly_mw",
            "n_intervals", "energy_hourly_mwh", "quality_flag",
        )
    )


def ledger_stream_result(spark: SparkSession, folder: str) -> DataFrame:
    """The documents as a stream of landed files, their versions stored under their batch; a batch that runs again, and
    one that ended half-way before, change nothing."""
    path = f"{folder}/documents.parquet"
    schema = spark.read.parquet(path).schema
    landed_rows = _as_landed(spark.readStream.schema(schema).parquet(f"{path}*"))
    home = work_folder(spark, "ledger")
    register = keyed.versions_into(f"{home}/ledger")

    def twice(rows: DataFrame, batch_id: int) -> None:
        keyed.batches_into(f"{home}/ledger")(ledger.as_ledger(rows.limit(10)), batch_id)  # what an ended run left
        register(rows, batch_id)
        register(rows, batch_id)

    query = (
        landed_rows.writeStream.foreachBatch(twice)
        .option("checkpointLocation", f"{home}/state").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    stored = keyed.batches(spark, f"{home}/ledger", ledger.LEDGER_SCHEMA)
    return stored.select("source", "resource_id", "reference_period", "hash_sha256", "local_path", "file_size")


def system_hourly(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(readings.system_hourly(hourly(spark, folder), AREAS))


def profile_24h(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profiles.profile_24h(hourly(spark, folder)))


def profile_by_day_type(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profiles.profile_by_day_type(hourly(spark, folder)))


def profile_by_month(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profiles.profile_by_month(hourly(spark, folder)))


def profile_all_grains(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profiles.all_profiles(hourly(spark, folder)).withColumn("month", F.coalesce("month", F.lit(0))))


def system_profile(spark: SparkSession, folder: str) -> DataFrame:
    total = readings.system_hourly(hourly(spark, folder), AREAS)
    return rounded(profiles.profile_24h(total, ("dataset",)))


# Calendar -----------------------------------------------------------------------------------------------------


def _order_clock(spark: SparkSession, folder: str) -> DataFrame:
    """Every order with a time of day taken from its key, through years with daylight saving."""
    minutes = (F.col("o_orderkey") % 48) * 30
    return table(spark, folder, "orders").select(
        "o_orderkey",
        F.timestamp_seconds(F.unix_seconds(F.col("o_orderdate").cast("timestamp")) + minutes * 60)
        .cast("timestamp_ntz")
        .alias("ts"),
    )


def _calendar_of_orders(spark: SparkSession, folder: str, source_is_utc: bool) -> DataFrame:
    clock = _order_clock(spark, folder)
    dated = calendar.with_local_calendar(clock, "ts", source_is_utc=source_is_utc)
    return calendar.with_day_type(dated).drop("ts")


def local_calendar(spark: SparkSession, folder: str) -> DataFrame:
    return _calendar_of_orders(spark, folder, True)


def local_source_calendar(spark: SparkSession, folder: str) -> DataFrame:
    return _calendar_of_orders(spark, folder, False)


def holiday_calendar(spark: SparkSession, folder: str) -> DataFrame:
    return calendar.holiday_calendar(table(spark, folder, "orders").select(F.year("o_orderdate").alias("year")))


def day_type_counts(spark: SparkSession, folder: str) -> DataFrame:
    orders = table(spark, folder, "orders")
    months = orders.select(F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month"))
    return calendar.day_type_counts(months)


def month_windows(spark: SparkSession, folder: str) -> DataFrame:
    ranges = table(spark, folder, "orders").groupBy("o_orderpriority", "o_orderstatus").agg(
        F.to_date(F.min("o_orderdate")).alias("start"), F.to_date(F.max("o_orderdate")).alias("end")
    )
    return calendar.month_windows(ranges)


def recheck_windows(spark: SparkSession, folder: str) -> DataFrame:
    sources = table(spark, folder, "orders").select(F.col("o_orderpriority").alias("source")).distinct()
    sources = sources.withColumn("recheck_days", F.substring("source", 1, 1).cast("int") * 30)
    return calendar.recheck_windows(sources, F.lit(RECHECK_AS_OF).cast("date"))


# Class curves -------------------------------------------------------------------------------------------------


def _class_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Line items in the published class-curve columns: clock text and decimal commas included."""
    hour = F.lpad((F.col("l_orderkey") % 24).cast("string"), 2, "0")
    return table(spark, folder, "lineitem").select(
        F.col("l_returnflag").alias("SigCcs"),
        F.concat(F.lit("class "), F.col("l_linenumber").cast("string")).alias("DscDemandante"),
        F.col("l_linestatus").alias("NomSubGrupoTarifario"),
        F.when(F.weekday("l_shipdate") == 5, "saturday")
        .when(F.weekday("l_shipdate") == 6, "sunday")
        .otherwise("weekday")
        .alias("DscTipoDia"),
        F.concat(hour, F.lit(":00")).alias("HorInicial"),
        F.concat(hour, F.lit(":59:59")).alias("HorFinal"),
        F.col("l_extendedprice").alias("VlrDmd"),
    )


def decimal_comma_prices(spark: SparkSession, folder: str) -> DataFrame:
    text = F.regexp_replace(F.format_string("%.2f", F.col("o_totalprice")), r"\.", ",")
    broken = F.when(F.col("o_orderstatus") == "P", F.concat(text, F.lit(",5"))).otherwise(text)
    orders = table(spark, folder, "orders").withColumn("text", broken)
    return rounded(
        orders.groupBy("o_orderstatus").agg(
            F.count(decimal_comma(F.col("text"))).alias("n_numbers"),
            F.count_if(decimal_comma(F.col("text")).isNull()).alias("n_broken"),
            F.max(decimal_comma(F.col("text"))).alias("greatest"),
            F.avg(decimal_comma(F.col("text"))).alias("mean_value"),
        )
    )


def clock_hours(spark: SparkSession, folder: str) -> DataFrame:
    rows = _class_rows(spark, folder)
    return rows.groupBy(clock_hour(F.col("HorFinal")).alias("hour")).agg(F.count(F.lit(1)).alias("n"))


def category_values(spark: SparkSession, folder: str) -> DataFrame:
    return curves.category_values(_class_rows(spark, folder))


def curve_stats(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(curves.class_curve_stats(_class_rows(spark, folder)))


def normalized_curve(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(curves.normalize_class_curves(curves.class_curve_stats(_class_rows(spark, folder))))


def class_report(spark: SparkSession, folder: str) -> DataFrame:
    stats = curves.normalize_class_curves(curves.class_curve_stats(_class_rows(spark, folder)))
    return rounded(curves.class_report(stats, "class 3"))


def price_quantiles(spark: SparkSession, folder: str) -> DataFrame:
    """Exact order statistics of three big groups, each treated as too large for one sort."""
    items = table(spark, folder, "lineitem")
    wanted = {"p05": 0.05, "p95": 0.95}
    return rounded(
        quantiles.exact_quantiles(items, ["l_returnflag"], "l_extendedprice", wanted, "median")
    )


def labelled_monthly_power(spark: SparkSession, folder: str) -> DataFrame:
    """Monthly energy of the rows whose segment is spelled in one of two ways, as average power."""
    orders = table(spark, folder, "orders").join(
        curves.rows_with_label(table(spark, folder, "customer"), "c_mktsegment", ("household", " Machinery ")),
        F.col("o_custkey") == F.col("c_custkey"),
    )
    monthly = orders.groupBy(
        F.col("c_mktsegment").alias("segment"), F.to_date(F.date_trunc("month", "o_orderdate")).alias("month_start")
    ).agg(F.sum("o_totalprice").alias("energy_mwh"))
    return rounded(calibration.average_monthly_power(monthly), 3)


# Profile analytics --------------------------------------------------------------------------------------------


def load_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.load_metrics(profiles.profile_24h(hourly(spark, folder))))


def flexibility_candidates(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(metrics.flexibility_candidates(profiles.profile_24h(hourly(spark, folder))))


def _calibrated(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events")
    hours = hourly(spark, folder)
    shapes = profiles.with_normalized_load(profiles.profile_by_day_type(hours), ("area", "day_type"))
    energy = hours.groupBy("area", "year", "month").agg(F.sum("energy_hourly_mwh").alias("energy_mwh"))
    local = calendar.with_local_calendar(events.select("ts"), "ts")
    counts = calendar.day_type_counts(local)
    return calibration.calibrate(
        shapes.select("area", "day_type", "hour", "normalized_load"), calibration.day_counts_long(counts), energy
    )


def calibrated_curve(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_calibrated(spark, folder))


def calibration_summary(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(calibration.calibration_summary(_calibrated(spark, folder)))


def source_comparison(spark: SparkSession, folder: str) -> DataFrame:
    """Observed metrics per area against those of the calibrated curves, all days of all months weighted alike."""

    def described(df: DataFrame, source: str, scope: str) -> DataFrame:
        long = metrics.metrics_long(metrics.load_metrics(df), ("area",))
        return long.withColumns({"source": F.lit(source), "geographic_scope": F.lit(scope)})

    observed = profiles.profile_24h(hourly(spark, folder))
    days = F.when(F.col("estimated_load_mw").isNotNull(), F.col("n_days_in_month"))
    mean = ratio(F.sum(F.col("estimated_load_mw") * days), F.sum(days))
    estimated = _calibrated(spark, folder).groupBy("area", "hour").agg(mean.alias("avg_mw"))
    return rounded(
        metrics.compare_sources(
            described(observed, "observed", "ONS_load_area"), described(estimated, "calibrated", "RJ_state"),
            ("area", "metric"),
        ),
        4,
    )


# Quality ------------------------------------------------------------------------------------------------------


def quality_report(spark: SparkSession, folder: str) -> DataFrame:
    """Orders, with their month as the resource and a price level that some rows fall below."""
    orders = table(spark, folder, "orders").select(
        F.date_format("o_orderdate", "yyyy-MM").alias("resource"),
        "o_custkey",
        F.to_date("o_orderdate").alias("date"),
        (F.col("o_orderkey") % 24).cast("int").alias("hour"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"),
        (F.col("o_totalprice") - PRICE_LEVEL * 10).alias("margin"),
    )
    checks = quality.table_checks(
        orders,
        ["resource"],
        min_rows=150,
        key=["o_custkey"],
        required=["status", "o_custkey"],
        value="margin",
        date="date",
        hour="hour",
        expected_end=F.lit("2001-08-01").cast("date"),
    )
    return checks.withColumn("rows_affected", F.coalesce("rows_affected", F.lit(-1)))


def schema_checks(spark: SparkSession, folder: str) -> DataFrame:
    fields = table(spark, folder, "events").select(
        "event_type", F.explode(F.json_object_keys("props")).alias("column_name")
    )
    return quality.schema_checks(fields, ["event_type"], EXPECTED_PROPS).drop("rows_affected")


def coverage_regression(spark: SparkSession, folder: str) -> DataFrame:
    versions = (
        table(spark, folder, "orders")
        .groupBy("o_orderpriority", "o_custkey")
        .agg(F.to_date(F.max("o_orderdate")).alias("max_date"))
    )
    return quality.coverage_regression(
        versions, ["o_orderpriority"], ["o_custkey"], F.floor(F.col("o_custkey") / 256)
    ).drop("rows_affected")


def row_count_anomaly(spark: SparkSession, folder: str) -> DataFrame:
    versions = (
        table(spark, folder, "lineitem")
        .groupBy("l_returnflag", "l_linestatus", F.date_format("l_shipdate", "yyyy-MM").alias("version"))
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    judged = quality.row_count_anomaly(versions, ["l_returnflag", "l_linestatus"], ["version"])
    return rounded(judged.drop("rows_affected"))


def energy_power_consistency(spark: SparkSession, folder: str) -> DataFrame:
    return quality.energy_power_consistency(hourly(spark, folder), ["area"])


def allowed_values(spark: SparkSession, folder: str) -> DataFrame:
    return quality.allowed_values(table(spark, folder, "orders"), ["o_orderpriority"], "o_orderstatus", ("F", "O"))


# Versions -----------------------------------------------------------------------------------------------------


def _doc_path() -> Column:
    return F.concat(F.lit("raw/"), F.lpad(F.col("doc_id").cast("string"), 12, "0"))


def _landed(spark: SparkSession, folder: str) -> DataFrame:
    """Every document as a landed file: source is its language, resource its source, content its text."""
    return _as_landed(table(spark, folder, "documents"))


def _as_landed(documents: DataFrame) -> DataFrame:
    retrieved = F.timestamp_seconds(F.lit(1704067200) + F.col("doc_id") * 900)
    return documents.select(
        F.col("lang").alias("source"),
        F.lit("documents").alias("dataset"),
        F.col("source").alias("resource_id"),
        F.when(F.col("lang") != "en", F.date_format(retrieved, "yyyy-MM")).alias("reference_period"),
        retrieved.alias("retrieved_at"),
        F.sha2("text", 256).alias("hash_sha256"),
        F.octet_length("text").cast("bigint").alias("file_size"),
        _doc_path().alias("local_path"),
    )


def _ledger(spark: SparkSession, folder: str) -> DataFrame:
    return ledger.with_latest_flag(ledger.as_ledger(ledger.first_arrivals(_landed(spark, folder))))


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    """Whole texts as records: one row per line of every document, under the version's key.

    The hash is taken before the lines are spread, so a text is hashed once and not once per line.
    """
    hashed = table(spark, folder, "documents").select(
        F.col("lang").alias("source"),
        F.col("source").alias("resource_id"),
        F.sha2("text", 256).alias("hash_sha256"),
        _doc_path().alias("local_path"),
        F.split("text", "\n", -1).alias("__lines"),
    )
    keys = ("source", "resource_id", "hash_sha256", "local_path")
    return hashed.select(*keys, F.posexplode("__lines").alias("line_no", "line"))


def file_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    files = table(spark, folder, "documents").select(F.col("doc_id").alias("file_path"), F.col("text").cast("binary").alias("content"))
    return landed.fingerprints_of(files).withColumnRenamed("file_path", "doc_id")


LANDED_CURVE_FIELDS = ("SigCcs", "DscDemandante", "NomSubGrupoTarifario", "DscTipoDia", "HorInicial", "VlrDmd")


def content_marks(spark: SparkSession, folder: str) -> DataFrame:
    """Order-free fingerprints of the documents of every source and language, as rows of one large version each."""
    rows = table(spark, folder, "documents").select("source", "lang", F.split("text", "\n").alias("lines"))
    return landed.content_mark(rows.select("source", "lang", F.explode("lines").alias("value")), ["source", "lang"])


def observed_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows, placeholders and rejects of the readings, observed while they are written."""
    silver = readings.type_readings(raw_events(spark, folder))
    counts = {"n_rows": F.count(F.lit(1)), "n_placeholders": F.count_if("is_placeholder"), "n_rejected": F.count_if(F.col("ts_utc").isNull())}
    seen = tables.write_observed(silver, work_folder(spark, "silver"), counts)
    return spark.range(1).select(*[F.lit(seen[name]).cast("long").alias(name) for name in counts])


def ordered_range(spark: SparkSession, folder: str) -> DataFrame:
    """Orders written in order of their date, and the middle third of their time read back by month from the files that
    reach into it; whether the files' ranges follow one another."""
    orders = table(spark, folder, "orders").withColumn("second", F.unix_seconds(F.col("o_orderdate").cast("timestamp")))
    path = work_folder(spark, "orders")
    tables.write_ordered(orders.select("o_orderkey", "second", "o_orderdate", "o_totalprice"), path, "second")
    bounds = spark.read.parquet(f"{path}_bounds")
    ends = bounds.agg(F.min("low").alias("low"), F.max("high").alias("high")).first()
    low, high = (2 * ends.low + ends.high) // 3, (ends.low + 2 * ends.high) // 3
    before = F.max("high").over(Window.orderBy("low", "high").rowsBetween(Window.unboundedPreceding, -1))  # a row per file
    order = bounds.select((F.coalesce(before, F.col("low")) <= F.col("low")).alias("fine")).agg(F.every("fine").alias("in_order"))
    months = tables.read_between(spark, path, "second", low, high).groupBy(F.date_format("o_orderdate", "yyyy-MM").alias("month"))
    months = months.agg(F.count(F.lit(1)).alias("n_orders"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"))
    return months.join(F.broadcast(order), F.lit(True), "left")


def ledger_scan(spark: SparkSession, folder: str) -> DataFrame:
    """Events staged as files, three versions of each resource; readings of the newest versions, whose files alone are
    opened, as the ledger names them."""
    record = F.struct(
        F.col("event_type").alias("cod_areacarga"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("din_referenciautc"),
        F.col("value").cast("string").alias("val_cargaglobal"),
    )
    home = work_folder(spark, "lake")
    resource, version = F.floor(F.col("event_id") / 150).cast("string"), (F.col("event_id") % 3).cast("string")
    named = table(spark, folder, "events").where(F.col("event_id").isNotNull()).groupBy(F.concat_ws("-", resource, version).alias("name"))
    files = named.agg(F.to_json(F.array_sort(F.collect_list(record))).alias("text"))  # at most 50 events
    place = F.concat_ws("/", F.lit("raw"), F.pmod(F.xxhash64("name"), F.lit(LANDED_FOLDERS)).cast("string"), F.concat("name", F.lit(".json")))
    tables.write_files(files.select(place.alias("path"), "text"), home)
    listed = landed.listed_files(spark, f"{home}/raw/*")
    path = jobs.lake_path(F.col("file_path"), home)
    part = [F.regexp_extract(path, r"(-?[0-9]+)-(-?[0-9]+)\.json$", i) for i in (1, 2)]
    stored = listed.select(path.alias("local_path"), part[0].alias("resource_id"), part[1].cast("int").alias("v"), "file_size")
    arrived = stored.withColumns(
        {"source": F.lit("ons"), "dataset": F.lit("carga"), "hash_sha256": F.sha2("local_path", 256), "retrieved_at": F.timestamp_seconds(F.col("v") * 86400)}
    )
    ledger_path = tables.layer_path(home, "metadata", "ledger")
    tables.append(ledger.as_ledger(arrived.drop("v")), ledger_path)  # the folders are listed once
    versions = ledger.with_latest_flag(tables.read_or_empty(spark, ledger_path, ledger.LEDGER_SCHEMA)).where("is_latest_downloaded")
    rows = jobs.typed_rows(spark, home, versions)
    return rounded(rows.select("resource_id", "area", "ts_utc", "load_mw"))


def landed_class_curves(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as delimited files, one per supplier: in three separators and one that is none, two encodings, and the
    columns in six orders; counts and sums of what is read back, and the files that are rejected."""
    items = table(spark, folder, "lineitem")
    price = F.replace(F.col("l_extendedprice").cast("decimal(14,2)").cast("string"), F.lit("."), F.lit(","))
    texts = {
        "SigCcs": F.concat(F.lit("Light "), "l_returnflag"),
        "DscDemandante": F.concat(F.lit("Público "), "l_linestatus"),
        "NomSubGrupoTarifario": F.concat(F.lit("B"), F.col("l_linenumber").cast("string")),
        "DscTipoDia": F.when(F.col("l_linenumber") == 1, '"dia; útil, ""x""\t"').otherwise("sábado"),
        "HorInicial": F.concat(F.lpad((F.col("l_linenumber") * 3).cast("string"), 2, "0"), F.lit(":00")),
        "VlrDmd": F.concat(F.lit('"'), price, F.lit('"')),
    }
    key, n = F.col("l_suppkey"), len(texts)
    separator = F.element_at(F.array(*map(F.lit, (";", ",", "\t", "|"))), (key % 4 + 1).cast("int"))

    def line(cells: list[Column]) -> Column:
        turned = F.concat(F.slice(F.array(*cells), (key % n + 1).cast("int"), F.lit(n)), F.slice(F.array(*cells), F.lit(1), (key % n).cast("int")))
        text = F.array_join(turned, "\x01")
        text = F.replace(text, F.lit("\x01"), separator)
        return F.when(key % 3 == 0, F.encode(text, "ISO-8859-1").cast("string")).otherwise(text)

    path = F.concat(F.lit("raw/"), key.cast("string")).alias("file_path")
    heads = items.select("l_suppkey").distinct().select(path, F.lit(-1).cast("long").alias("line_no"), line([F.lit(f) for f in texts]).alias("value"))
    rows = items.select(path, (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("line_no"), line(list(texts.values())).alias("value"))
    parsed = curves.type_class_curves(delimited.parse(heads.unionByName(rows), LANDED_CURVE_FIELDS).withColumn("HorFinal", F.lit(None)))
    keys = ["file_path", "problem", "SigCcs", "DscDemandante", "DscTipoDia", clock_hour(F.col("HorInicial")).alias("hour")]
    total = F.sum(F.col("VlrDmd").cast("decimal(18,2)")).cast("double").alias("total")
    return parsed.groupBy(*keys).agg(F.count("SigCcs").alias("n_rows"), total)


def landed_readings(spark: SparkSession, folder: str) -> DataFrame:
    """Events as landed files of 50 records at most: lists, envelopes of two kinds, and every seventh cut off."""
    k = _k()
    record = F.struct(
        F.col("event_type").alias("cod_areacarga"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("din_referenciautc"),
        F.when(k == 98, F.lit("n/d")).otherwise(F.col("value").cast("string")).alias("val_cargaglobal"),
        F.when(k < 50, k).alias("val_cargammgd"),
        F.lit("x").alias("another_field"),
    )
    file = F.floor(F.col("event_id") / 50)
    files = table(spark, folder, "events").groupBy(file.alias("f")).agg(F.to_json(F.collect_list(record)).alias("list"))
    whole = (
        F.when(F.col("f") % 3 == 0, F.col("list"))
        .when(F.col("f") % 3 == 1, F.format_string('{"data": %s, "n": 1}', "list"))
        .otherwise(F.format_string('{"message": null, "result": %s}', "list"))
    )
    text = F.when(F.col("f") % 7 == 0, F.substring(whole, F.lit(1), F.length(whole) - 9)).otherwise(whole)
    rows = landed.parse_readings(files.select(F.concat(F.lit("raw/"), F.col("f")).alias("file_path"), text.alias("text")))
    return rounded(
        rows.select(
            "file_path", "problem", "cod_areacarga", "din_referenciautc", F.col("val_cargaglobal").try_cast("double").alias("load"),
            F.col("val_cargammgd").try_cast("double").alias("val_cargammgd"), "val_consistencia",
        )
    )


def ledger_versions(spark: SparkSession, folder: str) -> DataFrame:
    return _ledger(spark, folder).select(
        "source", "resource_id", "reference_period", "hash_sha256", "local_path", "file_size", "is_latest_downloaded"
    )


def newest_versions(spark: SparkSession, folder: str) -> DataFrame:
    return ledger.newest(_ledger(spark, folder)).select("source", "resource_id", "reference_period", "hash_sha256")


def new_versions(spark: SparkSession, folder: str) -> DataFrame:
    """What the labelled documents' ledger does not hold yet of all documents."""
    labelled = table(spark, folder, "labels").select(_doc_path().alias("local_path"))
    landed = _landed(spark, folder)
    known = ledger.as_ledger(ledger.first_arrivals(landed.join(labelled, "local_path", "left_semi")))
    return ledger.new_versions(landed, known).select("source", "resource_id", "hash_sha256", "local_path")


def revisions(spark: SparkSession, folder: str) -> DataFrame:
    return ledger.revisions(_ledger(spark, folder)).select(
        "source", "dataset", "resource_id", "reference_period", "old_hash", "new_hash", "downstream_reprocessed"
    )


def revision_row_changes(spark: SparkSession, folder: str) -> DataFrame:
    log = ledger.revisions(_ledger(spark, folder))
    changes = ledger.count_row_changes(log, _lines(spark, folder), ["line_no"], "line")
    return ledger.with_row_changes(log, changes).select(
        "source", "resource_id", "reference_period", "old_hash", "new_hash", "rows_added", "rows_removed",
        "rows_changed",
    )


def _outcomes(spark: SparkSession, folder: str) -> DataFrame:
    """Checks of the lines of every version; a text that arrived again is not counted twice."""
    file = [*ledger.VERSION_KEY, "local_path"]
    lines = _lines(spark, folder).withColumn("text", F.when(F.col("line") != "", F.col("line")))
    checks = quality.table_checks(lines, file, min_rows=2, key=["line"], required=["text"])
    registered = ledger.first_arrivals(_landed(spark, folder)).select(*file)
    return checks.join(registered, file, "left_semi").drop("local_path")


def version_checks(spark: SparkSession, folder: str) -> DataFrame:
    return _outcomes(spark, folder).groupBy("source", "check_name", "passed", "severity").agg(
        F.count(F.lit(1)).alias("n_versions"), F.sum("rows_affected").alias("rows_affected")
    )


def gate_decisions(spark: SparkSession, folder: str) -> DataFrame:
    return gate.gate_decisions(_outcomes(spark, folder)).select(
        "source", "resource_id", "hash_sha256", "approved", F.size("reasons").alias("n_reasons"),
        F.size("outcomes").alias("n_checks"), _failed(F.array_join("reasons", "; ")).alias("failed"),
    )


def _failed(reasons: Column) -> Column:
    """Names of the checks in a text of reasons."""
    return F.array_join(F.transform(F.split(reasons, "; "), lambda r: F.substring_index(r, ":", 1)), ",")


def _gated(spark: SparkSession, folder: str) -> DataFrame:
    return gate.apply_gate(_ledger(spark, folder), gate.gate_decisions(_outcomes(spark, folder)))


def gated_ledger(spark: SparkSession, folder: str) -> DataFrame:
    return _gated(spark, folder).select(
        "source", "resource_id", "reference_period", "hash_sha256", "is_latest_downloaded", "is_latest_valid",
        "is_active_for_gold", "lifecycle_status", "validation_status", _failed(F.col("quarantine_reason")).alias("failed"),
    )


def gate_rerun(spark: SparkSession, folder: str) -> DataFrame:
    """The gate twice: first half of the versions are judged (by their hash), then only the newest of all."""
    versions = _ledger(spark, folder)
    decisions = gate.gate_decisions(_outcomes(spark, folder))
    half = decisions.where(F.substring("hash_sha256", 1, 1) < "8")
    first = gate.apply_gate(versions, half)
    newest = versions.where("is_latest_downloaded").select(*ledger.VERSION_KEY)
    second = gate.apply_gate(first, decisions.join(newest, list(ledger.VERSION_KEY), "left_semi"))
    return second.select(
        "source", "resource_id", "reference_period", "hash_sha256", "is_latest_valid", "is_active_for_gold",
        "lifecycle_status", "validation_status", _failed(F.col("quarantine_reason")).alias("failed"),
    )


def active_versions(spark: SparkSession, folder: str) -> DataFrame:
    return ledger.active_versions(_gated(spark, folder), "de", "documents").select(
        "source", "resource_id", "reference_period", "hash_sha256"
    )


def freshness(spark: SparkSession, folder: str) -> DataFrame:
    lag = F.try_element_at(F.create_map(*[F.lit(x) for p in LAGS.items() for x in p]), F.col("source"))
    langs = table(spark, folder, "documents").select(F.col("lang").alias("source"))
    areas = table(spark, folder, "events").select(F.col("event_type").alias("source"))
    sources = langs.union(areas).distinct().withColumn("expected_lag_days", lag)
    report = reports.freshness(_gated(spark, folder), sources, F.lit(AS_OF))
    shown = {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in ("last_checked_at", "last_successful_download")}
    days = ("days_since_latest_reference", "days_since_reference_period")
    return report.drop("latest_source_update").withColumns({**shown, **{c: F.coalesce(c, F.lit(-1)) for c in days}})


def lineage(spark: SparkSession, folder: str) -> DataFrame:
    """Versions behind the lines of the active texts."""
    active = _gated(spark, folder).where("is_active_for_gold")
    key = list(ledger.VERSION_KEY)
    used = _lines(spark, folder).select(*key).distinct().join(active.select(*key, "reference_period"), key)
    rows = reports.lineage(used, "active_lines", "v1", "0.1.0", F.lit(AS_OF))
    return rows.withColumn("created_at", F.date_format("created_at", "yyyy-MM-dd HH:mm:ss"))


def schema_hashes(spark: SparkSession, folder: str) -> DataFrame:
    columns = table(spark, folder, "nation").select(
        "n_regionkey",
        F.col("n_nationkey").alias("position"),
        F.col("n_name").alias("column_name"),
        F.lit("bigint").alias("column_type"),
    )
    return ledger.schema_hashes(columns, ["n_regionkey"])


# Catalog ------------------------------------------------------------------------------------------------------


def _published(spark: SparkSession, folder: str) -> DataFrame:
    """Every part as a published resource of its brand's catalog."""
    day = F.format_string("2024-01-%02dT00:00:00", (F.col("p_size") % 28 + 1).cast("int"))
    formats = F.create_map(
        *[F.lit(x) for p in (("STANDARD", "CSV"), ("ECONOMY", "PARQUET"), ("SMALL", "XLSX"), ("LARGE", "Json")) for x in p]
    )
    return table(spark, folder, "part").select(
        F.col("p_brand").alias("catalog"),
        F.col("p_partkey").alias("position"),
        F.concat(F.lit("id-"), F.col("p_partkey").cast("string")).alias("id"),
        F.when(F.col("p_size") > 5, F.col("p_name")).otherwise("").alias("name"),
        F.coalesce(F.try_element_at(formats, F.col("p_type")), F.lit("ZIP")).alias("format"),
        F.concat(F.lit("https://example.org/"), F.col("p_partkey").cast("string")).alias("url"),
        day.alias("created"),
        F.when(F.col("p_size") < 30, day).alias("last_modified"),
        F.when(F.col("p_size") < 20, day).otherwise("").alias("metadata_modified"),
        F.when(F.col("p_size") > 40, F.md5("p_name")).otherwise("").alias("hash"),
        F.col("p_size").cast("bigint").alias("size"),
    )


def catalog_resources(spark: SparkSession, folder: str) -> DataFrame:
    """Catalog answers, one per part and unsuccessful for one brand, read back into resource rows."""
    names = ("id", "name", "format", "url", "created", "last_modified", "metadata_modified", "hash", "size")
    text = F.to_json(
        F.struct(
            (F.col("catalog") != "Brand#7").alias("success"),
            F.struct(
                F.col("catalog").alias("id"), F.array(F.struct(*[F.col(n) for n in names])).alias("resources")
            ).alias("result"),
        )
    )
    answers = _published(spark, folder).select(F.from_json(text, catalog.CATALOG_TYPE).alias("payload"))
    return catalog.catalog_resources(answers).select(*names, "package_id")


def _listed(spark: SparkSession, folder: str) -> DataFrame:
    return _published(spark, folder).withColumn("format", F.lower("format"))


def preferred_resources(spark: SparkSession, folder: str) -> DataFrame:
    picked = catalog.preferred_resources(_listed(spark, folder), ["catalog"])
    return picked.select("catalog", "id", "format", catalog.recency().alias("recency"))


def preferred_named_resources(spark: SparkSession, folder: str) -> DataFrame:
    picked = catalog.preferred_resources(_listed(spark, folder), ["catalog"], ("xlsx", "csv"), name_contains="RED")
    return picked.select("catalog", "id", "format", "name")


def _named_resources(spark: SparkSession, folder: str) -> DataFrame:
    """Every order as a resource whose name states its period in one of the published ways."""
    year = (F.year("o_orderdate") + 25).cast("string")
    word = F.element_at(
        F.array(*[F.lit(w) for w in (
            "janeiro", "fevereiro", "março", "abril", "maio", "junho", "julho", "agosto", "setembro", "outubro",
            "novembro", "dezembro",
        )]),
        F.month("o_orderdate"),
    )
    digits = F.lpad(F.month("o_orderdate").cast("string"), 2, "0")
    name = (
        F.when(F.col("o_orderpriority") == "1-URGENT", F.concat(F.lit("consumo_"), year, digits, F.lit(".csv.gz")))
        .when(F.col("o_orderpriority") == "2-HIGH", F.concat(F.lit("Consumo - "), F.initcap(word), F.lit(" de "), year))
        .when(F.col("o_orderpriority") == "3-MEDIUM", F.concat(F.translate(word, "ç", "c"), F.lit("-"), year))
        .when(F.col("o_orderpriority") == "5-LOW", F.concat(F.lit("dados "), year, F.lit("/"), digits))
        .otherwise("arquivo-sem-data")
    )
    return table(spark, folder, "orders").select("o_orderkey", name.alias("name"))


def period_from_name(spark: SparkSession, folder: str) -> DataFrame:
    return catalog.with_reference_period(_named_resources(spark, folder))


def period_window(spark: SparkSession, folder: str) -> DataFrame:
    named = catalog.with_reference_period(_named_resources(spark, folder))
    return catalog.in_period_window(named, "2021-03", "2024-10").select("o_orderkey", "reference_period")


def page_links(spark: SparkSession, folder: str) -> DataFrame:
    return catalog.page_links(table(spark, folder, "pages"), LINK_ENDINGS).select("page_id", "link_position", "link")


def current_links(spark: SparkSession, folder: str) -> DataFrame:
    found = catalog.current_links(table(spark, folder, "pages"), CURRENT_LINK_ENDINGS, F.lit(FALLBACK_URL))
    return found.select("page_id", "download_url", "used_fallback", "resource_id")


# Scenarios ----------------------------------------------------------------------------------------------------


def _yearly(spark: SparkSession, folder: str) -> DataFrame:
    """Order value per region and year; nation and region are fixed, tiny dimensions."""
    nations = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    customers = table(spark, folder, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    per_customer = (
        table(spark, folder, "orders")
        .groupBy("o_custkey", F.year("o_orderdate").alias("year"))
        .agg(F.sum("o_totalprice").alias("__value"))
    )
    joined = per_customer.join(customers, F.col("o_custkey") == F.col("c_custkey"))
    return joined.groupBy(F.col("r_name").alias("country"), "year").agg((F.sum("__value") / 1e8).alias("value"))


def anchors_dense(spark: SparkSession, folder: str) -> DataFrame:
    anchors = _yearly(spark, folder).where(F.col("year").isin(list(ANCHOR_YEARS)))
    return rounded(scenarios.densify(anchors, ["country"], *YEARS))


def _scenarios(spark: SparkSession, folder: str) -> DataFrame:
    yearly = _yearly(spark, folder)
    anchors = yearly.where(F.col("year").isin(list(ANCHOR_YEARS)))
    alternative = yearly.where(F.col("year") == ALTERNATIVE_YEAR).withColumn("value", F.col("value") * 1.5)
    return scenarios.scenario_table(anchors, alternative, ["country"], *YEARS, KWH_PER_UNIT)


def scenario_table(spark: SparkSession, folder: str) -> DataFrame:
    return _scenarios(spark, folder)


def _shares(spark: SparkSession, folder: str) -> DataFrame:
    """Each nation's customers against all of its region's, and against the region's two largest segments."""
    per_nation = table(spark, folder, "customer").groupBy("c_nationkey").agg(
        F.count(F.lit(1)).alias("units"),
        F.count_if(F.col("c_mktsegment").isin("HOUSEHOLD", "BUILDING")).alias("narrow_units"),
    )
    nations = table(spark, folder, "nation").join(
        table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    named = nations.join(per_nation, F.col("n_nationkey") == F.col("c_nationkey")).select(
        F.col("r_name").alias("country"), F.col("n_name").alias("region"), "units", "narrow_units"
    )
    totals = named.groupBy("country").agg(
        F.sum("units").alias("broad"), F.sum("narrow_units").alias("narrow")
    )
    return scenarios.share_bounds(named.join(totals, "country"), "units", "broad", "narrow")


def weight_bounds(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_shares(spark, folder).select("country", "region", "weight_low", "weight_high", "weight_central"))


def regional_allocation(spark: SparkSession, folder: str) -> DataFrame:
    return scenarios.allocate(_scenarios(spark, folder), _shares(spark, folder), ["country"])


def growth_rates(spark: SparkSession, folder: str) -> DataFrame:
    def value_in(year: int) -> Column:
        return F.max(F.when(F.col("year") == year, F.col("value")))

    ends = _yearly(spark, folder).groupBy("country").agg(value_in(1995).alias("start"), value_in(2000).alias("end"))
    rate = scenarios.growth_rate(F.col("start"), F.col("end"), F.lit(5))
    return rounded(ends.select("country", rate.alias("cagr")))


def consistency_ratios(spark: SparkSession, folder: str) -> DataFrame:
    yearly = _yearly(spark, folder)
    implied = _scenarios(spark, folder).select(
        "country", "year", "scenario", F.col("implied_bev_phev_fleet_units").alias("implied_units")
    )
    official = yearly.select("country", "year", scenarios.implied_units(F.col("value"), 1000.0).alias("official_units"))
    return rounded(scenarios.consistency_ratio(implied, official, ["country", "year"]))


def hour_weights(spark: SparkSession, folder: str) -> DataFrame:
    raw = table(spark, folder, "lineitem").groupBy(
        F.col("l_returnflag").alias("strategy"), (F.col("l_orderkey") % 24).cast("int").alias("hour")
    ).agg(F.sum("l_quantity").alias("weight"))
    return rounded(overlay.normalize_weights(raw))


def charging_shapes(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(overlay.charging_shapes(profiles.profile_24h(hourly(spark, folder))))


def _overlay(spark: SparkSession, folder: str) -> DataFrame:
    counted = table(spark, folder, "events").groupBy(F.col("event_type").alias("area")).agg(
        F.count(F.lit(1)).alias("n")
    )
    cases = F.array(
        F.struct(F.lit("central").alias("case"), F.col("n").alias("n_vehicles")),
        F.struct(F.lit("upper_bound").alias("case"), (F.col("n") * 2).alias("n_vehicles")),
    )
    return overlay.overlay_hourly(
        profiles.profile_24h(hourly(spark, folder)), counted.select("area", F.inline(cases))
    )


def overlay_hourly(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_overlay(spark, folder))


def overlay_summary(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(overlay.overlay_summary(_overlay(spark, folder), rounded=False), 4)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        silver_readings, rejected_readings, placeholder_counts, latest_readings, hourly_load, system_hourly,
        incremental_months, hourly_stream_result, ledger_stream_result, content_marks,
        observed_counts, ordered_range, ledger_scan,
        profile_24h, profile_by_day_type, profile_by_month, profile_all_grains, system_profile,
        local_calendar, local_source_calendar, holiday_calendar, day_type_counts, month_windows, recheck_windows,
        decimal_comma_prices, clock_hours, category_values, curve_stats, normalized_curve, class_report,
        price_quantiles, labelled_monthly_power,
        load_metrics, flexibility_candidates, calibrated_curve, calibration_summary, source_comparison,
        quality_report, schema_checks, coverage_regression, row_count_anomaly, energy_power_consistency,
        allowed_values,
        file_fingerprints, ledger_versions, newest_versions, new_versions, revisions, revision_row_changes,
        version_checks, landed_readings, landed_class_curves, gate_decisions, gated_ledger, gate_rerun, active_versions, freshness, lineage, schema_hashes,
        catalog_resources, preferred_resources, preferred_named_resources, period_from_name, period_window,
        page_links, current_links,
        anchors_dense, scenario_table, weight_bounds, regional_allocation, growth_rates, consistency_ratios,
        hour_weights, charging_shapes, overlay_hourly, overlay_summary,
    )
}


def configured(query: Query) -> Query:
    def run(spark: SparkSession, folder: str) -> DataFrame:
        return query(configure(spark), folder)

    return run
