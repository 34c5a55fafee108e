"""Jobs of the lake: landed files to ledger, gate, products and reports."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, LongType, StringType, StructField, StructType, TimestampType

from loadlake.operators import (
    calendar,
    calibration,
    curves,
    gate,
    ledger,
    metrics,
    overlay,
    profiles,
    quality,
    readings,
    reports,
    scenarios,
)
from loadlake.sources import landed, tables

# The areas whose sum is the national system.
NATIONAL_AREAS = ("S", "NE", "N", "SECO")
# (grain, sort order) of the report files.
REPORTS = {
    "average_24h": ("overall", ("area", "hour")),
    "average_24h_by_day_type": ("day_type", ("area", "day_type", "hour")),
    "average_24h_by_month": ("month", ("area", "month", "hour")),
}


def lake_path(file_path: Column, root: str) -> Column:
    """Path of a file below the lake's root, as the ledger stores it."""
    home = re.sub(r"^[a-zA-Z][a-zA-Z0-9+.-]*:/*(?=/)", "", root.rstrip("/")) + "/"
    return F.substring(file_path, F.locate(home, file_path) + len(home), F.length(file_path))


def files_below(root: str, versions: DataFrame) -> list[str]:
    """Reader paths of the files of some ledger rows, as long a list as the scan's own list of files."""
    rows = versions.select("local_path").where(F.col("local_path").isNotNull()).distinct().orderBy("local_path")
    return [landed.literal_path(f"{root.rstrip('/')}/{r.local_path}") for r in rows.toLocalIterator()]


LANDED_SCHEMA = StructType(
    [
        StructField("local_path", StringType()),
        StructField("file_size", LongType()),
        StructField("modified_at", TimestampType()),
        StructField("hash_sha256", StringType()),
    ]
)
FILE_STATE = ("local_path", "file_size", "modified_at")


def landed_states(spark: SparkSession, root: str, arrivals: DataFrame) -> DataFrame:
    """``local_path, file_size, modified_at`` of the files in the folders of the arrivals, by listing and not by reading.

    There is one file-system call per folder, besides Spark's own listing.
    """
    folder = F.regexp_extract("local_path", "^(.*)/[^/]*$", 1)
    folders = [r.f for r in arrivals.where(F.col("local_path").isNotNull()).select(folder.alias("f")).distinct().toLocalIterator()]
    there = [p for p in (landed.literal_path(f"{root.rstrip('/')}/{f}".rstrip("/")) for f in sorted(folders)) if _exists(spark, p)]
    if not there:
        return spark.createDataFrame([], LANDED_SCHEMA).select(*FILE_STATE)
    listed = landed.listed_files(spark, there)
    return listed.select(lake_path(F.col("file_path"), root).alias("local_path"), "file_size", "modified_at")


def land(
    spark: SparkSession, root: str, arrivals: DataFrame, rows_of: Callable[[DataFrame], DataFrame] | None = None
) -> tuple[DataFrame, DataFrame]:
    """Append the arrivals that are new content; returns (new versions, all revisions so far).

    ``arrivals`` describes landed files: ``source, dataset, resource_id, reference_period, local_path``,
    ``retrieved_at`` and what else the ledger has columns for. Hash and size are taken from the files. A file is not read
    again if path, size and modification time are those it had when it was last taken in; new content under an old path
    is a new version. An arrival whose file is not there is skipped.

    The ledger, the revision log and the states of the files are appended in this order, each as what is still missing
    from it, so that a run that ends between them is completed by the next one.

    ``rows_of`` turns ledger rows into the records of their files: the columns of ``ledger.VERSION_KEY``, ``record`` (a
    key, unique in a version) and ``content``. With it, ``row_count`` and the counts of the revisions are filled in.
    """
    path = tables.layer_path(root, "metadata", "ledger")
    log_path = tables.layer_path(root, "metadata", "source_revision_log")
    states_path = tables.layer_path(root, "metadata", "landed_files")
    known = tables.read_or_empty(spark, path, ledger.LEDGER_SCHEMA)
    staged_states = tables.layer_path(root, "metadata", "landed_files_run")
    state = list(FILE_STATE)
    seen = tables.read_or_empty(spark, states_path, LANDED_SCHEMA)
    found = landed_states(spark, root, arrivals).join(arrivals.select("local_path").distinct(), "local_path", "left_semi")
    changed = found.join(seen.select(*state), state, "left_anti")
    there = files_below(root, changed)
    hashes = landed.fingerprints(spark, there) if there else spark.createDataFrame([], "file_path string, hash_sha256 string, file_size long")
    hashes = hashes.select(lake_path(F.col("file_path"), root).alias("local_path"), "hash_sha256")
    tables.write_product(changed.join(hashes, "local_path").select(*LANDED_SCHEMA.names), staged_states)
    changed = tables.read_or_empty(spark, staged_states, LANDED_SCHEMA)
    unread = arrivals.join(changed.select("local_path"), "local_path", "left_semi")
    if there:
        files = changed.drop("modified_at")
        hashed = unread.drop("hash_sha256", "file_size").join(files, "local_path")
        fresh = ledger.as_ledger(ledger.new_versions(hashed, known))
        if rows_of is not None:
            counts = rows_of(fresh).groupBy(*ledger.VERSION_KEY).agg(F.count(F.lit(1)).alias("__n"))
            counted = fresh.join(counts, list(ledger.VERSION_KEY), "left")
            fresh = counted.withColumn("row_count", F.coalesce("__n", F.lit(0))).select(*ledger.LEDGER_SCHEMA.names)
        staged = tables.layer_path(root, "metadata", "ledger_arrivals")
        tables.write_product(fresh, staged)
        fresh = tables.read_or_empty(spark, staged, ledger.LEDGER_SCHEMA)
        tables.append(fresh, path)
    else:
        fresh = spark.createDataFrame([], ledger.LEDGER_SCHEMA)
    _append_revisions(spark, path, log_path, rows_of)
    tables.append(changed, states_path)
    return fresh, tables.read_or_empty(spark, log_path, ledger.REVISION_SCHEMA)


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    pattern = jvm.org.apache.hadoop.fs.Path(path)
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    return found is not None and len(found) > 0


def _append_revisions(spark: SparkSession, path: str, log_path: str, rows_of: Callable[[DataFrame], DataFrame] | None) -> None:
    """The revisions of the ledger that the log does not have yet; record counts are made for these only, and are null
    where the older content is gone, since the newer one took its path."""
    stored = tables.read_or_empty(spark, path, ledger.LEDGER_SCHEMA)
    logged = tables.read_or_empty(spark, log_path, ledger.REVISION_SCHEMA)
    pair = ["source", "resource_id", "old_hash", "new_hash"]
    log = ledger.revisions(stored).join(logged.select(*pair), pair, "left_anti").select(*ledger.REVISION_SCHEMA.names)
    staged = f"{log_path}_run"
    tables.write_product(log, staged)
    log = tables.read_or_empty(spark, staged, ledger.REVISION_SCHEMA)
    if rows_of is not None:
        kept = ledger.newest(stored, ["local_path"]).select(*ledger.VERSION_KEY)  # the others' files hold newer content now
        pairs = log
        for side in ("old_hash", "new_hash"):
            pairs = pairs.join(kept.withColumnRenamed("hash_sha256", side), ["source", "resource_id", side], "left_semi")
        sides = pairs.select("source", "resource_id", F.explode(F.array("old_hash", "new_hash")).alias("hash_sha256"))
        involved = stored.join(sides.distinct(), list(ledger.VERSION_KEY), "left_semi")
        changes = ledger.count_row_changes(pairs, rows_of(involved), ["record"], "content")
        log = ledger.with_row_changes(log, changes)
    tables.append(log, log_path)


def reading_rows(spark: SparkSession, root: str) -> Callable[[DataFrame], DataFrame]:
    """Records of readings files for ``land``: a reading is known by area and time."""

    def rows(versions: DataFrame) -> DataFrame:
        files = files_below(root, versions)
        version = versions.select(*ledger.VERSION_KEY, "local_path")
        if not files:
            return version.select(*ledger.VERSION_KEY, F.lit("").alias("record"), F.lit("").alias("content")).limit(0)
        raw = landed.read_readings(spark, files).where("problem IS NULL")
        named = raw.withColumn("local_path", lake_path(F.col("file_path"), root)).join(version, "local_path")
        record = F.concat_ws("|", "cod_areacarga", "din_referenciautc")
        content = F.to_json(F.struct(*landed.READING_FIELDS))
        return named.groupBy(*ledger.VERSION_KEY, record.alias("record")).agg(F.max(content).alias("content"))

    return rows


def validate(versions: DataFrame, outcomes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(quality report, ledger with states) for the newest versions, in one plan.

    ``outcomes`` has the version columns and the check columns. Only newest versions are judged.
    """
    flagged = ledger.with_latest_flag(versions)
    judged = flagged.where("is_latest_downloaded").select(*ledger.VERSION_KEY, "dataset", "reference_period")
    report = outcomes.join(judged, list(ledger.VERSION_KEY))
    decisions = gate.gate_decisions(report)
    return report, gate.apply_gate(flagged, decisions)


DECISION_SCHEMA = StructType(
    [
        StructField("source", StringType()),
        StructField("resource_id", StringType()),
        StructField("hash_sha256", StringType()),
        StructField("approved", BooleanType()),
        StructField("quarantine_reason", StringType()),
        StructField("decided_at", TimestampType()),
    ]
)


def promote(
    spark: SparkSession, root: str, outcomes: DataFrame, decided_at: Column, judge: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """(quality report, ledger with states): judge the newest versions and remember every decision.

    Report and decisions are appended to tables; the states follow from the ledger and the newest decision per version,
    so what an earlier run decided still holds. Each append adds what is missing of this judgement, so a run that ended
    between them, or is repeated with the same ``decided_at``, leaves one report and one decision. ``judge`` names other versions to judge (``ledger.VERSION_KEY``).
    """
    versions = tables.read_or_empty(spark, tables.layer_path(root, "metadata", "ledger"), ledger.LEDGER_SCHEMA)
    flagged = ledger.with_latest_flag(versions)
    judged = flagged.where("is_latest_downloaded") if judge is None else flagged.join(judge, list(ledger.VERSION_KEY), "left_semi")
    named = judged.select(*ledger.VERSION_KEY, "dataset", "reference_period")
    report = outcomes.join(named, list(ledger.VERSION_KEY)).withColumn("decided_at", decided_at.cast("timestamp"))
    report_path = tables.layer_path(root, "metadata", "quality_report")
    log_path = tables.layer_path(root, "metadata", "gate_decisions")
    staged = tables.layer_path(root, "metadata", "quality_report_run")
    tables.write_product(report, staged)
    run = spark.read.parquet(staged)
    judgement = [*ledger.VERSION_KEY, "decided_at"]
    tables.append(run.join(tables.read_or_empty(spark, report_path, run.schema).select(*judgement).distinct(), judgement, "left_anti"), report_path)
    decisions = gate.gate_decisions(run).select(*ledger.VERSION_KEY, "approved", "quarantine_reason")
    decisions = decisions.join(run.select(*judgement).distinct(), list(ledger.VERSION_KEY)).select(*DECISION_SCHEMA.names)
    made = tables.read_or_empty(spark, log_path, DECISION_SCHEMA)
    tables.append(decisions.join(made.select(*judgement), judgement, "left_anti"), log_path)
    return run, gate.apply_gate(flagged, gate.latest_decisions(tables.read_or_empty(spark, log_path, DECISION_SCHEMA)))


def presence_outcomes(versions: DataFrame, files: DataFrame) -> DataFrame:
    """Checks every version gets: its file is there, and it has rows unless its row count is unknown."""
    from loadlake.operators.quality import outcome

    present = versions.select(*ledger.VERSION_KEY, "local_path", "row_count").join(
        files.select("local_path", F.lit(1).alias("__there")).distinct(), "local_path", "left"
    )
    there, rows = F.col("__there").isNotNull(), F.col("row_count")
    cells = F.array(
        outcome("rows_not_empty", "error", F.coalesce(rows > 0, F.lit(True)), F.lit("at least 1 row expected"), rows),
        outcome("file_present", "error", there, F.when(there, F.lit("found")).otherwise("missing")),
    )
    return present.select(*ledger.VERSION_KEY, F.inline(cells))


def reading_outcomes(spark: SparkSession, root: str, versions: DataFrame, expected_end: Column | None = None) -> DataFrame:
    """All table checks of readings files, one parse of the given versions' files: rows, duplicates, nulls, negative
    loads, hours per date, coverage, and unreadable files."""
    from loadlake.operators.quality import outcome

    files = files_below(root, versions)
    version = versions.select(*ledger.VERSION_KEY, "local_path")
    if not files:
        return version.select(*ledger.VERSION_KEY, F.inline(F.array(outcome("not_empty", "error", F.lit(False), F.lit("no file"))))).limit(0)
    raw = landed.read_readings(spark, files).withColumn("local_path", lake_path(F.col("file_path"), root))
    named = raw.drop("resource_id", "hash_sha256").join(version, "local_path")
    typed = calendar.with_local_calendar(readings.type_fields(named.where("problem IS NULL").withColumn("retrieved_at", F.lit(None))), "ts_utc")
    kept = [c for c in ledger.VERSION_KEY if c != "source"]
    sources = version.select(*ledger.VERSION_KEY).distinct()
    checks = quality.table_checks(
        typed, kept, key=["area", "ts_utc"], required=["area", "ts_utc"], value="load_mw", date="date", hour="hour",
        expected_end=expected_end, expected=sources.select(*kept),
    )
    readable = named.groupBy(*ledger.VERSION_KEY).agg(F.count("problem").alias("__bad"), F.max("problem").alias("__why"))
    told = readable.select(
        *ledger.VERSION_KEY,
        F.inline(F.array(outcome("readable", "error", F.col("__bad") == 0, F.coalesce("__why", F.lit("readable")), F.col("__bad")))),
    )
    return sources.join(checks, kept).select(*told.columns).unionByName(told)


VERSION_METRICS = StructType(
    [
        StructField("source", StringType()),
        StructField("resource_id", StringType()),
        StructField("hash_sha256", StringType()),
        StructField("retrieved_at", TimestampType()),
        StructField("row_count", LongType()),
        StructField("max_date", DateType()),
    ]
)
#: Fields that a readings file must have at least one value of.
NEEDED_FIELDS = ("cod_areacarga", "din_referenciautc", "val_cargaglobal")


def gate_outcomes(spark: SparkSession, root: str, versions: DataFrame, expected_end: Column | None = None) -> DataFrame:
    """All ten checks of the given versions' readings files, from one parse of the files.

    The parsed rows are staged and every check reads them there: those of ``reading_outcomes``, ``schema`` (a needed field
    without any value), ``energy_power_consistency`` of the version's own hours, and against earlier versions of the
    resource ``coverage_regression`` and ``row_count_anomaly``. For these, each version's row count and last date are kept
    in a table that a repeated run does not add to twice.
    """
    from loadlake.operators.quality import outcome

    key = list(ledger.VERSION_KEY)
    staged = tables.layer_path(root, "silver", "judged_rows")
    told = versions.select(*key, "local_path", "retrieved_at")
    files = files_below(root, versions)
    if not files:
        return reading_outcomes(spark, root, versions, expected_end)
    raw = landed.read_readings(spark, files).withColumn("local_path", lake_path(F.col("file_path"), root))
    tables.write_product(raw.drop("resource_id", "hash_sha256").join(told, "local_path"), staged)
    named = spark.read.parquet(staged)
    rows = named.where("problem IS NULL")
    typed = calendar.with_local_calendar(readings.type_fields(rows, keep=("source",)), "ts_utc")
    sources = told.select(*key).distinct()

    metrics_path = tables.layer_path(root, "metadata", "version_metrics")
    measured = typed.groupBy(*key).agg(F.count(F.lit(1)).alias("row_count"), F.max("date").alias("max_date"))
    measured = told.groupBy(*key).agg(F.min("retrieved_at").alias("retrieved_at")).join(measured, key, "left")
    measured = measured.withColumn("row_count", F.coalesce("row_count", F.lit(0))).select(*VERSION_METRICS.names)
    known = tables.read_or_empty(spark, metrics_path, VERSION_METRICS)
    tables.append(measured.join(known.select(*key), key, "left_anti"), metrics_path)
    history = tables.read_or_empty(spark, metrics_path, VERSION_METRICS)
    resource, order = ["source", "resource_id"], ["retrieved_at", "hash_sha256"]
    history = history.join(told.select(*resource).distinct(), resource, "left_semi")
    columns = [*key, *quality.OUTCOME]
    coverage = quality.coverage_regression(history, resource, order, F.trunc("retrieved_at", "year"))
    newest = history.groupBy(*resource).agg(F.max_by("hash_sha256", F.struct(*order)).alias("hash_sha256"))
    anomaly = quality.row_count_anomaly(history, resource, order).join(newest, resource)

    hours = typed.groupBy(*key, "area", F.date_trunc("hour", "ts_utc").alias("__hour")).agg(
        F.avg("load_mw").alias("load_hourly_mw"),
        (F.sum("load_mw") * readings.INTERVAL_HOURS).alias("energy_hourly_mwh"),
        (F.count("load_mw") * readings.INTERVAL_HOURS).alias("hours"),
    )
    energy = quality.energy_power_consistency(hours, key, hours=F.col("hours"))
    empty = [F.when(F.count(c) == 0, c) for c in NEEDED_FIELDS]
    fields = rows.groupBy(*key).agg(F.array_compact(F.array(*empty)).alias("__missing"))
    text = F.when(F.size("__missing") == 0, "as expected").otherwise(F.concat(F.lit("without values: "), F.array_join("__missing", ", ")))
    schema = fields.select(*key, F.inline(F.array(outcome("schema", "error", F.size("__missing") == 0, text))))
    checks = quality.table_checks(
        typed, key, key=["area", "ts_utc"], required=["area", "ts_utc"], value="load_mw", date="date", hour="hour",
        expected_end=expected_end, expected=sources,
    )
    readable = named.groupBy(*key).agg(F.count("problem").alias("__bad"), F.max("problem").alias("__why"))
    readable = readable.select(
        *key, F.inline(F.array(outcome("readable", "error", F.col("__bad") == 0, F.coalesce("__why", F.lit("readable")), F.col("__bad"))))
    )
    every = checks.select(*columns)
    for part in (readable, schema, energy, coverage, anomaly):
        every = every.unionByName(part.select(*columns))
    return every.join(sources, key, "left_semi")


@dataclass(frozen=True)
class LoadProducts:
    readings: str
    hourly: str
    system: str
    profiles: str
    lineage: str
    rejects: str
    metrics: str


def product_paths(root: str) -> LoadProducts:
    return LoadProducts(
        readings=tables.layer_path(root, "silver", "readings_30min"),
        hourly=tables.layer_path(root, "gold", "load_hourly"),
        system=tables.layer_path(root, "gold", "system_load_hourly"),
        profiles=tables.layer_path(root, "gold", "average_24h_all"),
        lineage=tables.layer_path(root, "metadata", "gold_dataset_lineage"),
        rejects=tables.layer_path(root, "quarantine", "readings"),
        metrics=tables.layer_path(root, "metadata", "build_metrics"),
    )


def typed_rows(spark: SparkSession, root: str, versions: DataFrame) -> DataFrame:
    """Typed readings of exactly the files that the given ledger rows name, with ``problem`` for unreadable ones.

    Raises if a file holds other content now than the version that is to be read.
    """
    states = tables.read_or_empty(spark, tables.layer_path(root, "metadata", "landed_files"), LANDED_SCHEMA)
    now = states.groupBy("local_path").agg(F.max_by("hash_sha256", "modified_at").alias("__now"))
    gone = versions.join(now, "local_path").where(F.col("__now") != F.col("hash_sha256")).count()
    if gone:
        raise ValueError(f"{gone} versions to be read have lost their files to newer content of the same path")
    files = versions.select("local_path", "resource_id", "retrieved_at", "hash_sha256")
    raw = landed.read_readings(spark, files_below(root, versions))
    named = raw.withColumn("local_path", lake_path(F.col("file_path"), root)).join(files, "local_path")
    return readings.type_fields(named, keep=("problem", "local_path"))


def months_of(rows: DataFrame) -> list[int]:
    """``year * 100 + month`` of the rows; a list no longer than the calendar."""
    months = rows.where(F.col("date").isNotNull()).select(_month().alias("m")).distinct()
    return sorted(r.m for r in months.collect())


def _month() -> Column:
    return F.col("year") * 100 + F.col("month")


def refresh_months(rows: DataFrame, changed: DataFrame, build: Callable[[DataFrame], DataFrame], path: str) -> list[int]:
    """Build anew the months that ``changed`` rows touch, from all ``rows`` of these months, and replace only them.

    Both have the calendar columns. New files are written beside the table and take their places when all are there, so
    other months keep their files and a run that ends early changes nothing. Returns the months.
    """
    months = months_of(changed)
    if months:
        tables.overwrite_partitions(build(rows.where(_month().isin(months))), path)
    return months


def build_load_products(
    spark: SparkSession,
    root: str,
    versions: DataFrame,
    holidays: DataFrame | None = None,
    *,
    areas: Sequence[str] = NATIONAL_AREAS,
    created_at: Column,
    product_version: str = "v1",
    pipeline_version: str = "0.1.0",
    changed: DataFrame | None = None,
) -> LoadProducts:
    """Readings of the given (active) versions to 30-minute, hourly, system and profile tables.

    Each stage reads what the one before has written, so a lost executor costs a stage and not the job. Only the files
    of the versions are opened, and parsed once: typed rows are staged, and rejects, months and readings come from
    there. Copies of a reading are merged before calendar columns are added. Counts of rows and placeholders come from the
    pass that writes the merged readings.

    With ``changed``, the ledger rows that became active since the last build, only their files are read, and only the
    months they touch, or that versions no longer active had rows in, are read from the stored readings, computed and
    replaced; a month that loses its last reading keeps its rows until the next full build, which replaces all.
    """
    paths = product_paths(root)
    staged = tables.layer_path(root, "silver", "readings_staged")
    tables.write_product(typed_rows(spark, root, versions if changed is None else changed), staged)
    usable, rejected = readings.split_rejects(spark.read.parquet(staged))
    narrow = [c for c in usable.columns if c not in ("problem", "local_path")]
    usable = usable.select(*narrow)
    if changed is None:
        months = None
        tables.write_product(rejected, paths.rejects)
    else:
        stored = spark.read.parquet(paths.readings)
        version = ["resource_id", "hash_sha256"]
        active = versions.select(*version)
        new_months = months_of(calendar.with_local_calendar(usable.select("ts_utc"), "ts_utc"))
        months = sorted({*new_months, *months_of(stored.join(active, version, "left_anti"))})
        kept = stored.where(_month().isin(months)).join(active, version, "left_semi")
        usable = usable.unionByName(kept.select(*narrow))
        tables.append(rejected, paths.rejects)
    # What is about to be replaced is read for the last time here: the merged rows are stored elsewhere first.
    merged = tables.layer_path(root, "silver", "readings_merged")
    counted = {"n_rows": F.count(F.lit(1)), "n_placeholders": F.count_if("is_placeholder"), "n_without_load": F.count_if(F.col("load_mw").isNull())}
    observed = tables.write_observed(readings.with_context(readings.latest_readings(usable), holidays), merged, counted)
    cells = [F.lit(observed[name]).cast("long").alias(name) for name in counted]
    tables.append(spark.range(1).select(F.lit("readings_30min").alias("product"), *cells, created_at.cast("string").alias("created_at")), paths.metrics)
    whole = changed is None
    tables.overwrite_partitions(spark.read.parquet(merged), paths.readings, whole=whole)

    def touched(path: str) -> DataFrame:
        table = spark.read.parquet(path)
        return table if months is None else table.where(_month().isin(months))

    tables.overwrite_partitions(readings.hourly_load(touched(paths.readings)), paths.hourly, whole=whole)
    tables.overwrite_partitions(readings.system_hourly(touched(paths.hourly), areas), paths.system, whole=whole)

    hourly = spark.read.parquet(paths.hourly)
    tables.write_product(profiles.all_profiles(hourly), paths.profiles)
    every = spark.read.parquet(paths.profiles)
    for name, (grain, order) in REPORTS.items():
        report = every.where(F.col("grain") == grain)
        unused = [c for c in ("grain", "day_type", "month", "normalized_load") if c not in order]
        if grain == "overall":
            unused.remove("normalized_load")
        tables.write_report(report.drop(*unused), tables.layer_path(root, "gold", name), order)

    used = touched(paths.readings).select("resource_id", "hash_sha256").distinct()
    known = versions.select("source", "resource_id", "hash_sha256", "reference_period")
    rows = reports.lineage(
        used.join(known, ["resource_id", "hash_sha256"]), "load_hourly", product_version, pipeline_version, created_at
    )
    tables.append(rows, paths.lineage)
    return paths


def build_class_curves(
    spark: SparkSession,
    root: str,
    versions: DataFrame,
    labels: Sequence[str] = (),
    *,
    source: str = "aneel_ctr",
    dataset: str = "consumidor_tipo",
) -> str | None:
    """Normalised class curves of the newest active file, and a mean curve per class of ``labels``.

    The typed rows are stored first, as columns; the statistics read them more than once. Returns the path of the
    curves, or nothing without an active file.
    """
    file = ledger.active_versions(versions, source, dataset).orderBy(F.desc("retrieved_at"), "hash_sha256").first()
    if file is None:
        return None
    rows = tables.layer_path(root, "silver", "class_curve_rows")
    out = tables.layer_path(root, "silver", "class_curve_stats")
    tables.write_product(landed.read_class_curves(spark, landed.literal_path(f"{root.rstrip('/')}/{file.local_path}")), rows)
    stats = curves.class_curve_stats(spark.read.parquet(rows))
    tables.write_product(curves.normalize_class_curves(stats), out)
    if labels:
        wanted = spark.createDataFrame([(x,) for x in labels], "label string")
        report = curves.class_reports(spark.read.parquet(out), wanted)
        tables.write_report(report, tables.layer_path(root, "gold", "class_average_24h"), ["label", "hour"])
    return out


def monthly_energy_of(rows: DataFrame, aliases: Sequence[str], area: str, date_format: str = "yyyyMMdd") -> DataFrame:
    """``(area, year, month, energy_mwh, average_power_mw)`` of the rows whose state has one of the spellings."""
    own = curves.rows_with_label(rows, "UF", aliases)
    day = F.coalesce(F.try_to_timestamp("Data", F.lit(date_format)).cast("date"), F.col("Data").try_cast("date"))
    monthly = own.groupBy(F.trunc(day, "MM").alias("month_start")).agg(F.sum("Consumo").alias("energy_mwh"))
    powered = calibration.average_monthly_power(monthly.where(F.col("month_start").isNotNull()))
    return powered.select(
        F.lit(area).alias("area"),
        F.year("month_start").alias("year"),
        F.month("month_start").alias("month"),
        "energy_mwh",
        "average_power_mw",
    )


def calibrate_area(shapes: DataFrame, energy: DataFrame, holidays: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(curve, summary): shapes by day type scaled to each month's energy, with the months' real day counts."""
    counts = calibration.day_counts_long(calendar.day_type_counts(energy.select("year", "month"), holidays))
    curve = calibration.calibrate(shapes, counts, energy.select("area", "year", "month", "energy_mwh"))
    return curve, calibration.calibration_summary(curve)


def report_load_metrics(spark: SparkSession, root: str, other: DataFrame | None = None) -> DataFrame:
    """Metrics and shift candidates of every area's average curve, and their comparison with another source's curve.

    ``other`` has ``area, hour, avg_mw, source, geographic_scope``. All three are stored as reports.
    """
    paths = product_paths(root)
    own = spark.read.parquet(paths.profiles).where("grain = 'overall'")
    measured = metrics.load_metrics(own)
    tables.write_report(measured, tables.layer_path(root, "gold", "load_metrics"), ["area"])
    tables.write_report(metrics.flexibility_candidates(own), tables.layer_path(root, "gold", "flexibility_candidates"), ["area", "hour"])
    if other is not None:
        labels = other.groupBy("area").agg(F.max("source").alias("source"), F.max("geographic_scope").alias("geographic_scope"))
        left = metrics.metrics_long(measured, ["area"]).withColumns(
            {"source": F.lit("ons"), "geographic_scope": F.lit("ONS_load_area")}
        )
        right = metrics.metrics_long(metrics.load_metrics(other), ["area"]).join(labels, "area")
        compared = metrics.compare_sources(left, right, ["area", "metric"])
        tables.write_report(compared, tables.layer_path(root, "gold", "source_comparison"), ["area", "metric"])
    return measured


def store_scenarios(report: ScenarioReport, root: str) -> None:
    """The five tables of a scenario report, as CSV reports."""
    order = {
        "national": ["country", "scenario", "year"],
        "regional": ["region", "scenario", "rj_weight_case", "year"],
        "context": ["country", "year"],
        "hourly": ["region", "case", "strategy", "hour"],
        "summary": ["region", "case", "strategy"],
    }
    for name, columns in order.items():
        tables.write_report(getattr(report, name), tables.layer_path(root, "gold", f"scenarios_{name}"), columns)


def report_freshness(spark: SparkSession, root: str, versions: DataFrame, sources: DataFrame, as_of: Column) -> DataFrame:
    report = reports.freshness(versions, sources, as_of)
    tables.write_report(report, tables.layer_path(root, "gold", "data_freshness_report"), ["source"])
    return report


def export_revisions(spark: SparkSession, root: str) -> DataFrame:
    log = tables.read_or_empty(
        spark, tables.layer_path(root, "metadata", "source_revision_log"), ledger.REVISION_SCHEMA
    )
    order = ["source", "resource_id", "detected_at"]
    tables.write_report(log, tables.layer_path(root, "gold", "source_revision_log"), order)
    return log


@dataclass(frozen=True)
class ScenarioReport:
    national: DataFrame
    regional: DataFrame
    context: DataFrame
    hourly: DataFrame
    summary: DataFrame


def scenario_report(
    anchors: DataFrame,
    alternative: DataFrame,
    context_anchors: DataFrame,
    weights: DataFrame,
    observed: DataFrame,
    *,
    first_year: int,
    last_year: int,
    impact_year: int,
    cases: Sequence[tuple[str, str, str]] = (
        ("central", scenarios.MIDDLE, "central"),
        ("upper_bound", scenarios.HIGH, "high"),
    ),
    charging: overlay.Charging | None = None,
) -> ScenarioReport:
    """National and regional scenarios and their effect on the observed curves, for all countries at once.

    ``anchors``, ``alternative`` and ``context_anchors`` are keyed by ``country``, ``weights`` by ``country`` and
    ``region``, ``observed`` by ``region`` (the country itself for its national curve), ``hour`` and ``avg_mw``.
    ``cases`` are (case, scenario, weight case).
    """
    charging = charging or overlay.Charging()
    national = scenarios.scenario_table(
        anchors, alternative, ["country"], first_year, last_year, charging.kwh_per_unit
    )
    regional = scenarios.allocate(national, weights, ["country"])
    context = scenarios.densify(context_anchors, ["country"], first_year, last_year, digits=4)

    names = F.array(
        *[F.struct(F.lit(c).alias("case"), F.lit(s).alias("__s"), F.lit(w).alias("__w")) for c, s, w in cases]
    )
    fleet = F.col("implied_bev_phev_fleet_units").alias("n_vehicles")
    in_year = F.col("year") == impact_year
    country_cases = (
        national.where(in_year)
        .select(F.col("country").alias("region"), "scenario", F.lit("n/a").alias("rj_weight_case"), fleet, F.inline(names))
        .where(F.col("scenario") == F.col("__s"))
        .drop("__s", "__w")
    )
    region_cases = (
        regional.where(in_year)
        .select("region", "scenario", "rj_weight_case", fleet, F.inline(names))
        .where((F.col("scenario") == F.col("__s")) & (F.col("rj_weight_case") == F.col("__w")))
        .drop("__s", "__w")
    )
    chosen = country_cases.unionByName(region_cases)
    labels = ("case", "scenario", "rj_weight_case")
    hourly = overlay.overlay_hourly(observed, chosen, ("region",), labels, charging=charging)
    return ScenarioReport(national, regional, context, hourly, overlay.overlay_summary(hourly, ("region",), labels))


def month_windows_to_fetch(
    sources: DataFrame, versions: DataFrame, as_of: Column, days: str = "recheck_days"
) -> DataFrame:
    """Recheck windows with ``already_landed``: whether the ledger holds a version of that period."""
    windows = calendar.recheck_windows(sources, as_of, days)
    held = versions.select("source", "reference_period").distinct().withColumn("already_landed", F.lit(True))
    joined = windows.join(held, ["source", "reference_period"], "left")
    return joined.withColumn("already_landed", F.coalesce("already_landed", F.lit(False)))
