"""The version ledger: which file versions were landed, which are newest, and what changed between them.

The ledger is append-only. What the newest version is, and what replaced what, is derived from it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlake.operators.keys import join_null_safe, with_previous

VERSION_KEY = ("source", "resource_id", "hash_sha256")
SERIES_KEY = ("source", "resource_id", "reference_period")
ORDER = ("retrieved_at", "hash_sha256")

def _schema(**types: str) -> T.StructType:
    known = {"string": T.StringType(), "bigint": T.LongType(), "boolean": T.BooleanType(), "timestamp": T.TimestampType()}
    return T.StructType([T.StructField(name, known[kind]) for name, kind in types.items()])


# Columns of the published ledger tables .
LEDGER_SCHEMA = _schema(
    source="string",
    dataset="string",
    package_id="string",
    resource_id="string",
    resource_name="string",
    reference_period="string",
    format="string",
    download_url="string",
    source_published_at="string",
    source_modified_at="string",
    retrieved_at="timestamp",
    hash_sha256="string",
    etag="string",
    last_modified_http="string",
    file_size="bigint",
    schema_hash="string",
    row_count="bigint",
    validation_status="string",
    lifecycle_status="string",
    is_latest_downloaded="boolean",
    is_latest_valid="boolean",
    is_active_for_gold="boolean",
    processing_version="string",
    local_path="string",
    quarantine_reason="string",
)
REVISION_SCHEMA = _schema(
    source="string",
    dataset="string",
    resource_id="string",
    reference_period="string",
    old_hash="string",
    new_hash="string",
    detected_at="timestamp",
    rows_added="bigint",
    rows_removed="bigint",
    rows_changed="bigint",
    downstream_reprocessed="boolean",
)
LINEAGE_SCHEMA = _schema(
    gold_dataset="string",
    gold_version="string",
    source="string",
    resource_id="string",
    source_hash="string",
    reference_period="string",
    pipeline_version="string",
    created_at="timestamp",
)

def empty_ledger(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], LEDGER_SCHEMA)


def by_day() -> Column:
    """The stretch of a resource's history that is sorted together."""
    return F.date_trunc("day", F.col("retrieved_at"))


def as_ledger(landed: DataFrame, processing_version: str = "0.1.0") -> DataFrame:
    """Landed-file rows in the ledger's columns: what is missing is null, states and flags start fresh."""
    fresh = {
        "validation_status": F.lit("downloaded"),
        "lifecycle_status": F.lit("raw_immutable"),
        "is_latest_downloaded": F.lit(True),
        "is_latest_valid": F.lit(False),
        "is_active_for_gold": F.lit(False),
        "processing_version": F.lit(processing_version),
    }
    columns = []
    for field in LEDGER_SCHEMA:
        if field.name in fresh:
            column = fresh[field.name]
        elif field.name in landed.columns:
            column = F.col(field.name)
        else:
            column = F.lit(None)
        columns.append(column.cast(field.dataType).alias(field.name))
    return landed.select(*columns)


def first_arrivals(landed: DataFrame) -> DataFrame:
    """One row per (source, resource, hash): content that arrives again is not a new version."""
    rest = [c for c in landed.columns if c not in VERSION_KEY]
    order = F.struct(*[c for c in ("retrieved_at", "local_path") if c in rest])
    first = landed.groupBy(*VERSION_KEY).agg(F.min_by(F.struct(*rest), order).alias("__r"))
    return first.select(*VERSION_KEY, "__r.*").select(*landed.columns)


def new_versions(landed: DataFrame, ledger: DataFrame) -> DataFrame:
    """Landed versions whose content the ledger does not hold yet."""
    known = ledger.select(*VERSION_KEY)
    return first_arrivals(landed).join(known, list(VERSION_KEY), "left_anti")


def known_versions(ledger: DataFrame, landed: DataFrame) -> DataFrame:
    """Ledger rows with the source, resource and content of a landed file."""
    return ledger.join(landed.select(*VERSION_KEY), list(VERSION_KEY), "left_semi")


def newest(ledger: DataFrame, keys: Sequence[str] = SERIES_KEY) -> DataFrame:
    """Newest version per key, as an aggregate: versions of a key are merged before they meet."""
    rest = [c for c in ledger.columns if c not in keys]
    top = ledger.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*ORDER)).alias("__r"))
    return top.select(*keys, "__r.*").select(*ledger.columns)


def with_latest_flag(ledger: DataFrame) -> DataFrame:
    """Set ``is_latest_downloaded`` on the newest version per source, resource and period."""
    top = ledger.groupBy(*SERIES_KEY).agg(F.max(F.struct(*ORDER)).alias("__top"))
    plain = ledger.drop("is_latest_downloaded")
    joined = join_null_safe(plain, top, SERIES_KEY, "left")
    flag = F.struct(*ORDER) == F.col("__top")
    return joined.withColumn("is_latest_downloaded", flag).drop("__top").select(
        *[c for c in LEDGER_SCHEMA.names if c in plain.columns or c == "is_latest_downloaded"],
        *[c for c in plain.columns if c not in LEDGER_SCHEMA.names],
    )


def revisions(ledger: DataFrame, block: Column | None = None, reprocessed: bool = False) -> DataFrame:
    """A row for each version that changed an earlier one of the same source, resource and period."""
    chained = with_previous(ledger, SERIES_KEY, ORDER, ["hash_sha256"], by_day() if block is None else block)
    old, new = F.col("previous_hash_sha256"), F.col("hash_sha256")
    return chained.where(old.isNotNull() & (old != new)).select(
        "source",
        "dataset",
        "resource_id",
        "reference_period",
        old.alias("old_hash"),
        new.alias("new_hash"),
        F.col("retrieved_at").alias("detected_at"),
        F.lit(None).cast("bigint").alias("rows_added"),
        F.lit(None).cast("bigint").alias("rows_removed"),
        F.lit(None).cast("bigint").alias("rows_changed"),
        F.lit(reprocessed).alias("downstream_reprocessed"),
    )


def count_row_changes(
    pairs: DataFrame, rows: DataFrame, record: Sequence[str], content: str, version: Sequence[str] = VERSION_KEY
) -> DataFrame:
    """Rows added, removed and changed between the two versions of every pair.

    ``pairs`` has source, resource_id, old_hash and new_hash; ``rows`` has the ``version`` columns, the
    ``record`` key, unique within a version, and its ``content``. Each version's rows are tagged as the old or
    the new side of its pairs and both sides meet in one grouping by record, so the volume is that of the
    rows, the grouping is as fine as the records, and no pair is ever held by one task.
    """
    pair = ["source", "resource_id", "old_hash", "new_hash"]
    sides = pairs.select(
        *pair,
        F.inline(
            F.array(
                F.struct(F.lit("old").alias("side"), F.col("old_hash").alias("hash_sha256")),
                F.struct(F.lit("new").alias("side"), F.col("new_hash").alias("hash_sha256")),
            )
        ),
    )
    tagged = rows.select(*version, *record, F.xxhash64(content).alias("__content")).join(sides, list(version))

    def on(side: str) -> Column:
        return F.max(F.when(F.col("side") == side, F.col("__content")))

    met = tagged.groupBy(*pair, *record).agg(on("old").alias("__old"), on("new").alias("__new"))
    old, new = F.col("__old"), F.col("__new")
    return met.groupBy(*pair).agg(
        F.count_if(old.isNull()).alias("rows_added"),
        F.count_if(new.isNull()).alias("rows_removed"),
        F.count_if(old != new).alias("rows_changed"),
    )


def with_row_changes(revision_log: DataFrame, changes: DataFrame) -> DataFrame:
    """The revision log with its three counts filled in."""
    counts = ["rows_added", "rows_removed", "rows_changed"]
    pair = ["source", "resource_id", "old_hash", "new_hash"]
    joined = revision_log.drop(*counts).join(changes, pair, "left")
    return joined.select(*REVISION_SCHEMA.names)


def files_of(ledger: DataFrame, source: str, dataset: str, which: str = "active") -> DataFrame:
    """Ledger rows whose files a product reads: the ``active`` ones, or the ``latest_downloaded``."""
    flags = {"active": "is_active_for_gold", "latest_downloaded": "is_latest_downloaded"}
    return ledger.where((F.col("source") == source) & (F.col("dataset") == dataset) & F.col(flags[which]))


def active_versions(ledger: DataFrame, source: str, dataset: str, period: str | None = None) -> DataFrame:
    rows = files_of(ledger, source, dataset)
    return rows if period is None else rows.where(F.col("reference_period") == period)


def schema_hashes(columns: DataFrame, resource: Sequence[str]) -> DataFrame:
    """SHA-256 of ``name:type|name:type|...`` per resource, from ``(position, column_name, column_type)`` rows."""
    listed = F.array_sort(F.collect_list(F.struct("position", "column_name", "column_type")))
    text = F.array_join(F.transform(listed, lambda c: F.concat_ws(":", c["column_name"], c["column_type"])), "|")
    return columns.groupBy(*resource).agg(F.sha2(text, 256).alias("schema_hash"))
