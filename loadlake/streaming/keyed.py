"""Tables that streams keep: a folder per batch, so that a batch that runs again replaces what it wrote."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlake.operators import ledger
from loadlake.sources import tables

BATCH = "batch"
STORED_LEDGER = T.StructType([*ledger.LEDGER_SCHEMA.fields, T.StructField(BATCH, T.LongType())])


def batches_into(path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that stores each batch's rows under its id.

    A replayed batch, or one whose first run ended half-way, overwrites its own folder and no other.
    """

    def store(rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/{BATCH}={batch_id}")

    return store


def batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All stored rows with their ``batch``; none if nothing has been stored."""
    return tables.read_or_empty(spark, path, T.StructType([*schema.fields, T.StructField(BATCH, T.LongType())]))


def folded(stored: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The row that the newest batch has of every key: what output mode ``update`` comes to."""
    rest = [c for c in stored.columns if c not in (*keys, BATCH)]
    return stored.groupBy(*keys).agg(F.max_by(F.struct(*rest), BATCH).alias("__r")).select(*keys, "__r.*")


def versions_into(path: str, processing_version: str = "0.1.0") -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that stores the new versions among a batch's landed files, once per batch id.

    New is what no earlier batch holds; what a batch itself has written does not count, so running it again, whole or
    after it ended half-way, leaves the rows of one run. Rows need ``hash_sha256``.
    """
    store = batches_into(path)

    def register(rows: DataFrame, batch_id: int) -> None:
        spark = rows.sparkSession
        every = tables.read_or_empty(spark, path, STORED_LEDGER)
        known = every.where(F.col(BATCH) < batch_id).drop(BATCH)
        store(ledger.as_ledger(ledger.new_versions(rows, known), processing_version), batch_id)

    return register
