"""Ledger registration of a stream of landed-file rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from loadlake.operators import ledger
from loadlake.sources import tables


def register_into(path: str, processing_version: str = "0.1.0") -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that appends the batch's new versions to the ledger at ``path``.

    A replayed batch appends nothing: its versions are known by then. Rows need ``hash_sha256``.
    """

    def register(batch: DataFrame, _batch_id: int) -> None:
        known = tables.read_or_empty(batch.sparkSession, path, ledger.LEDGER_SCHEMA)
        tables.append(ledger.as_ledger(ledger.new_versions(batch, known), processing_version), path)

    return register
