"""Packing documents into as few fixed-length sequences as possible, planned on the histogram of lengths.

Best fit, longest first, is run over counts: all pieces of one length are placed at once, group of equal sequences by
group. The plan has a few runs per length, whatever the number of documents; pieces take their slot by joining on their
rank within their length.
"""

from __future__ import annotations

import heapq
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loadlake.llm.common import stored
from loadlake.llm.encoding import PieceEncoder

CAPACITY = 4096
END_ID = 1
RANK_BLOCK = 200
CHARS_AT_ONCE = 4_000_000


def token_ids(texts: list[str], encoder: PieceEncoder) -> Iterator[np.ndarray]:
    """Ids of each text by a tokenizer that drops white space, some texts at a time."""
    at = 0
    while at < len(texts):
        some, size = [], 0
        while at < len(texts) and (not some or size + len(texts[at]) < CHARS_AT_ONCE):
            some.append(texts[at])
            size += len(texts[at])
            at += 1
        yield from encoder.ids(encoder.cut(some))


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` per piece of at most ``capacity`` ids; a document ends with ``END_ID``."""
    end = np.array([END_ID], "<u4")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PieceEncoder(tokenizer, lead="")
        for batch in batches:
            texts = pc.fill_null(batch.column(1), "").to_pylist()
            at, piece, start, length, crc = [], [], [], [], []
            for i, ids in enumerate(token_ids(texts, encoder)):
                ids = np.concatenate([ids, end])
                for k in range(0, len(ids), capacity):
                    part = ids[k : k + capacity]
                    at.append(i)
                    piece.append(k // capacity)
                    start.append(k)
                    length.append(len(part))
                    crc.append(zlib.crc32(part))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(at, pa.int64())),
                    pa.array(piece, pa.int32()),
                    pa.array(start, pa.int64()),
                    pa.array(length, pa.int64()),
                    pa.array(crc, pa.int64()),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )
        encoder.close()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        cut, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    )


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Runs ``(length, first_rank, count, first_sequence, per_sequence, offset)`` of best fit, longest first.

    The pieces of a run have ranks from ``first_rank``; the j-th of them goes to sequence
    ``first_sequence + j // per_sequence``, at ``offset + j % per_sequence * length``.
    """
    runs = []
    room: dict[int, list[tuple[int, int]]] = {}  # free ids: (first sequence, number of sequences) filled alike
    free: list[int] = []
    opened = 0

    def give(left: int, first: int, number: int) -> None:
        if left and number:
            if left not in room:
                room[left] = []
                insort(free, left)
            heapq.heappush(room[left], (first, number))

    for length in sorted(histogram, reverse=True):
        rank, count = 0, histogram[length]
        while count:
            i = bisect_left(free, length)
            if i == len(free):
                fit = capacity // length
                full, some = divmod(count, fit)
                if full:
                    runs.append((length, rank, full * fit, opened, fit, 0))
                    give(capacity - fit * length, opened, full)
                    opened, rank = opened + full, rank + full * fit
                if some:
                    runs.append((length, rank, some, opened, some, 0))
                    give(capacity - some * length, opened, 1)
                    opened += 1
                break
            left = free[i]
            first, number = heapq.heappop(room[left])
            if not room[left]:
                del room[left]
                free.pop(i)
            fit = left // length
            full = min(number, count // fit)
            if full:
                runs.append((length, rank, full * fit, first, fit, capacity - left))
                give(left - fit * length, first, full)
                rank, count, first, number = rank + full * fit, count - full * fit, first + full, number - full
            if number and count:  # fewer than fill one sequence
                runs.append((length, rank, count, first, count, capacity - left))
                give(left - count * length, first, 1)
                rank, count, first, number = rank + count, 0, first + 1, number - 1
            give(left, first, number)
    return runs


def small(spark: SparkSession, columns: dict[str, list[int]]) -> DataFrame:
    """A table of integers that is part of the plan."""
    return spark.createDataFrame(pa.table({name: pa.array(values, pa.int64()) for name, values in columns.items()}))


def ranked(rows: DataFrame, sizes: dict[int, int], block: int = RANK_BLOCK) -> DataFrame:
    """Adds ``rank``, from 0, within ``length``. Lengths of many rows are ranked in blocks of about ``block`` rows.

    ``sizes`` has the number of rows by length, at most one entry per length up to the capacity.
    """
    spark = rows.sparkSession
    blocks = small(spark, {"length": list(sizes), "blocks": [max(1, n // block) for n in sizes.values()]})
    rows = rows.join(F.broadcast(blocks), "length").withColumn("block", F.pmod(F.xxhash64("doc_id", "piece", "start"), "blocks"))
    sums = Window.partitionBy("length").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    before = rows.groupBy("length", "block").agg(F.count(F.lit(1)).alias("n"))
    before = before.select("length", "block", F.coalesce(F.sum("n").over(sums), F.lit(0)).alias("before"))
    within = Window.partitionBy("length", "block").orderBy("doc_id", "piece", "ids_crc32")
    numbered = rows.withColumn("place", F.row_number().over(within) - 1)
    return numbered.join(before, ["length", "block"]).withColumn("rank", F.col("before") + F.col("place")).drop("blocks", "block", "before", "place")


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Pieces with ``sequence_id`` and ``offset``. A null text is an empty document; repeated rows are packed each."""
    spark: SparkSession = docs.sparkSession
    cut = stored(pieces(docs, tokenizer, capacity))
    sizes = {r.length: r.n for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    names = ("of_length", "first_rank", "count", "first_sequence", "per_sequence", "base")
    runs = np.array(plan(sizes, capacity), np.int64).reshape(-1, len(names))
    slots = F.broadcast(small(spark, {name: runs[:, i] for i, name in enumerate(names)}))
    rows = ranked(cut, sizes)
    j = F.col("rank") - F.col("first_rank")
    joined = rows.join(
        slots, (F.col("length") == F.col("of_length")) & (j >= 0) & (F.col("rank") < F.col("first_rank") + F.col("count"))
    )
    step = j % F.col("per_sequence")
    return joined.select(
        "doc_id",
        "piece",
        "start",
        "length",
        "ids_crc32",
        (F.col("first_sequence") + (j - step) / F.col("per_sequence")).cast("long").alias("sequence_id"),
        (F.col("base") + step * F.col("length")).alias("offset"),
    )
