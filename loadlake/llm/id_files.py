"""Token ids of a corpus as files of range-coded blocks, in the order of doc_id.

Documents are dealt by ranges of doc_id (and, where many share one, by a hash of the text), sorted, tokenised and coded in
the tasks that write; nothing has to be moved afterwards. A file is a Parquet file whose rows are pages: whole documents,
their numbers of ids, and the blocks of all their ids, each with its own models and checksum. Reading back needs no other
order than the files' own: a document's start is its place in the file plus the ids of all files before.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loadlake.llm import id_coder
from loadlake.llm.encoding import SPACE, PieceEncoder

END_ID = 2
PAGE_IDS = id_coder.BLOCK * id_coder.LANES
CHARS_AT_ONCE = 2_000_000
_EDGE = re.compile(rf"(?<=[^{SPACE}])(?=[{SPACE}])")


def parts_of(text: str, size: int = CHARS_AT_ONCE) -> Iterator[str]:
    """The text in parts that end where white space begins, which is where pre-tokens part."""
    at = 0
    while at < len(text):
        cut = _EDGE.search(text, at + size) if at + size < len(text) else None
        end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end


def token_ids(texts: list[str], encoder: PieceEncoder) -> Iterator[np.ndarray]:
    """The tokenizer's ids of each whole text; short texts are encoded together, long ones in parts."""
    at = 0
    while at < len(texts):
        some, size = [], 0
        while at < len(texts) and size + len(texts[at]) <= CHARS_AT_ONCE:
            some.append(texts[at])
            size += len(texts[at])
            at += 1
        if some:
            yield from encoder.ids(encoder.cut(some))
        if at < len(texts) and len(texts[at]) > CHARS_AT_ONCE:
            yield np.concatenate([encoder.ids(encoder.cut([part]))[0] for part in parts_of(texts[at])])
            at += 1


def pages(docs: DataFrame, tokenizer: str, end_id: int = END_ID, page_ids: int = PAGE_IDS) -> DataFrame:
    """``shard, first, n_ids, doc_ids, n_tokens, blocks``: the rows of the files, in order of doc_id over all tasks.

    A null text has no ids but ``end_id``. Rows without doc_id come first; rows of one doc_id are in the order of a hash of
    their texts.
    """
    kind = docs.schema["doc_id"].dataType
    key = F.xxhash64("text").alias("_by")
    dealt = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), key).repartitionByRange("doc_id", "_by")
    dealt = dealt.sortWithinPartitions("doc_id", "_by").select("doc_id", "text")
    end = np.array([end_id], "<u4")

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = PieceEncoder(tokenizer, lead=" ")
        shard, first = TaskContext.get().partitionId(), 0
        doc_ids, ids, size = [], [], 0

        def page() -> pa.RecordBatch:
            lengths = [len(x) for x in ids]
            columns = {
                "shard": pa.array([shard], pa.int32()),
                "first": pa.array([first], pa.int64()),
                "n_ids": pa.array([size], pa.int64()),
                "doc_ids": pa.ListArray.from_arrays([0, len(doc_ids)], pa.concat_arrays(doc_ids)),
                "n_tokens": pa.array([lengths], pa.list_(pa.int64())),
                "blocks": pa.array([id_coder.encode(np.concatenate(ids))], pa.binary()),
            }
            return pa.RecordBatch.from_pydict(columns)

        for batch in batches:
            for k, mine in enumerate(token_ids(batch.column(1).to_pylist(), encoder)):
                mine = np.concatenate([mine, end])
                if ids and size + len(mine) > page_ids:
                    yield page()
                    first += size
                    doc_ids, ids, size = [], [], 0
                doc_ids.append(batch.column(0).slice(k, 1))
                ids.append(mine)
                size += len(mine)
        encoder.close()
        if ids:
            yield page()

    return dealt.mapInArrow(
        coded, f"shard int, first long, n_ids long, doc_ids array<{kind.simpleString()}>, n_tokens array<long>, blocks binary"
    )


def write(docs: DataFrame, tokenizer: str, folder: str, end_id: int = END_ID, page_ids: int = PAGE_IDS) -> None:
    """Write the id files of the documents to a folder that all tasks share."""
    pages(docs, tokenizer, end_id, page_ids).write.parquet(folder)


def read(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, ids``: from the files; ``ids`` are little-endian unsigned 32-bit numbers, ``start`` counts the ids
    of all documents before. Every block's checksum is verified.
    """
    stored = spark.read.parquet(folder)
    kind = stored.schema["doc_ids"].dataType.elementType.simpleString()
    sizes = stored.groupBy("shard").agg(F.sum("n_ids").alias("n"))  # one row per writing task
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                shard, first, lengths, blocks = (batch.column(name)[k].as_py() for name in ("shard", "first", "n_tokens", "blocks"))
                ids = id_coder.decode(blocks)
                if len(ids) != sum(lengths):
                    raise ValueError("a page of token ids is incomplete")
                ends = np.cumsum(lengths)
                rows = np.split(ids, ends[:-1])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(len(lengths), shard, np.int32)),
                        batch.column("doc_ids")[k].values,
                        pa.array(first + ends - lengths, pa.int64()),
                        pa.array([row.tobytes() for row in rows], pa.binary()),
                    ],
                    ["shard", "doc_id", "place", "ids"],
                )

    rows = stored.select("shard", "first", "doc_ids", "n_tokens", "blocks").mapInArrow(decoded, f"shard int, doc_id {kind}, place long, ids binary")
    return rows.join(F.broadcast(starts), "shard").select("doc_id", (F.col("place") + F.col("_before")).alias("start"), "ids")
