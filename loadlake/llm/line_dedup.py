"""Dropping lines that many documents share, found by a pair of Bloom filters.

A line's key is the line without ASCII white space at its ends, A-Z lower-cased. Every task keeps two filters, for keys
seen once and for keys seen again; the filters of all tasks are merged by segment: a bit is in the merged second filter
if a task's second filter has it or two tasks' first filters have it. Keys outside the second filter are certainly in
one document only and never move. Suspected keys travel as 16-byte digests to be counted exactly.

The filter has 8 bits a line and at most ``MAX_BITS``; a fuller filter only makes more keys suspected, which costs 24
bytes of shuffle a line and changes no result.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlake.llm.common import BLANKS, give_back, split_join, stored, struct

MIN_CHARS = 40
MIN_DOCUMENTS = 5
BITS_PER_LINE = 8
MIN_BITS = 1 << 17
MAX_BITS = 1 << 30
SEGMENT_BYTES = 1 << 13


def line_key(line: bytes) -> bytes:
    return line.strip(BLANKS).lower()


def digest(key: bytes) -> bytes:
    return hashlib.blake2b(key, digest_size=16).digest()


def is_long(key: bytes, min_chars: int) -> bool:
    return len(key) >= min_chars and (len(key) >= 4 * min_chars or len(key.decode("utf-8", "replace")) >= min_chars)


def long_digests(text: bytes | None, min_chars: int) -> set[bytes]:
    """Digests of the different long keys of one text."""
    keys = {line_key(line) for line in text.split(b"\n")} if text else ()
    return {digest(k) for k in keys if is_long(k, min_chars)}


def places(digests: set[bytes], bits: int) -> np.ndarray:
    """Two bit numbers per digest."""
    both = np.frombuffer(b"".join(digests), dtype="<u8").reshape(-1, 2)
    return (both & np.uint64(bits - 1)).astype(np.int64)


class TwoFilters:
    """Keys seen, and keys seen again, as two bit arrays."""

    def __init__(self, bits: int):
        self.bits = bits
        self.once = np.zeros(bits // 8, np.uint8)
        self.twice = np.zeros(bits // 8, np.uint8)

    def add(self, digests: set[bytes]) -> None:
        at = places(digests, self.bits)
        again = at[has(self.once, at)].ravel()
        np.bitwise_or.at(self.twice, again >> 3, (1 << (again & 7)).astype(np.uint8))
        at = at.ravel()
        np.bitwise_or.at(self.once, at >> 3, (1 << (at & 7)).astype(np.uint8))


def has(filter_: np.ndarray, at: np.ndarray) -> np.ndarray:
    return ((filter_[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(axis=1)


def repeat_filter(docs: DataFrame, min_chars: int = MIN_CHARS, max_bits: int = MAX_BITS) -> np.ndarray:
    """The filter of keys that more than one document seems to hold; its size is bounded by ``max_bits``."""
    lines = docs.agg(F.sum(F.size(F.split("text", "\n"))).alias("n")).first().n or 0
    bits = MIN_BITS
    while bits < min(lines * BITS_PER_LINE, max_bits):
        bits *= 2
    width = min(SEGMENT_BYTES, bits // 8)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filters = TwoFilters(bits)
        for batch in batches:
            for text in batch.column(0).to_pylist():
                if found := long_digests(text, min_chars):
                    filters.add(found)
        once, twice = filters.once.reshape(-1, width), filters.twice.reshape(-1, width)
        used = np.flatnonzero(once.any(axis=1))
        for first in range(0, len(used), 256):
            some = used[first : first + 256]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(some.astype(np.int32)),
                    pa.array([zlib.compress(once[i].tobytes(), 1) for i in some], pa.binary()),
                    pa.array([zlib.compress(twice[i].tobytes(), 1) for i in some], pa.binary()),
                ],
                ["segment", "once", "twice"],
            )
        del filters, once, twice
        give_back()

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, once, twice = None, None, None

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([current], pa.int32()), pa.array([zlib.compress(twice.tobytes(), 1)], pa.binary())],
                ["segment", "twice"],
            )

        for batch in batches:
            for segment, a, b in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if segment != current:
                    if current is not None and twice.any():
                        yield done()
                    current, once, twice = segment, np.zeros(width, np.uint8), np.zeros(width, np.uint8)
                new = np.frombuffer(zlib.decompress(a), np.uint8)
                twice |= np.frombuffer(zlib.decompress(b), np.uint8) | (once & new)
                once |= new
        if current is not None and twice.any():
            yield done()

    parts = docs.select(F.col("text").cast("binary")).mapInArrow(build, "segment int, once binary, twice binary")
    merged = parts.repartition("segment").sortWithinPartitions("segment").mapInArrow(merge, "segment int, twice binary")
    out = np.zeros((bits // 8 // width, width), np.uint8)
    for row in merged.toLocalIterator():
        out[row.segment] = np.frombuffer(zlib.decompress(row.twice), np.uint8)
    return out.ravel()


def repeated_lines(
    docs: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS, max_bits: int = MAX_BITS
) -> DataFrame:
    """``doc_id, keys``: the digests of the long lines that each document has to give up.

    Those are the keys of at least ``min_chars`` code points held by at least ``min_documents`` different doc_ids,
    except in the largest doc_id holding them. Rows that share a doc_id count as one document; rows without doc_id
    neither count nor lose lines.
    """
    known = docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text")
    repeats = repeat_filter(known, min_chars, max_bits)
    bits = len(repeats) * 8
    sent = docs.sparkSession.sparkContext.broadcast(zlib.compress(repeats.tobytes(), 1))

    def suspect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filter_ = np.frombuffer(zlib.decompress(sent.value), np.uint8)
        for batch in batches:
            ids, keys = [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if found := long_digests(text, min_chars):
                    kept = [k for k, hit in zip(found, has(filter_, places(found, bits)), strict=True) if hit]
                    ids += [doc_id] * len(kept)
                    keys += kept
            yield pa.RecordBatch.from_arrays([pa.array(ids, batch.schema.field(0).type), pa.array(keys, pa.binary())], ["doc_id", "key"])
        del filter_
        give_back()

    kind = known.schema["doc_id"].dataType.simpleString()
    rows = known.select("doc_id", F.col("text").cast("binary")).mapInArrow(suspect, f"doc_id {kind}, key binary")
    suspects = stored(rows.distinct())
    keys = suspects.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("keeper"))
    shared = stored(keys.where(F.col("n") >= min_documents))
    losing = split_join(suspects, shared, "key", "n").where(F.col("doc_id") != F.col("keeper"))
    return losing.groupBy("doc_id").agg(F.collect_set("key").alias("keys"))


@F.pandas_udf(struct(n_lines=T.LongType(), n_dropped=T.LongType(), text=T.StringType()))
def without_lines(texts: pd.Series, keys: pd.Series) -> pd.DataFrame:
    """Text without the lines whose key's digest is listed."""
    out = []
    for text, drop in zip(texts, keys, strict=True):
        lines = (text or b"").split(b"\n")
        if drop is None or not len(drop):
            out.append((len(lines), 0, text or b""))
            continue
        drop = {bytes(k) for k in drop}
        kept = []
        for line in lines:
            key = line_key(line)
            if not (is_long(key, 1) and digest(key) in drop):
                kept.append(line)
        out.append((len(lines), len(lines) - len(kept), b"\n".join(kept)))
    return pd.DataFrame(
        {"n_lines": [x[0] for x in out], "n_dropped": [x[1] for x in out], "text": [x[2].decode("utf-8", "replace") for x in out]}
    )


def deduplicate_lines(docs: DataFrame, **limits: int) -> DataFrame:
    """The documents, each with ``deduplicated``: a struct of ``n_lines``, ``n_dropped`` and the remaining ``text``.

    Null and empty texts are one empty line. The documents move once, to meet their lists of lines.
    """
    lists = repeated_lines(docs, **limits).select(F.col("doc_id").alias("_list_of"), F.col("keys").alias("_keys"))
    met = docs.join(lists.hint("shuffle_hash"), docs["doc_id"] == lists["_list_of"], "left")
    result = met.withColumn("deduplicated", without_lines(F.col("text").cast("binary"), F.col("_keys")))
    return result.select(*[F.col(f"`{c}`") for c in docs.columns if c != "deduplicated"], "deduplicated")
