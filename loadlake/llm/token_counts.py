"""Token counts that follow edits.

A document is a row of chunks at which the tokenizer's pre-tokens certainly part: white space and the word behind it.
Leaves hold some chunks each, with their length and number of tokens, below a binary tree of sums. An edit re-encodes the
leaves it touches, and a neighbour where the edit took away the white space between them, then renews the sums above.
Leaves are kept as a table (``leaf_table``); ``edited`` takes it and a table of edits and returns the next one.
"""

from __future__ import annotations

import functools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlake.llm.common import struct
from loadlake.llm.encoding import SPACE, PieceEncoder

LEAF_CHUNKS = 64
CHARS_AT_ONCE = 2_000_000
_CHUNK = re.compile(rf"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
_IS_SPACE = re.compile(rf"[{SPACE}]")
_LONG_NUMBER = re.compile(r"[0-9]{4,}")

Edit = tuple[int, int, str]


class Counter:
    """Number of tokens of chunks; different chunks are encoded once."""

    def __init__(self, path: str):
        self.encoder = PieceEncoder(path, lead=" ", encode_special_tokens=True)

    def of(self, chunks: list[str]) -> np.ndarray:
        return self.encoder.few_counts(chunks)

    def leaves(self, texts: list[str]) -> Iterator[tuple[list[str], list[int]]]:
        """The leaves of each text with their tokens; all texts are cut and counted together."""
        pieces = self.encoder.cut(texts)
        tokens = self.encoder.counts(pieces.strings)
        raw = pieces.data.tobytes()
        for first, last in zip(pieces.firsts[:-1].tolist(), pieces.firsts[1:].tolist(), strict=True):
            at = np.arange(first, last, LEAF_CHUNKS)
            bounds = pieces.bounds[np.r_[at, last]].tolist()
            leaves = [raw[a:b].decode() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            yield leaves, np.add.reduceat(tokens[:last], at).tolist() if leaves else []


class TokenTree:
    """Leaves of text, and for each node of a binary tree over them the characters and tokens below it."""

    def __init__(self, text: str, counter: Counter):
        self._fill(*next(counter.leaves([text])), counter)

    @classmethod
    def of_leaves(cls, leaves: list[str], tokens: list[int], counter: Counter) -> TokenTree:
        """The tree of stored leaves with their counts; nothing is encoded."""
        tree = cls.__new__(cls)
        tree._fill(leaves, tokens, counter)
        return tree

    def _fill(self, leaves: list[str], tokens: list[int], counter: Counter) -> None:
        self.counter, self.encoded, self.leaves = counter, 0, list(leaves) or [""]
        n = len(self.leaves)
        self.width = 1 << (n - 1).bit_length()
        self.chars = np.zeros(2 * self.width, np.int64)
        self.tokens = np.zeros(2 * self.width, np.int64)
        self.chars[self.width : self.width + n] = [len(x) for x in self.leaves]
        self.tokens[self.width : self.width + len(tokens)] = tokens
        level = self.width
        while level > 1:
            for sums in (self.chars, self.tokens):
                sums[level // 2 : level] = sums[level : 2 * level : 2] + sums[level + 1 : 2 * level : 2]
            level //= 2

    def _sum(self, k: int) -> None:
        self.chars[k] = self.chars[2 * k] + self.chars[2 * k + 1]
        self.tokens[k] = self.tokens[2 * k] + self.tokens[2 * k + 1]

    def total(self) -> int:
        return int(self.tokens[1])

    def text(self) -> str:
        return "".join(self.leaves)

    def leaf_at(self, place: int) -> tuple[int, int]:
        """Leaf that holds a character, and the characters before the leaf; the last one with text beyond the end."""
        k, before = 1, 0
        place = min(place, max(0, int(self.chars[1]) - 1))
        while k < self.width:
            k *= 2
            if place - before >= self.chars[k]:
                before += int(self.chars[k])
                k += 1
        return min(k - self.width, len(self.leaves) - 1), before

    def _beside(self, leaf: int, step: int) -> int | None:
        leaf += step
        while 0 <= leaf < len(self.leaves):
            if self.leaves[leaf]:
                return leaf
            leaf += step
        return None

    def replace(self, start: int, end: int, text: str) -> None:
        """Put ``text`` in place of the characters from ``start`` to ``end``."""
        first, before = self.leaf_at(start)
        last, _ = self.leaf_at(max(start, end - 1))
        region = "".join(self.leaves[first : last + 1])
        region = region[: start - before] + text + region[end - before :]
        for k in range(first, last + 1):
            self.leaves[k] = ""
        previous = self._beside(first, -1)
        while previous is not None and (not region or not _IS_SPACE.match(region[0]) or _IS_SPACE.match(self.leaves[previous][-1])):
            region, self.leaves[previous], first = self.leaves[previous] + region, "", previous
            previous = self._beside(first, -1)
        after = self._beside(last, 1)
        while after is not None and (not region or _IS_SPACE.match(region[-1]) or not _IS_SPACE.match(self.leaves[after][0])):
            region, self.leaves[after], last = region + self.leaves[after], "", after
            after = self._beside(last, 1)
        self.leaves[first] = region
        self.encoded += len(region)
        tokens = int(self.counter.of(_CHUNK.findall(region)).sum()) if region else 0
        for k in range(first, last + 1):
            self._set(k, len(self.leaves[k]), tokens if k == first else 0)

    def _set(self, leaf: int, chars: int, tokens: int) -> None:
        k = self.width + leaf
        self.chars[k], self.tokens[k] = chars, tokens
        while k > 1:
            k //= 2
            self._sum(k)


def cleaning_edits(text: str) -> list[Edit]:
    """Edits of a usual cleaning step, by place: lines equal to an earlier line with a word go, long numbers are masked."""
    edits, seen, at = [], set(), 0
    for line in text.split("\n"):
        key = line.strip()
        if key and key in seen:
            edits.append((at, min(len(text), at + len(line) + 1), ""))
        else:
            seen.add(key)
            edits += [(at + m.start(), at + m.end(), "0000") for m in _LONG_NUMBER.finditer(line)]
        at += len(line) + 1
    return edits


def applied(tree: TokenTree, edits: list[Edit]) -> None:
    """Edits that do not overlap, in order of place; places count in the text before all edits."""
    for start, end, text in reversed(edits):
        tree.replace(start, end, text)


def trees(texts: list[str], counter: Counter) -> Iterator[tuple[str, TokenTree]]:
    """The texts with their trees, cut and counted some characters at a time."""
    at = 0
    while at < len(texts):
        end, size = at, 0
        while end < len(texts) and (end == at or size + len(texts[end]) <= CHARS_AT_ONCE):
            size += len(texts[end])
            end += 1
        some = texts[at:end]
        for text, (leaves, tokens) in zip(some, list(counter.leaves(some)), strict=True):
            yield text, TokenTree.of_leaves(leaves, tokens, counter)
        at = end


COUNTS = struct(n_tokens=T.LongType(), n_edits=T.LongType(), n_tokens_edited=T.LongType(), n_chars_encoded=T.LongType())


def counted(docs: DataFrame, tokenizer: str) -> DataFrame:
    """The documents with ``tokens``: tokens before and after the cleaning edits, edits, and characters encoded for them.

    Null and empty texts have no tokens and no edits.
    """

    @F.pandas_udf(COUNTS)
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        counter = Counter(tokenizer)
        for texts in batches:
            rows = []
            for text, tree in trees([t or "" for t in texts], counter):
                before = tree.total()
                edits = cleaning_edits(text)
                applied(tree, edits)
                rows.append((before, len(edits), tree.total(), tree.encoded))
            yield pd.DataFrame(rows, columns=COUNTS.names)
        counter.encoder.close()

    return docs.withColumn("tokens", count("text"))


# Kept trees -------------------------------------------------------------------------------------------------------

LEAF = ("doc_id", "leaf", "text", "n_tokens", "fresh")


def leaf_table(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id, leaf, text, n_tokens, fresh``: the leaves of every document's tree, to be stored.

    Null and empty texts are one empty leaf. ``doc_id`` is the key: rows without one are left out, and rows that share one
    have to be merged before.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(tokenizer)
        for batch in batches:
            at, leaf, text, tokens = [], [], [], []
            for i, (_, tree) in enumerate(trees([t or "" for t in batch.column(1).to_pylist()], counter)):
                n = len(tree.leaves)
                at += [i] * n
                leaf += range(n)
                text += tree.leaves
                tokens += tree.tokens[tree.width : tree.width + n].tolist()
            columns = [batch.column(0).take(pa.array(at, pa.int64())), pa.array(leaf, pa.int32()), pa.array(text, pa.string()), pa.array(tokens, pa.int64())]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([True] * len(at))], list(LEAF))
        counter.encoder.close()

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text")
    return rows.mapInArrow(cut, f"doc_id {kind}, leaf int, text string, n_tokens long, fresh boolean")


def edited(leaves: DataFrame, edits: DataFrame, tokenizer: str) -> DataFrame:
    """The leaf table after ``edits`` (``doc_id, start, end, text``); ``fresh`` marks leaves encoded for them.

    Places count in the text before all edits and are clipped to it; of edits that overlap the one with the smaller start
    (then end, then text) holds; a null text deletes. Edits of unknown documents do nothing. Only documents with edits
    move, and of these only touched leaves and their boundary are encoded. A leaf that has grown is cut again.
    """
    known = edits.where(F.col("doc_id").isNotNull() & F.col("start").isNotNull() & F.col("end").isNotNull())
    known = known.select("doc_id", F.col("start").cast("long"), F.col("end").cast("long"), F.coalesce("text", F.lit("")).alias("new"))
    touched = known.select("doc_id").distinct()
    kept = leaves.join(touched, "doc_id", "left_anti").withColumn("fresh", F.lit(False))
    of_edits = leaves.join(touched, "doc_id", "left_semi").select(*LEAF)
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in of_edits.schema])

    def change(mine: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        mine = mine.sort_values("leaf")
        if not len(mine):
            return pd.DataFrame({name: pd.Series([], dtype=object) for name in LEAF})
        counter = _counter(tokenizer)
        old = list(mine.text)
        tree = TokenTree.of_leaves(old, mine.n_tokens.tolist(), counter)
        size, end, good = int(tree.chars[1]), 0, []
        for row in wanted.sort_values(["start", "end", "new"]).itertuples():
            first, last = min(max(0, row.start), size), min(max(0, row.end), size)
            if first >= end and last >= first:
                good.append((first, last, row.new))
                end = max(last, first)
        applied(tree, good)
        text, tokens, fresh = [], [], []
        for k, leaf in enumerate(tree.leaves):
            changed = leaf != old[k]
            chunks = _CHUNK.findall(leaf) if changed else ()
            if len(chunks) > 2 * LEAF_CHUNKS:
                parts = ["".join(chunks[i : i + LEAF_CHUNKS]) for i in range(0, len(chunks), LEAF_CHUNKS)]
                counts = np.add.reduceat(counter.of(list(chunks)), range(0, len(chunks), LEAF_CHUNKS)).tolist()
            else:
                parts, counts = [leaf], [int(tree.tokens[tree.width + k])]
            if leaf or not changed:
                text, tokens, fresh = text + parts, tokens + counts, fresh + [changed] * len(parts)
        if not text:
            text, tokens, fresh = [""], [0], [True]
        columns = {"doc_id": [mine.doc_id.iloc[0]] * len(text), "leaf": list(range(len(text))), "text": pd.Series(text, dtype=object)}
        return pd.DataFrame({**columns, "n_tokens": tokens, "fresh": fresh})

    done = of_edits.groupBy("doc_id").cogroup(known.groupBy("doc_id")).applyInPandas(change, schema)
    return kept.select(*LEAF).unionByName(done)


@functools.lru_cache(maxsize=1)
def _counter(tokenizer: str) -> Counter:
    """One counter per worker, so that pieces stay known from group to group."""
    return Counter(tokenizer)


def totals(leaves: DataFrame) -> DataFrame:
    """``doc_id, n_tokens, n_chars, n_chars_encoded``: the roots of the stored trees."""
    length = F.length("text").cast("long")
    return leaves.groupBy("doc_id").agg(
        F.sum("n_tokens").alias("n_tokens"), F.sum(length).alias("n_chars"), F.sum(F.when(F.col("fresh"), length).otherwise(0)).alias("n_chars_encoded")
    )
