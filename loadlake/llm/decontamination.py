"""Finding and removing benchmark passages with one FM-index per shard of training text.

A shard is one Arrow batch of documents. Its words are numbered by the vocabulary of the test phrases; a word outside it
cannot be part of an occurrence, so each stretch of such words is one separator, and stretches of known words shorter
than the shortest phrase are left out too. All phrases are searched backwards in the shard's index at once, located by
sampled suffix positions, and merged to spans of words per document.

The benchmark is a stated query set. It is taken to the tasks in blocks of items with at most ``BLOCK_WORDS`` words.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadlake.llm.common import give_back
from loadlake.llm.fm_index import FMIndex

WINDOW = 10
BLOCK_WORDS = 5_000_000
LOCATE_AT_ONCE = 1_000_000

#: Every byte to itself, A-Z to a-z, and ASCII other than letters and digits to a space.
_FOLD = bytes(
    b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256)
)
_WORD = re.compile(rb"[^ ]+")


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


class Phrases:
    """The windows of some benchmark items, numbered, with the items each of them comes from."""

    def __init__(self, items: list[tuple[str, bytes | None]], window: int = WINDOW):
        self.vocabulary: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            for i in range(max(1, len(ids) - window + 1) if ids else 0):
                found.setdefault(tuple(ids[i : i + window]), set()).add(item)
        self.by_length: dict[int, tuple[np.ndarray, list[set[str]]]] = {}
        for n in sorted({len(p) for p in found}):
            some = [p for p in found if len(p) == n]
            self.by_length[n] = np.array(some, np.int64), [found[p] for p in some]
        self.shortest = min(self.by_length, default=0)


def scan(texts: list[bytes | None], phrases: Phrases) -> list[tuple[int, np.ndarray, set[str]]]:
    """For each text: number of words, the hit spans as rows (first word, word after the last), and the items found."""
    counts, symbols, place, owner = [], [], [], []
    for i, text in enumerate(texts):
        words = words_of(text)
        counts.append(len(words))
        if not words or not phrases.shortest:
            continue
        ids = np.fromiter(map(phrases.vocabulary.get, words, repeat(0)), np.int64, len(words))
        edges = np.flatnonzero(np.diff(np.r_[False, ids != 0, False].astype(np.int8)))
        first, end = edges[::2], edges[1::2]
        long = end - first >= phrases.shortest
        for a, b in zip(first[long], end[long], strict=True):
            symbols.append(ids[a : b + 1] if b < len(ids) else np.r_[ids[a:b], 0])
            place.append(np.arange(a, b + 1))
            owner.append(np.full(b - a + 1, i))
    nothing = np.zeros((0, 2), np.int64)
    results = [(n, nothing, set()) for n in counts]
    if not symbols:
        return results
    place, owner = np.concatenate(place), np.concatenate(owner)
    index = FMIndex(np.concatenate(symbols), len(phrases.vocabulary))
    hits: list[np.ndarray] = []
    for n, (patterns, items) in phrases.by_length.items():
        low, high = index.search(patterns)
        matched = np.flatnonzero(high > low)
        sizes = (high - low)[matched]
        done = 0
        while done < len(matched):
            upto = max(done + 1, int(np.searchsorted(np.cumsum(sizes[done:]), LOCATE_AT_ONCE)) + done)
            some, size = matched[done:upto], sizes[done:upto]
            which = np.repeat(some, size)
            rows = np.repeat(low[some] - np.r_[0, np.cumsum(size)[:-1]], size) + np.arange(int(size.sum()))
            at = index.locate(rows)
            hits.append(np.unique(np.stack([owner[at], place[at], place[at] + n], axis=1), axis=0))
            for doc, pattern in np.unique(np.stack([owner[at], which], axis=1), axis=0):
                results[doc][2].update(items[pattern])
            done = upto
    if hits:
        every = np.concatenate(hits)
        every = every[np.lexsort((every[:, 1], every[:, 0]))]
        for part in np.split(every, np.flatnonzero(np.diff(every[:, 0])) + 1):
            doc = int(part[0, 0])
            results[doc] = (results[doc][0], merged(part[:, 1:]), results[doc][2])
    return results


def merged(spans: np.ndarray) -> np.ndarray:
    """Spans sorted by start as spans that neither overlap nor touch."""
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.r_[True, spans[1:, 0] > reach[:-1]]
    first = np.flatnonzero(new)
    return np.stack([spans[first, 0], reach[np.r_[first[1:] - 1, len(spans) - 1]]], axis=1)


def blocks(benchmark: DataFrame, limit: int = BLOCK_WORDS) -> Iterator[list[tuple[str, bytes | None]]]:
    """Items in blocks of about ``limit`` bytes of text, read one after another."""
    block, size = [], 0
    rows = benchmark.where(F.col("item_id").isNotNull()).select(F.col("item_id").cast("string"), F.col("text").cast("binary"))
    for item, text in rows.toLocalIterator():
        block.append((item, bytes(text) if text is not None else None))
        size += len(text or b"")
        if size >= limit:
            yield block
            block, size = [], 0
    if block:
        yield block


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """``doc_id, n_words, spans, items`` per row of ``docs``: hit word spans and the items with occurring windows.

    Null texts have no words. Rows that repeat a doc_id are results of their own. Items without id are not searched.
    Each batch of documents is searched for one block of items after another, and its spans are merged there.
    """
    load = _placed(docs, benchmark, window)
    spans_type = pa.list_(pa.struct([("first", pa.int32()), ("end", pa.int32())]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = scanned(batch.column(1).to_pylist(), load())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([n for n, _, _ in found], pa.int64()),
                    pa.array([[{"first": a, "end": b} for a, b in s.tolist()] for _, s, _ in found], spans_type),
                    pa.array([sorted(x) for _, _, x in found], pa.list_(pa.string())),
                ],
                ["doc_id", "n_words", "spans", "items"],
            )
        give_back()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("binary")).mapInArrow(
        find, f"doc_id {kind}, n_words long, spans array<struct<first:int,end:int>>, items array<string>"
    )


def _placed(docs: DataFrame, benchmark: DataFrame, window: int) -> Callable[[], Iterator[Phrases]]:
    """A function for tasks that gives the phrases of one block after another. Each block is a broadcast of its own, of
    which a task holds one at a time."""
    context = docs.sparkSession.sparkContext
    sent = [context.broadcast(Phrases(block, window)) for block in blocks(benchmark)]

    def load() -> Iterator[Phrases]:
        for one in sent:
            yield one.value
            if len(sent) > 1 and getattr(one, "_path", None):
                vars(one).pop("_value", None)  # read again from the local file when it is asked for again

    return load


def scanned(texts: list[bytes | None], every: Iterator[Phrases]) -> list[tuple[int, np.ndarray, set[str]]]:
    """``scan`` over several blocks of items: spans merged and items united for each text."""
    results = None
    for phrases in every:
        found = scan(texts, phrases)
        results = found if results is None else [_both(x, y) for x, y in zip(results, found, strict=True)]
    return scan(texts, Phrases([])) if results is None else results


def _both(x: tuple[int, np.ndarray, set[str]], y: tuple[int, np.ndarray, set[str]]) -> tuple[int, np.ndarray, set[str]]:
    spans = np.concatenate([x[1], y[1]])
    return x[0], merged(spans[np.argsort(spans[:, 0], kind="stable")]) if len(spans) else spans, x[2] | y[2]


def cut(text: bytes, spans: np.ndarray) -> bytes:
    """Text without the bytes from each span's first word to its last."""
    at = [m.span() for m in _WORD.finditer(text.translate(_FOLD))]
    kept, done = [], 0
    for first, end in spans.tolist():
        kept.append(text[done : at[first][0]])
        done = at[end - 1][1]
    return b"".join([*kept, text[done:]])


def cleaned(texts: list[bytes | None], phrases: Phrases) -> list[bytes | None]:
    """Texts without benchmark windows; texts that changed are searched again until none is left."""
    texts = list(texts)
    todo = list(range(len(texts)))
    while todo:
        found = scan([texts[i] for i in todo], phrases)
        hit = [(i, spans) for i, (_, spans, _) in zip(todo, found, strict=True) if len(spans)]
        for i, spans in hit:
            texts[i] = cut(texts[i], spans)
        todo = [i for i, _ in hit]
    return texts


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without the benchmark passages in their texts; all other columns and rows stay as they are.

    Blocks of items are cut one after another, and all of them again while a later cut joins words of an earlier block.
    """
    load = _placed(docs, benchmark, window)
    at = docs.columns.index("text")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(at).cast(pa.binary()).to_pylist()
            while True:
                before, n = texts, 0
                for phrases in load():
                    texts = cleaned(texts, phrases)
                    n += 1
                if n < 2 or texts == before:
                    break
            out = pa.array(texts, pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([out if i == at else c for i, c in enumerate(batch.columns)], batch.schema.names)
        give_back()

    return docs.mapInArrow(clean, docs.schema)
