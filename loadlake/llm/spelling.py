"""Spelling variants of a corpus vocabulary, found by probing generated edits against Bloom filters.

Words are counted over all texts. Every vocabulary word generates the words one deletion or one replacement away (an
insertion is the deletion of its partner), as hashes only: a word's hash is the scrambled sum of one number per
(place, letter), so an edit's hash is the sum with a few numbers exchanged. The hashes are probed against blocked Bloom
filters of the vocabulary, sharded by word length (and by hash, where a length has more words than one filter holds) and
broadcast shard group by shard group, so that the size of what is broadcast is fixed. Only positives become strings and
meet the vocabulary in an exact join, which removes the false ones.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadlake.llm.common import stored

MIN_CHARS = 5
MIN_COUNT = 3
#: An occurrence of every crc32 divisible by this number loses a letter.
LOSS = 97
#: A form is a near word at least this many times as frequent.
DOMINANCE = 2
BITS_PER_WORD = 16
PROBES = 6
#: Words of one filter shard, and bytes of the filters broadcast at a time.
SHARD_WORDS = 1 << 24
ROUND_BYTES = 64 << 20
_BLOCK_WORDS = 8  # blocks of 512 bits
WORDS_PER_TASK = 5_000
_SUMS_AT_ONCE = 1 << 20
_COUNTED_AT_ONCE = 400_000
_TEXT_AT_ONCE = 1 << 20

#: Letters A-Z, a-z and U+00C0 to U+00FF in UTF-8; the text is lower-cased before, byte by byte, which is A-Z only.
_RUN = re.compile(rb"(?:[a-z]++|\xc3[\x80-\xbf])++")
_NO_LETTER = re.compile(rb"[^a-z\xc3\x80-\xbf]")
_U = np.uint64


def runs(text: bytes) -> Iterator[list[bytes]]:
    """The lower-cased letter runs of a text, in lists that cover about a megabyte each."""
    at = 0
    while at < len(text):
        cut = _NO_LETTER.search(text, min(len(text), at + _TEXT_AT_ONCE))
        end = cut.start() if cut else len(text)
        part = text[at:end] if at or end < len(text) else text
        yield _RUN.findall(part.lower())
        at = end


def written(doc: bytes, run: bytes, loss: int = LOSS) -> bytes:
    """The run as it counts in a document: without one letter where the crc32 says so."""
    h = zlib.crc32(doc + b":" + run)
    if h % loss:
        return run
    letters = run.decode()
    at = h % len(letters)
    return (letters[:at] + letters[at + 1 :]).encode()


def word_counts(docs: DataFrame) -> DataFrame:
    """``word, n``: all words of all texts. A null text has none; a null doc_id counts as an empty one."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[bytes] = Counter()
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if not text:
                    continue
                mine: Counter[bytes] = Counter()
                for some in runs(text):
                    mine.update(some)
                start = zlib.crc32(b":", zlib.crc32(doc))
                for run, n in mine.items():
                    if zlib.crc32(run, start) % LOSS:
                        total[run] += n
                    else:
                        total[written(doc, run)] += n
                if len(total) > _COUNTED_AT_ONCE:
                    yield _counts(total)
                    total = Counter()
        yield _counts(total)

    texts = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary").alias("doc"), F.col("text").cast("binary").alias("text"))
    return texts.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _counts(total: Counter[bytes]) -> pa.RecordBatch:
    words = pa.array(list(total), pa.binary()).cast(pa.string())
    return pa.RecordBatch.from_arrays([words, pa.array(list(total.values()), pa.int64())], ["word", "n"])


def vocabulary(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    return word_counts(docs).where((F.length("word") >= min_chars) & (F.col("n") >= min_count))


# Hashes of words and of their edits ----------------------------------------------------------------------------


def _scrambled(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    x = x ^ (x >> _U(32))
    x = x * _U(0xD6E8FEB86659FD93)
    return x ^ (x >> _U(32))


def _number(place: np.ndarray, letter: np.ndarray) -> np.ndarray:
    """The number of a letter (a code point) at a place."""
    return _scrambled(place.astype(_U) * _U(0x9E3779B97F4A7C15) + letter.astype(_U) * _U(0xC2B2AE3D27D4EB4F))


def letters_of(words: list[str], length: int) -> np.ndarray:
    """Code points of words of one length, a row each."""
    return np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(-1, length)


def hashes(letters: np.ndarray) -> np.ndarray:
    return _scrambled(_number(np.arange(letters.shape[1])[None, :], letters).sum(axis=1, dtype=_U))


def edits(letters: np.ndarray, alphabet: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray | None, np.ndarray]]:
    """``row, place, letter, hash`` of the edits of words of one length: first all deletions (no letter), then all
    replacements by a later letter of the alphabet. In a run of equal letters only the first is deleted.
    """
    n, length = letters.shape
    wide = max(1, _SUMS_AT_ONCE // length)
    for at in range(0, n, wide):
        some = letters[at : at + wide]
        place = np.arange(length)[None, :]
        here, moved = _number(place, some), _number(place - 1, some)
        sums = np.cumsum(here, axis=1, dtype=_U) - here + moved.sum(axis=1, dtype=_U)[:, None] - np.cumsum(moved, axis=1, dtype=_U)
        r, p = np.nonzero(np.diff(some, axis=1, prepend=0) != 0)
        yield at + r, p, None, _scrambled(sums[r, p])
    if not len(alphabet):
        return
    places = max(1, min(length, _SUMS_AT_ONCE // len(alphabet)))
    rows = max(1, _SUMS_AT_ONCE // (places * len(alphabet)))
    for at in range(0, n, rows):
        some = letters[at : at + rows]
        total = _number(np.arange(length)[None, :], some).sum(axis=1, dtype=_U)[:, None]
        for first in range(0, length, places):
            place = np.arange(first, min(length, first + places))
            base = total - _number(place[None, :], some[:, place])
            new = _number(place[:, None], alphabet[None, :])
            r, p, c = np.nonzero(alphabet[None, None, :] > some[:, place][:, :, None])
            yield at + r, first + p, c, _scrambled(base[r, p] + new[p, c])


# Filters --------------------------------------------------------------------------------------------------------


def _cells(hashed: np.ndarray, blocks: int) -> tuple[np.ndarray, np.ndarray]:
    """A word of a block per probe, as places of 64-bit words, and the bit in it: both (n, PROBES)."""
    block = (hashed >> _U(40)) % _U(blocks)
    bits = hashed[..., None] >> (_U(6) * np.arange(PROBES, dtype=_U))
    cell = block[..., None] * _U(_BLOCK_WORDS) + (bits * _U(0x9E3779B97F4A7C15) >> _U(61))
    return cell.astype(np.int64), _U(1) << (bits & _U(63))


def blocks_for(words: int, bits_per_word: int = BITS_PER_WORD) -> int:
    return max(1, -(-words * bits_per_word // (64 * _BLOCK_WORDS)))


def build(hashed: np.ndarray, blocks: int) -> np.ndarray:
    out = np.zeros(blocks * _BLOCK_WORDS, _U)
    cell, bit = _cells(hashed, blocks)
    np.bitwise_or.at(out, cell.ravel(), bit.ravel())
    return out


def has(filter_: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    """Whether each hash seems to be in the filter; later probes look at what passed the earlier ones only."""
    left = np.arange(len(hashed))
    block = ((hashed >> _U(40)) % _U(len(filter_) // _BLOCK_WORDS)) * _U(_BLOCK_WORDS)
    for k in range(PROBES):
        bits = hashed[left] >> _U(6 * k)
        cell = block[left] + (bits * _U(0x9E3779B97F4A7C15) >> _U(61))
        left = left[(filter_[cell.astype(np.int64)] >> (bits & _U(63))) & _U(1) != 0]
    out = np.zeros(len(hashed), bool)
    out[left] = True
    return out


def shards(sizes: dict[int, int], shard_words: int = SHARD_WORDS) -> list[tuple[int, int, int, int]]:
    """``length, part, parts, blocks`` of the filters, for the number of words by length."""
    out = []
    for length, n in sorted(sizes.items()):
        parts = -(-n // shard_words)
        out += [(length, part, parts, blocks_for(-(-n // parts))) for part in range(parts)]
    return out


def shard_rounds(all_shards: list[tuple[int, int, int, int]], round_bytes: int = ROUND_BYTES) -> Iterator[list[tuple[int, int, int, int]]]:
    """Shards in groups whose filters together stay within the given bytes (a shard alone has at most 32 MB)."""
    some, size = [], 0
    for shard in all_shards:
        mine = shard[3] * _BLOCK_WORDS * 8
        if some and size + mine > round_bytes:
            yield some
            some, size = [], 0
        some.append(shard)
        size += mine
    if some:
        yield some


def _part(hashed: np.ndarray, parts: int) -> np.ndarray:
    return (hashed >> _U(8)) % _U(parts)


def by_length(words: list[str]) -> dict[int, np.ndarray]:
    out: dict[int, list[str]] = {}
    for w in words:
        out.setdefault(len(w), []).append(w)
    return {length: letters_of(some, length) for length, some in out.items()}


def filters(words: DataFrame, some: list[tuple[int, int, int, int]]) -> dict[tuple[int, int], np.ndarray]:
    """The filters of some shards: each task sends the bits of its words, merged by block, then by shard segment."""
    lengths = [s[0] for s in some]

    def bits_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, letters in by_length(batch.column(0).to_pylist()).items():
                hashed = hashes(letters)
                for at, part, parts, blocks in some:
                    mine = hashed[_part(hashed, parts) == part] if at == length else ()
                    if len(mine):
                        cell, bit = (x.ravel() for x in _cells(mine, blocks))
                        n = len(cell)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(n, length), pa.int32()), pa.array(np.full(n, part), pa.int32()), pa.array(cell), pa.array(bit.view(np.int64))],
                            ["length", "part", "cell", "bits"],
                        )

    rows = words.where(F.length("word").between(min(lengths), max(lengths))).select("word")
    cells = rows.mapInArrow(bits_of, "length int, part int, cell long, bits long").groupBy("length", "part", "cell").agg(F.bit_or("bits").alias("bits"))
    out = {(length, part): np.zeros(blocks * _BLOCK_WORDS, _U) for length, part, _, blocks in some}
    packed = cells.groupBy("length", "part", F.floor(F.col("cell") / 4096).alias("segment")).agg(
        F.collect_list("cell").alias("cells"), F.collect_list("bits").alias("bits")
    )
    for row in packed.toLocalIterator():
        out[row.length, row.part][np.array(row.cells, np.int64)] = np.array(row.bits, np.int64).view(_U)
    return out


def candidates(words: DataFrame, alphabet: list[str], some: list[tuple[int, int, int, int]], tables: dict[tuple[int, int], np.ndarray]) -> DataFrame:
    """``word, other``: edits of the words that the filters of some shards seem to hold."""
    spark: SparkSession = words.sparkSession
    sent = spark.sparkContext.broadcast(tables)
    codes = letters_of(alphabet, 1).ravel() if alphabet else np.zeros(0, np.uint32)
    targets: dict[int, list[tuple[int, int]]] = {}
    for length, part, parts, _ in some:
        targets.setdefault(length, []).append((part, parts))

    def held(length: int, hashed: np.ndarray) -> np.ndarray:
        found = [np.zeros(0, np.int64)]
        for part, parts in targets[length]:
            here = np.flatnonzero(_part(hashed, parts) == part) if parts > 1 else np.arange(len(hashed))
            found.append(here[has(sent.value[length, part], hashed[here])])
        return np.concatenate(found)

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, letters in by_length(batch.column(0).to_pylist()).items():
                if length not in targets and length - 1 not in targets:
                    continue
                for row, place, letter, hashed in edits(letters, codes if length in targets else codes[:0]):
                    if letter is None and length - 1 not in targets:
                        continue
                    hit = held(length - (letter is None), hashed)
                    found, others = [], []
                    for k in hit:
                        word = letters[row[k]]
                        if letter is None:
                            new = np.delete(word, place[k])
                        else:
                            new = word.copy()
                            new[place[k]] = codes[letter[k]]
                        found.append(_text(word))
                        others.append(_text(new))
                    yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(others, pa.string())], ["word", "other"])

    return words.select("word").mapInArrow(probe, "word string, other string")


def _text(codes: np.ndarray) -> str:
    return codes.astype("<u4").tobytes().decode("utf-32-le")


# Groups ---------------------------------------------------------------------------------------------------------


def near_pairs(words: DataFrame) -> DataFrame:
    """``word, near, near_n``: all ordered pairs of the given words (``word, n``) that are one edit apart."""
    spark = words.sparkSession
    total = words.count()
    spread = stored(words.select("word", "n").repartition(max(1, -(-total // WORDS_PER_TASK)), "word"))
    sizes = {r.length: r.n for r in spread.groupBy(F.length("word").alias("length")).agg(F.count(F.lit(1)).alias("n")).collect()}
    letters = spread.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c")).where("c <> ''").distinct()
    alphabet = sorted(r.c for r in letters.collect())  # at most 26 + 64
    found = None
    for some in shard_rounds(shards(sizes)):
        tables = filters(spread, some)
        reach = [s[0] for s in some]
        mine = spread.where(F.length("word").between(min(reach), max(reach) + 1))
        new = stored(candidates(mine, alphabet, some, tables).join(spread.select(F.col("word").alias("other"), F.col("n").alias("other_n")), "other"))
        found = new if found is None else found.unionByName(new)
    if found is None:
        return spark.createDataFrame([], "word string, near string, near_n long")
    there = found.select("word", F.col("other").alias("near"), F.col("other_n").alias("near_n"))
    back = found.select("word", "other").join(spread, "word").select(F.col("other").alias("word"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    return there.unionByName(back)


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of words with a ``form``: the end of the chain of forms. Chains shorten by doubling; each form has
    at least twice the count, so there are fewer than 64 steps and at most six rounds."""
    links = stored(forms.select("word", F.col("form").alias("root")))
    while True:
        hop = links.select(F.col("word").alias("root"), F.col("root").alias("far"))
        new = stored(links.join(hop, "root", "left").select("word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")))
        moved = new.where("moved").limit(1).count()
        links = new.select("word", "root")
        if not moved:
            return links


def variants(words: DataFrame, dominance: int = DOMINANCE) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of a vocabulary ``word, n``, whose words are different.

    ``form`` is the near word of largest n (of equals the first in code-point order) if it is at least ``dominance``
    times as frequent, else null; ``root`` is the last of the chain of forms, or the word itself.
    """
    words = stored(words.select("word", "n"))
    near = near_pairs(words).groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("m"), F.col("near").alias("w"))).alias("best"))
    told = words.join(near, "word", "left")
    chosen = (-F.col("best.m") >= dominance * F.col("n"))
    told = stored(
        told.select(
            "word",
            "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(chosen, F.col("best.w")).alias("form"),
            F.when(chosen, -F.col("best.m")).alias("form_n"),
        )
    )
    ends = roots(told.where(F.col("form").isNotNull()))
    out = told.join(ends, "word", "left")
    return out.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
