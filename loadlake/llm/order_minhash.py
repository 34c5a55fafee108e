"""Near-duplicate documents by order MinHash.

A text is its sequence of 5-word shingles, each labelled with its occurrence number, so that labels are unique in a text.
A sketch of order MinHash takes the two labelled shingles with the smallest hash and keeps them in text order; two texts
share it with a probability near the square of their similarity, and less if the order differs. Texts that share a band
key meet in a bucket. In a bucket, and in its parts that share a further sketch, each text is proposed to the first text,
never to all others. Proposals with enough equal sketches are verified by banded alignment of the shingle sequences. Links
become classes by connected components. What is left is searched exactly: of the texts in buckets that still hold several
classes, all pairs of different classes that share one of their rarest shingles, which every similar pair does (prefix
filter); the counts that say what is rare are those of all these texts.

Similarity of two texts: different shingles aligned in order, over the different shingles of both; links need 0.8.
Exact copies are one node from the start.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlake.llm.common import Tables, give_back, id_filter, split_join

SHINGLE = 5
SIMILARITY = 0.8
SKETCHES = 16
BANDS = 10
MIN_EQUAL = 4
BLOCK = 1_000
FAN = 100
_MASK = (1 << 64) - 1
_MIX = np.array([pow(0xD6E8FEB86659FD93, i + 1, 1 << 64) | 1 for i in range(SHINGLE)], np.uint64)
_SEEDS = np.array([(0x9E3779B97F4A7C15 * (2 * i + 1)) & _MASK for i in range(SKETCHES)], np.uint64)


def _scrambled(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _word_codes(words: list[bytes]) -> np.ndarray:
    """Codes that are the same in every process: from crc32 of the word and of its reverse."""
    from zlib import crc32

    known = {w: crc32(w) << 32 | crc32(w[::-1] + b"\x00") for w in set(words)}
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def shingles(text: bytes | None, width: int = SHINGLE) -> np.ndarray:
    """Hashes of the text's shingles in order; fewer words than the width are one shingle; no words, none."""
    words = text.split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    codes = _scrambled(_word_codes(words))
    n = max(1, len(codes) - width + 1)
    mixed = np.zeros(n, np.uint64)
    for i in range(min(width, len(codes))):
        mixed += codes[i : i + n] * _MIX[i]
    return _scrambled(mixed)


def labelled(mixed: np.ndarray) -> np.ndarray:
    """Shingle hashes made unique by their occurrence number."""
    order = np.argsort(mixed, kind="stable")
    ordered = mixed[order]
    new = np.r_[True, ordered[1:] != ordered[:-1]]
    if new.all():
        return mixed
    first = np.flatnonzero(new)
    number = np.arange(len(mixed)) - first[np.cumsum(new) - 1]
    out = np.empty_like(mixed)
    out[order] = np.where(number > 0, _scrambled(ordered + number.astype(np.uint64) * np.uint64(0xA0761D6478BD642F)), ordered)
    return out


def sketches(text: bytes | None) -> list[int] | None:
    """``SKETCHES`` numbers, each from two labelled shingles in text order; None for a text without words.

    A text that repeats shingles has as many again over the first occurrences alone: against the same text with other
    repeats the labelled ones hardly agree, while the similarity counts different shingles.
    """
    mixed = shingles(text)
    if not len(mixed):
        return None
    keys = labelled(mixed)
    return _sketched(keys) + (_sketched(first_ones(mixed)) if keys is not mixed else [])


def first_ones(mixed: np.ndarray) -> np.ndarray:
    """The different shingles in the order of their first occurrences."""
    return mixed[np.sort(np.unique(mixed, return_index=True)[1])]


def _sketched(keys: np.ndarray) -> list[int]:
    out = []
    for seed in _SEEDS:
        mixed = (keys ^ seed) * np.uint64(0xD6E8FEB86659FD93)
        mixed ^= mixed >> np.uint64(32)
        a = int(mixed.argmin())
        if len(keys) > 1:
            mixed[a] = np.uint64(_MASK)
            b = int(mixed.argmin())
            a, b = min(a, b), max(a, b)
            both = (int(keys[a]) * 0x9E3779B97F4A7C15 + (int(keys[b]) ^ int(seed)) * 0xC2B2AE3D27D4EB4F) & _MASK
        else:
            both = int(keys[0]) ^ int(seed)
        out.append(both - (1 << 64) if both >> 63 else both)
    return out


@F.pandas_udf(T.ArrayType(T.LongType()))
def sketches_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series([sketches(t) for t in texts], dtype=object)
    give_back()


def aligned(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """Similarity by the best alignment inside a band: shingles match in order, displaced by less than its width.

    Similar texts cannot displace a shingle further than the band, so nothing is lost at ``least`` or more.
    The longest chain of matches is an increasing subsequence, as labelled shingles match once at most.
    """
    union = len(np.unique(np.concatenate([a, b])))
    if not union:
        return 0.0
    la, lb = labelled(a), labelled(b)
    by = np.argsort(la, kind="stable")
    at = np.searchsorted(la[by], lb)
    at = np.minimum(at, len(la) - 1)
    place = by[at]
    same = la[place] == lb
    j = np.flatnonzero(same)
    i = place[same]
    inside = np.abs(i - j) <= band(len(a), len(b), least)
    i, j = i[inside], j[inside]
    if len(np.unique(b[j])) < least * union:  # no order can reach the threshold
        return len(np.unique(b[j])) / union
    if len(i) > 1 and (np.diff(i) < 0).any():
        j = j[_increasing(i)]
    return len(np.unique(b[j])) / union


def band(n: int, m: int, least: float) -> int:
    return int(max(n, m) * (1 - least) * 2) + abs(n - m) + SHINGLE


def _increasing(values: np.ndarray) -> np.ndarray:
    """Places of a longest increasing subsequence."""
    tails: list[int] = []
    ends: list[int] = []
    back = np.full(len(values), -1)
    for k, v in enumerate(values.tolist()):
        t = bisect_left(tails, v)
        if t:
            back[k] = ends[t - 1]
        if t == len(tails):
            tails.append(v)
            ends.append(k)
        else:
            tails[t] = v
            ends[t] = k
    out, k = [], ends[-1]
    while k >= 0:
        out.append(k)
        k = int(back[k])
    return np.array(out[::-1])


@F.pandas_udf(T.DoubleType())
def alignment(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    last, seen = None, None

    def of(text: bytes) -> np.ndarray:
        nonlocal last, seen
        if text != last:
            last, seen = text, shingles(text)
        return seen

    for left, right in batches:
        yield pd.Series([aligned(shingles(a), of(b)) for a, b in zip(left, right, strict=True)], dtype=float)
    last, seen = None, None
    give_back()


def labelled_part(sketch: str = "sketch") -> Column:
    return F.slice(sketch, 1, SKETCHES)


def first_part(sketch: str = "sketch") -> Column:
    """The sketches over first occurrences, which are the labelled ones where no shingle is repeated."""
    return F.slice(sketch, -SKETCHES, SKETCHES)


def _n_equal(a: Column, b: Column) -> Column:
    return F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x))


def buckets(nodes: DataFrame, bands: int = BANDS) -> DataFrame:
    """``node, sub, key``: a row per node and band key, with one of the sketches that are no band."""
    spare = SKETCHES - bands

    def places(half: Column) -> Column:
        rest = F.slice(half, bands + 1, spare)
        return F.transform(
            F.slice(half, 1, bands),
            lambda x, i: F.struct(F.xxhash64(i, x).alias("key"), F.get(rest, i % spare).alias("sub")),
        )

    known = nodes.where(F.col("sketch").isNotNull())
    both = F.array_distinct(F.concat(places(labelled_part()), places(first_part())))
    return known.select("node", F.explode(both).alias("p")).select("node", "p.sub", "p.key")


def _groups(rows: DataFrame, key: str) -> DataFrame:
    """Per key that several rows have: their number and their first node."""
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("centre")).where("n > 1")


def proposals(tables: Tables, members: DataFrame) -> DataFrame:
    """Pairs ``a, b`` of nodes worth verifying: each node with the first of its bucket, and with the first of the bucket's
    part that shares a further sketch. A group of any size has as many pairs as nodes.
    """
    parts = members.select("node", F.xxhash64("key", "sub").alias("part"))
    groups = tables.keep(_groups(parts, "part"))
    nearer = split_join(parts, groups, "part", "n").select("node", "centre")
    pairs = members.select("node", "centre").unionByName(nearer).where(F.col("node") != F.col("centre"))
    pairs = tables.keep(pairs.select(F.greatest("node", "centre").alias("a"), F.least("node", "centre").alias("b")).distinct())
    tables.drop(groups)
    return pairs


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``node, t`` and the columns of ``wanted``, which has a row per node: their texts; other documents do not move."""
    chosen = docs.where(id_filter(wanted, "node")(F.col("doc_id"))).select(F.col("doc_id").alias("node"), F.col("text").cast("binary").alias("t"))
    return chosen.join(wanted, "node")


def _shingle_rows(texts: DataFrame) -> DataFrame:
    """``node, root, size, shingle``: the different shingles of each text, and how many there are."""

    def different(batches):
        for batch in batches:
            every = [np.unique(shingles(t)).view(np.int64) for t in batch.column("t").to_pylist()]
            sizes = np.array([len(x) for x in every], np.int64)
            rows = pa.array(np.repeat(np.arange(len(sizes)), sizes))
            columns = [batch.column("node").take(rows), batch.column("root").take(rows)]
            columns += [pa.array(np.repeat(sizes, sizes).astype(np.int32)), pa.array(np.concatenate([np.zeros(0, np.int64), *every]))]
            yield pa.RecordBatch.from_arrays(columns, ["node", "root", "size", "shingle"])
        batch = every = sizes = rows = columns = None
        give_back()

    kind = texts.schema["node"].dataType.simpleString()
    return texts.select("node", "root", "t").mapInArrow(different, f"node {kind}, root {kind}, size int, shingle long")


def prefix_length(size, least: float):
    """How many of a text's rarest shingles are looked at."""
    return size - np.ceil(size * least - 1e-9).astype(np.int64) + 1


def _that_can_match(rows: DataFrame, least: float) -> DataFrame:
    """Without the texts that have more shingles missing from ``rows`` than their prefix is long.

    Rows of a text follow one another; a text that goes over the end of a batch is carried to the next.
    """

    def chosen(table: pa.Table) -> pa.Table:
        nodes = table.column("node").to_numpy()
        first = np.flatnonzero(np.r_[True, nodes[1:] != nodes[:-1]])
        counts = np.diff(np.r_[first, len(nodes)])
        size = table.column("size").to_numpy()[first].astype(np.int64)
        return table.filter(pa.array(np.repeat(size - counts < prefix_length(size, least), counts)))

    def keep(batches):
        left = None
        for batch in batches:
            if not batch.num_rows:
                continue
            table = pa.Table.from_batches([batch])
            table = table if left is None else pa.concat_tables([left, table])
            nodes = table.column("node").to_numpy()
            others = np.flatnonzero(nodes != nodes[-1])
            last = int(others[-1]) + 1 if len(others) else 0
            left = table.slice(last)
            if last:
                yield from chosen(table.slice(0, last)).to_batches()
        if left is not None:
            yield from chosen(left).to_batches()
        batch = table = nodes = left = None
        give_back()

    return rows.mapInArrow(keep, rows.schema)


def prefixes(tables: Tables, texts: DataFrame, least: float) -> DataFrame:
    """``node, root, size, shingle, place, n``: the rarest shingles of each text, as many as it takes that two texts with
    ``least`` of their union in common share one, without those that no other class (``root``) has.

    Shingles of one class only come first, as they are rarest for all that is searched: pairs of different classes. The
    others are ordered by how many of all texts given have them. A text with more shingles of its class's own than its
    prefix is long has no row: it cannot be similar to any text of another class.
    """
    counts = _shingle_rows(texts).groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.min("root").alias("low"), F.max("root").alias("high"))
    counts = tables.keep(counts.where("low <> high").select("shingle", "n"))
    seem_shared = _shingle_rows(texts).where(id_filter(counts, "shingle")(F.col("shingle")))
    wanted = tables.keep(_that_can_match(seem_shared, least))
    shared = split_join(wanted, counts, "shingle", "n")
    listed = shared.groupBy("node", "root", "size").agg(F.sort_array(F.collect_list(F.struct("n", "shingle"))).alias("list"))
    own = F.col("size") - F.size("list")
    length = F.col("size") - F.ceil(F.col("size") * least - 1e-9).cast("int") + 1
    listed = listed.select("node", "root", "size", own.alias("own"), F.slice("list", F.lit(1), F.greatest(length - own, F.lit(0))).alias("list"))
    rows = listed.select("node", "root", "size", "own", F.posexplode("list").alias("i", "s"))
    rows = tables.keep(rows.select("node", "root", "size", "s.shingle", (F.col("own") + F.col("i")).alias("place"), "s.n"))
    tables.drop(counts, wanted)
    return rows


def remaining(tables: Tables, members: DataFrame, classes: DataFrame, docs: DataFrame, least: float) -> DataFrame:
    """``a, b, ra, rb, n``: all pairs of nodes of different classes that can have ``least`` of their shingles in common,
    of the nodes in buckets with several classes; their classes, and how many of their rarest shingles they share.

    Nodes meet by shingle and size class (sizes of similar texts differ by the factor ``least`` at most). A shingle's nodes
    of its largest class are met by those of other classes only, block by block.
    """
    told = members.select("node", "key").join(classes, "node", "left").withColumn("root", F.coalesce("root", "node"))
    mixed = tables.keep(told.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("n")).where("low <> high"))
    live = tables.keep(split_join(told, mixed.select("key", "n"), "key", "n").select("node", "root").distinct())
    texts = tables.keep(_texts(docs, live))
    rows = prefixes(tables, texts, least)
    tables.drop(mixed, live, texts)
    both = least / (1 + least)  # similarity needs this part of both sizes in common
    per_class = rows.groupBy("shingle", "root").agg(F.count(F.lit(1)).alias("m"))
    shared = per_class.groupBy("shingle").agg(F.sum("m").alias("rows"), F.max_by("root", "m").alias("largest"), F.count(F.lit(1)).alias("classes"))
    shared = tables.keep(shared.where("classes > 1").drop("classes"))
    met = split_join(rows, shared, "shingle", "rows").withColumn("blocks", F.ceil(F.col("rows") / BLOCK).cast("int"))
    met = tables.keep(met.withColumn("level", F.floor(F.log("size") / F.log(F.lit(1 / least)) + 1e-9).cast("int")))
    left = met.where(F.col("root") != F.col("largest")).withColumn("level", F.explode(F.array(*[F.col("level") + k for k in (-1, 0, 1)])))
    left = left.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    right = met.withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    left = left.select("shingle", "level", "block", "largest", *[F.col(c).alias(f"{c}_l") for c in ("node", "root", "place", "size")])
    right = right.select("shingle", "level", "block", *[F.col(c).alias(f"{c}_r") for c in ("node", "root", "place", "size")])
    need = F.ceil(both * (F.col("size_l") + F.col("size_r")) - 1e-9)
    pairs = left.join(right, ["shingle", "level", "block"]).where(
        (F.col("root_l") != F.col("root_r"))
        & ((F.col("root_r") == F.col("largest")) | (F.col("node_l") < F.col("node_r")))
        & (F.col("place_l") <= F.col("size_l") - need)
        & (F.col("place_r") <= F.col("size_r") - need)
    )
    turned = F.col("node_l") < F.col("node_r")
    a, b = F.greatest("node_l", "node_r").alias("a"), F.least("node_l", "node_r").alias("b")
    ra, rb = F.when(turned, F.col("root_r")).otherwise(F.col("root_l")), F.when(turned, F.col("root_l")).otherwise(F.col("root_r"))
    found = pairs.select(a, b, ra.alias("ra"), rb.alias("rb")).groupBy("a", "b", "ra", "rb").agg(F.count(F.lit(1)).alias("n"))
    found = tables.keep(found)
    tables.drop(rows, shared, met)
    return found


def _apart(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """The pairs whose nodes are in different classes."""
    for x in ("a", "b"):
        pairs = pairs.join(classes.select(F.col("node").alias(x), F.col("root").alias(f"now_{x}")), x, "left")
    return pairs.where(F.coalesce("now_a", "a") != F.coalesce("now_b", "b")).select("a", "b")


def verified(tables: Tables, pairs: DataFrame, nodes: DataFrame, docs: DataFrame, least: float) -> DataFrame:
    """The proposed pairs with enough equal sketches whose texts align well enough.

    A node that stands in very many pairs is dealt out: its text goes to parts of about ``FAN`` pairs each.
    """
    pairs = tables.keep(pairs)
    degree = tables.keep(pairs.groupBy("b").agg(F.count(F.lit(1)).alias("n")))
    sketch = nodes.select("node", "sketch")
    right = tables.keep(degree.join(sketch.select(F.col("node").alias("b"), F.col("sketch").alias("sb")), "b"))
    both = split_join(pairs, right, "b", "n").join(sketch.select(F.col("node").alias("a"), F.col("sketch").alias("sa")), "a")
    equal = F.greatest(_n_equal(labelled_part("sa"), labelled_part("sb")), _n_equal(first_part("sa"), first_part("sb")))
    parts = F.ceil(F.col("n") / FAN).cast("int").alias("parts")
    worth = tables.keep(both.where(equal >= MIN_EQUAL).select("a", "b", parts))
    texts = tables.keep(_texts(docs, worth.select(F.explode(F.array("a", "b")).alias("node")).distinct()))
    tables.drop(pairs, degree, right)
    deal = worth.groupBy("b").agg(F.max("parts").alias("parts"))
    of_b = texts.select(F.col("node").alias("b"), F.col("t").alias("tb")).join(deal, "b")
    of_b = of_b.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    of_a = worth.withColumn("part", F.pmod(F.xxhash64("a"), F.col("parts")).cast("int")).drop("parts")
    of_a = of_a.join(texts.select(F.col("node").alias("a"), F.col("t").alias("ta")), "a")
    links = tables.keep(of_a.join(of_b, ["b", "part"]).where(alignment("ta", "tb") >= least).select("a", "b").distinct())
    tables.drop(worth, texts)
    return links


def components(tables: Tables, links: DataFrame) -> DataFrame:
    """``node, root``: the smallest node that is linked, over any number of links, for every linked node.

    Each round sends every node the smallest label among its neighbours, then follows the label's own label; rounds are
    few since paths shorten by doubling. Links are written once, labels each round. The label of a node with many
    neighbours, or of a large class, is broadcast with the few others of this kind.
    """
    both = tables.keep(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    labels = tables.keep(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root"), F.count(F.lit(1)).alias("n")).withColumnRenamed("a", "node"))
    while True:
        heard = split_join(both, labels.select(F.col("node").alias("b"), F.col("root").alias("r"), "n"), "b", "n").groupBy("a").agg(F.min("r").alias("r"))
        nearer = tables.keep(labels.join(heard.withColumnRenamed("a", "node"), "node").select("node", "n", "root", F.least("root", "r").alias("new")))
        sizes = nearer.groupBy("new").agg(F.count(F.lit(1)).alias("m"))
        hops = tables.keep(sizes.join(labels.select(F.col("node").alias("new"), F.col("root").alias("far")), "new"))
        new = tables.keep(split_join(nearer, hops, "new", "m").select("node", "n", F.col("far").alias("next"), "root"))
        changed = new.where(F.col("next") != F.col("root")).limit(1).count()
        tables.drop(nearer, hops, labels)
        labels = new.select("node", "n", F.col("next").alias("root"))
        if not changed:
            tables.drop(both)
            return labels.select("node", "root")
        labels = tables.keep(labels)
        tables.drop(new)


def near_duplicates(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """``doc_id, class_id, n_links, n_copies, kept`` per row: the class's smallest doc_id, verified links to other texts of
    the row's text, rows with exactly this text, and whether the row is its class's one document.

    Null text counts as an empty text; texts without words are only alike if equal. Rows without doc_id are
    classes of their own (null class, kept). Rows that repeat a doc_id share its fate.
    """
    tables = Tables(docs.sparkSession, "near-duplicates")
    known = docs.where(F.col("doc_id").isNotNull()).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    body = F.col("text").cast("binary")
    rows = tables.keep(known.select("doc_id", F.unhex(F.md5(body)).alias("copy"), sketches_of(body).alias("sketch")))
    copies = tables.keep(rows.groupBy("copy").agg(F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("n_copies"), F.first("sketch").alias("sketch")))
    ids = tables.keep(rows.select("doc_id", "copy"))
    tables.drop(rows)
    nodes = copies.select("node", "sketch")
    groups = tables.keep(_groups(buckets(nodes), "key"))
    members = tables.keep(split_join(buckets(nodes), groups, "key", "n"))
    tables.drop(groups)
    links = verified(tables, proposals(tables, members), nodes, known, least)
    rest = remaining(tables, members, components(tables, links), known, least)
    tables.drop(members)
    best = rest.groupBy(F.least("ra", "rb"), F.greatest("ra", "rb")).agg(F.max_by(F.struct("a", "b"), "n").alias("p")).select("p.*")
    links = tables.keep(links.unionByName(verified(tables, best, nodes, known, least)).distinct())
    links = tables.keep(links.unionByName(verified(tables, _apart(rest, components(tables, links)), nodes, known, least)).distinct())
    degree = links.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("n_links"))
    classes = components(tables, links)
    told = copies.select("copy", "node", "n_copies").join(classes, "node", "left").join(degree, "node", "left")
    told = tables.keep(told.select("copy", "n_copies", F.coalesce("root", "node").alias("class_id"), F.coalesce("n_links", F.lit(0)).alias("n_links")))
    tables.drop(copies, rest, links)
    out = split_join(ids, told, "copy", "n_copies")
    out = out.select("doc_id", "class_id", "n_links", "n_copies", (F.col("doc_id") == F.col("class_id")).alias("kept"))
    nobody = docs.where(F.col("doc_id").isNull()).select(
        "doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.lit(1).cast("long").alias("n_copies"), F.lit(True).alias("kept")
    )
    return out.unionByName(nobody)


def one_of_each(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The documents without those that have a near duplicate of smaller doc_id in their class."""
    gone = near_duplicates(docs, least).where(~F.col("kept")).select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["_gone"], "left_anti")
