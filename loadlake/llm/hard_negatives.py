"""Hard negatives by shared, certified lists.

Anchors are clustered by direction. Rows are scanned in blocks; in a block, each cluster sorts the rows once by an upper
bound of the score with any of its members: a row at the angle t from the centre is at an angle of at least
t - (the widest member's angle) from every member, so its score is at most (both norms) x (cosine of that). Every member
walks this one list, and stops where the bound falls below what could still enter its own lists; nothing behind that
place can matter, so results are exact.

Anchors grow with the table, so they come in blocks of about ``ANCHOR_BLOCK``; each block is broadcast to two passes over
the rows, one for the positives and one, with their windows known, for the negatives. A task keeps a few rows per anchor,
whatever the number of rows it scans, and the lists of all tasks are merged per anchor.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, sqrt
from typing import NamedTuple
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from loadlake.llm.common import shared_folder, stored

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
#: A negative's score lies between these hundredths of the positive's.
WINDOW = (30, 90)
ANCHOR_BLOCK = 4096
STEP = 256
_NONE = np.iinfo(np.int64).min + 1
_LAST = np.iinfo(np.int64).max
RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def usable(vectors: DataFrame, label: Column | None = None) -> DataFrame:
    """``vec_id, label, vector``: the rows that take part, with whole numbers as components.

    Rows with a null id, label, vector or component, or a component that is not finite, take no part. Rows that are equal
    in all three columns are one row. A shorter vector counts as one with zeros behind it.
    """
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    label = F.col("label") if label is None else label
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), "embedding")
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()).where(finite)
    return rows.select("vec_id", "label", F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE)).alias("vector")).distinct()


class Rows(NamedTuple):
    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    norms: np.ndarray


def matrix(batch: pa.RecordBatch | pa.Table, width: int) -> Rows:
    """The rows of a batch, with vectors filled up to one width."""
    column = batch.column("vector")
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(lengths) and (lengths == width).all():
        vectors = flat.reshape(-1, width)
    else:
        vectors = np.zeros((len(lengths), width))
        vectors[np.arange(width)[None, :] < lengths[:, None]] = flat
    ids, labels = (np.asarray(batch.column(name).to_numpy(), np.int64) for name in ("vec_id", "label"))
    return Rows(ids, labels, vectors, np.sqrt(np.einsum("ij,ij->i", vectors, vectors)))


class Clusters(NamedTuple):
    centres: np.ndarray
    members: list[np.ndarray]
    widest: np.ndarray


def _units(rows: Rows) -> np.ndarray:
    return rows.vectors / np.where(rows.norms > 0, rows.norms, 1)[:, None]


def clustered(anchors: Rows, rounds: int = 8, seed: int = 7) -> Clusters:
    """Anchors by direction, in about as many clusters as a cluster has members."""
    units = _units(anchors)
    n = len(units)
    k = max(1, ceil(sqrt(n)))
    centres = units[np.random.default_rng(seed).permutation(n)[:k]]
    for _ in range(rounds):
        nearest = np.argmax(units @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, units)
        length = np.linalg.norm(sums, axis=1)
        centres = np.where(length[:, None] > 1e-9, sums / np.maximum(length, 1e-9)[:, None], centres)
    nearest = np.argmax(units @ centres.T, axis=1)
    members = [np.flatnonzero(nearest == c) for c in range(k)]
    used = [c for c in range(k) if len(members[c])]
    angle = np.arccos(np.clip(np.einsum("ij,ij->i", units, centres[nearest]), -1, 1))
    angle[anchors.norms == 0] = 0  # their scores are all 0, as is their bound
    widest = np.array([angle[members[c]].max() for c in used]) + 1e-6
    return Clusters(centres[used], [members[c] for c in used], widest)


class Lists:
    """The best ``size`` (score, id) of each of ``n`` lists: higher scores first, ties by smaller id."""

    def __init__(self, n: int, size: int):
        self.scores = np.full((n, size), _NONE, np.int64)
        self.ids = np.full((n, size), _LAST, np.int64)

    def add(self, at: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        size = self.scores.shape[1]
        some, place = np.unique(at, return_inverse=True)
        row = np.concatenate([np.repeat(np.arange(len(some)), size), place])
        scores = np.concatenate([self.scores[some].ravel(), scores])
        ids = np.concatenate([self.ids[some].ravel(), ids])
        order = np.lexsort((ids, -scores, row))
        row = row[order]
        first = np.searchsorted(row, np.arange(len(some)))
        order = order[np.arange(len(row)) - first[row] < size]
        self.scores[some] = scores[order].reshape(-1, size)
        self.ids[some] = ids[order].reshape(-1, size)


class Positives:
    """Collects each anchor's best other rows of the same label."""

    def __init__(self, anchors: Rows, size: int):
        self.anchors = anchors
        self.lists = Lists(len(anchors.ids), size)

    def need(self, members: np.ndarray) -> np.ndarray:
        """Scores below this change nothing any more."""
        return self.lists.scores[members, -1]

    def meet(self, members: np.ndarray, scores: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        fit = (labels[None, :] == self.anchors.labels[members][:, None]) & (ids[None, :] != self.anchors.ids[members][:, None])
        a, b = np.nonzero(fit & (scores >= self.need(members)[:, None]))
        if len(a):
            self.lists.add(members[a], scores[a, b], ids[b])


class Negatives:
    """Collects, for each anchor and positive, the best rows of other labels inside the positive's window."""

    def __init__(self, anchors: Rows, positives: np.ndarray, size: int, window: tuple[int, int]):
        """``positives`` has the scores of each anchor's positives, ``_NONE`` where it has fewer."""
        known = positives != _NONE
        p = np.where(known, positives, 0)
        self.anchors = anchors
        self.per = positives.shape[1]
        whole, rest = p // 100, p % 100  # apart, so that the products fit
        self.low = np.where(known, window[0] * whole - (-window[0] * rest) // 100, 1)
        self.high = np.where(known, window[1] * whole + window[1] * rest // 100, 0)
        self.lists = Lists(positives.size, size)

    def _least(self, members: np.ndarray) -> np.ndarray:
        found = self.lists.scores[:, -1].reshape(-1, self.per)[members]
        low, high = self.low[members], self.high[members]
        return np.where(low > high, _LAST, np.maximum(low, found))

    def need(self, members: np.ndarray) -> np.ndarray:
        return self._least(members).min(axis=1)

    def meet(self, members: np.ndarray, scores: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        least, high = self._least(members), self.high[members]
        fit = (labels[None, :] != self.anchors.labels[members][:, None]) & (scores >= least.min(axis=1)[:, None])
        a, b = np.nonzero(fit)
        s = scores[a, b]
        for k in range(self.per):
            ok = (s >= least[a, k]) & (s <= high[a, k])
            if ok.any():
                self.lists.add(members[a[ok]] * self.per + k, s[ok], ids[b[ok]])


def walk(rows: Rows, anchors: Rows, clusters: Clusters, collect: Positives | Negatives) -> int:
    """Let all anchors meet the rows of a block, cluster by cluster; returns how many scores were computed."""
    if not len(rows.ids):
        return 0
    exact = rows.norms.max() * anchors.norms.max(initial=0) < 2.0**52
    cosine = np.clip(_units(rows) @ clusters.centres.T, -1, 1)
    bounds = rows.norms[:, None] * np.cos(np.maximum(0, np.arccos(cosine) - clusters.widest[None, :]))
    computed = 0
    for c, members in enumerate(clusters.members):
        order = np.argsort(-bounds[:, c], kind="stable")
        sorted_bounds = bounds[order, c]
        at, step = 0, STEP
        while at < len(order):
            best = sorted_bounds[at] * anchors.norms[members]
            members = members[best + 1e-6 * np.abs(best) + 1e-3 >= collect.need(members)]
            if not len(members):
                break
            some = order[at : at + step]
            left, right = anchors.vectors[members], rows.vectors[some]
            scores = (left @ right.T).astype(np.int64) if exact else left.astype(np.int64) @ right.astype(np.int64).T
            computed += scores.size
            collect.meet(members, scores, rows.ids[some], rows.labels[some])
            at, step = at + step, min(2 * step, 16 * STEP)
    return computed


def _searched(rows: DataFrame, anchors: Rows, width: int, clusters: Clusters, positives: np.ndarray | None, size: int, window: tuple[int, int]) -> DataFrame:
    """``anchor, nth, id, score``: what each task has in its lists, of a block of anchors."""
    sent = rows.sparkSession.sparkContext.broadcast((anchors, clusters, positives))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine, groups, found = sent.value
        collect = Positives(mine, size) if found is None else Negatives(mine, found, size, window)
        for batch in batches:
            walk(matrix(batch, width), mine, groups, collect)
        per = 1 if found is None else found.shape[1]
        at, place = np.nonzero(collect.lists.scores != _NONE)
        for k in range(0, len(at), 100_000):
            a, p = at[k : k + 100_000], place[k : k + 100_000]
            columns = [(a // per).astype(np.int32), (a % per).astype(np.int32), collect.lists.ids[a, p], collect.lists.scores[a, p]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["anchor", "nth", "id", "score"])

    out = rows.mapInArrow(search, "anchor int, nth int, id long, score long")
    ranked = Window.partitionBy("anchor", "nth").orderBy(F.desc("score"), "id")
    return out.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= size)


def mined(
    rows: DataFrame,
    anchor: Column,
    n_positives: int = POSITIVES,
    n_negatives: int = NEGATIVES,
    window: tuple[int, int] = WINDOW,
    anchor_block: int = ANCHOR_BLOCK,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the ``usable`` rows that the
    condition ``anchor`` picks.

    Positives are an anchor's best rows of its label with another id; negatives are, for each positive, the best rows of
    other labels with a score inside the window. Scores are exact while they fit a long. Anchors without positives, and
    positives without negatives, have no rows. Several rows may share an id; each is a row of its own.
    """
    spark: SparkSession = rows.sparkSession
    rows = stored(rows)
    told = rows.agg(F.max(F.size("vector")).alias("width"), F.count_if(anchor).alias("anchors")).first()
    width = told.width or 0
    blocks = -(-told.anchors // anchor_block)
    if not blocks:
        return spark.createDataFrame([], RESULT)
    picked = stored(rows.where(anchor).withColumn("block", F.pmod(F.xxhash64("vec_id", "vector"), F.lit(blocks))))
    home = f"{shared_folder(spark)}/hard-negatives-{uuid4().hex}"
    for block in range(blocks):
        some = matrix(picked.where(F.col("block") == block).orderBy("vec_id", "label", "vector").toArrow(), width)
        if not len(some.ids):
            continue
        clusters = clustered(some)
        found = _searched(rows, some, width, clusters, None, n_positives, window).toArrow()
        scores = np.full((len(some.ids), n_positives), _NONE, np.int64)
        ids = np.full((len(some.ids), n_positives), _LAST, np.int64)
        a, k = found.column("anchor").to_numpy(), found.column("rank").to_numpy() - 1
        scores[a, k], ids[a, k] = found.column("score").to_numpy(), found.column("id").to_numpy()
        a, k = np.nonzero(scores != _NONE)
        names = ["anchor", "nth", "anchor_id", "positive_id", "positive_score"]
        pairs = pa.table([a.astype(np.int32), k.astype(np.int32), some.ids[a], ids[a, k], scores[a, k]], names)  # n_positives a row at most
        met = _searched(rows, some, width, clusters, scores, n_negatives, window).join(F.broadcast(spark.createDataFrame(pairs)), ["anchor", "nth"])
        met = met.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
        met.write.parquet(f"{home}/block={block}")
    return spark.read.schema(f"{RESULT}, block int").parquet(home).drop("block")
