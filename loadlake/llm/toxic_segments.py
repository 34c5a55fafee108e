"""Toxicity by maximum-scoring segments.

Every word has log-odds of standing in toxic documents, with a Dirichlet prior in proportion to the words' overall
frequency and of half a document in each class at least. Words with significant log-odds score these, within limits, less a
small step; toxic ones have to be clear. All others score the step. What is significant and clear is chosen on a part of the
labelled documents that the words were not counted in, and so is the logistic curve. A linear scan then finds all maximal
scoring segments of a text, each passage that cannot be extended or joined with a gain. Their scores are put on the
extreme-value scale of the best segment that harmless text of the same length would show by chance; what all significant
segments add up to becomes the document's probability by a logistic curve fitted to the labels.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import repeat

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlake.llm.common import stored, struct
from loadlake.llm.decontamination import words_of

#: About so many labelled documents are fitted on at most, drawn by hash of doc_id; fewer labels are all used.
LABELLED = 20_000
#: What to choose from: standard errors that a word's log-odds have to exceed, and the least log-odds of toxic words.
CHOICES = ((3.0, 3.0), (2.0, 3.0), (1.8, 4.0))
#: A part of the labelled documents, one in so many, is kept for these choices.
CHOICE_PART = 5
#: Words of more bytes than this are also known by their beginning, so that unseen endings count.
STEM = 5
PRIOR_DOCUMENTS = 50.0
GAP = -0.12
TOP_SCORE = 8.0
LOW_SCORE = -0.2
#: A passage is significant if harmless text of the length would have fewer than exp(-this) of its score.
SIGNIFICANT = 3.0


@dataclass(frozen=True)
class ToxicModel:
    """Word scores; ``decay`` and ``scale`` of the extreme-value law of best segments; the logistic curve."""

    scores: dict[bytes, float] = field(repr=False)
    decay: float
    scale: float
    slope: float
    offset: float

    def surprise(self, score: float, words: int) -> float:
        """Minus the logarithm of the expected number of segments of this score in harmless text of this length."""
        return self.decay * score - math.log(max(self.scale * words, 1e-9))


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments ``(first, end, score)``, in one pass with a stack of candidates."""
    found: list[list[float]] = []  # first, end, total before, total after
    total = 0.0
    at = np.flatnonzero(scores > 0)
    sums = np.r_[0.0, np.cumsum(scores)]
    for i in at.tolist():
        total = float(sums[i])
        candidate = [i, i + 1, total, float(sums[i + 1])]
        while found:
            k = len(found) - 1
            while k >= 0 and found[k][2] >= candidate[2]:
                k -= 1
            if k < 0 or found[k][3] >= candidate[3]:
                break
            candidate = [found[k][0], candidate[1], found[k][2], candidate[3]]
            del found[k:]
        found.append(candidate)
    return [(int(a), int(b), right - left) for a, b, left, right in found]


def stem(word: bytes) -> bytes | None:
    return word[:STEM] + b"-" if len(word) > STEM else None


def scores_of(words: list[bytes], known: dict[bytes, float]) -> np.ndarray:
    """Each word's score, or else that of its beginning, or else the common one."""
    values = np.fromiter(map(known.get, words, repeat(GAP)), float, len(words))
    stems = np.fromiter(map(known.get, [w[:STEM] + b"-" for w in words], repeat(GAP)), float, len(words))
    long = np.fromiter(map(len, words), np.int64, len(words)) > STEM
    return np.where((values == GAP) & long, stems, values)


def passages(text: bytes | None, model: ToxicModel) -> tuple[float, list[tuple[int, int, float]]]:
    """Evidence of a text, and its significant segments as words ``(first, end, surprise)``.

    Evidence is the sum over significant segments; without any, that of the best one (negative). No words: as one word.
    """
    words = words_of(text)
    n = max(1, len(words))
    scores = scores_of(words, model.scores)
    if not len(words) or not (scores > 0).any():
        return model.surprise(0.0, n), []
    found = [(a, b, model.surprise(s, n)) for a, b, s in maximal_segments(scores)]
    good = [x for x in found if x[2] > SIGNIFICANT]
    return (sum(x[2] for x in good) if good else max(x[2] for x in found)), good


def labelled(docs: DataFrame, labels: DataFrame, limit: int = LABELLED) -> DataFrame:
    """``text, toxic, choice`` of labelled documents outside the held-out fifth, about ``limit`` of them at most.

    The list of chosen ids is broadcast, as ``limit`` bounds it; of contradictory labels of a document, toxic holds.
    """
    ids = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    ids = stored(ids.where(~held_out(F.col("doc_id"))))
    share = min(1.0, limit / max(1, ids.count()))
    chosen = ids.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    choice = F.pmod(F.xxhash64("doc_id", F.lit("choice")), F.lit(CHOICE_PART)) == 0
    met = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return met.select("text", F.col("toxic").cast("int").alias("toxic"), choice.alias("choice"))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def log_odds(y1: Column, y0: Column, n1: float, n0: float) -> tuple[Column, Column]:
    """Log-odds of a word that stands in y1 of n1 toxic and y0 of n0 other documents, and their standard error.

    Documents without the word have a prior of their own, so a word that stands in all of them is no exception.
    """
    prior = F.greatest(F.lit(0.5), PRIOR_DOCUMENTS * (y1 + y0) / (n1 + n0))
    rest = F.greatest(F.lit(0.5), PRIOR_DOCUMENTS - prior)
    a, b = y1 + prior, y0 + prior
    odds = F.log(a / (n1 - y1 + rest)) - F.log(b / (n0 - y0 + rest))
    return odds, F.sqrt(1 / a + 1 / b)


def _lexicon(rows: list, odds: str, error: str, count: str, choice: tuple[float, float]) -> tuple[dict[bytes, float], dict[float, float]]:
    """Scores of words, and how many harmless documents have words of each score."""
    scores, share = {}, {}
    for r in rows:
        if abs(r[odds]) > choice[0] * r[error] and not 0 < r[odds] < choice[1]:
            score = min(TOP_SCORE, max(LOW_SCORE, r[odds])) + GAP
            scores[bytes(r.word)] = score
            share[score] = share.get(score, 0.0) + r[count] + 0.5
    return scores, share


def _law(scores: dict[bytes, float], share: dict[float, float], n: np.ndarray, best: np.ndarray) -> ToxicModel:
    """The extreme-value law of harmless texts, from their numbers of words and the scores of their best segments."""
    some = n > 0
    n, best = n[some], best[some]
    decay = _decay(share, float(n.sum()) if len(n) else 1.0)
    level = float((decay * best - np.log(n)).mean()) if len(n) else 0.0
    return ToxicModel(scores, decay, max(math.exp(min(50.0, level - 0.5772156649015329)), 1e-12), 0.0, 0.0)


def _best_segments(sample: DataFrame, lexicons: list[dict[bytes, float]]) -> tuple[np.ndarray, np.ndarray]:
    """Words of each text, and the score of its best segment by each lexicon."""

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, found = [], []
            for text in batch.column(0).to_pylist():
                words = words_of(text)
                sizes.append(len(words))
                found.append([max((x for _, _, x in maximal_segments(scores_of(words, known))), default=0.0) for known in lexicons])
            yield pa.RecordBatch.from_arrays([pa.array(sizes, pa.int64()), pa.array(found, pa.list_(pa.float64()))], ["n", "best"])

    rows = sample.select("text").mapInArrow(best, "n long, best array<double>").collect()
    return np.array([r.n for r in rows], np.int64), np.array([r.best for r in rows], float).reshape(len(rows), len(lexicons))


def _evidence(sample: DataFrame, models: list[ToxicModel]) -> tuple[np.ndarray, np.ndarray]:
    """Labels of the texts, and their evidence by each model."""

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def evidence(texts: pd.Series) -> pd.Series:
        return pd.Series([[passages(t, m)[0] for m in models] for t in texts], dtype=object)

    rows = sample.select(evidence("text").alias("x"), "toxic").collect()
    return np.array([r.toxic for r in rows], float), np.array([r.x for r in rows], float).reshape(len(rows), len(models))


def fit(docs: DataFrame, labels: DataFrame, limit: int = LABELLED) -> ToxicModel:
    """Word scores, extreme-value law and logistic curve from labelled documents; without labels, scores near 0.

    What comes to the driver are words with significant log-odds and one row per labelled document, of the bounded sample.
    """
    sample = labelled(docs, labels, limit).select(F.col("text").cast("binary").alias("text"), "toxic", "choice")
    sample = stored(sample)

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, rows = [], []
            for i, text in enumerate(batch.column(0).to_pylist()):
                own = set(words_of(text))
                own |= {s for w in own if (s := stem(w))}
                out += own
                rows += [i] * len(own)
            at = pa.array(rows, pa.int64())
            columns = [pa.array(out, pa.binary()), batch.column(1).take(at), batch.column(2).take(at)]
            yield pa.RecordBatch.from_arrays(columns, ["word", "toxic", "choice"])

    sizes = {(r.toxic, r.choice): r.n for r in sample.groupBy("toxic", "choice").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = (float(sizes.get((k, False), 0) + sizes.get((k, True), 0)) for k in (1, 0))
    if not n1 or not n0:
        return ToxicModel({}, 1.0, 1.0, 0.0, math.log((n1 + 0.5) / (n0 + 0.5)) if n1 or n0 else -3.0)
    apart = len(sizes) == 4  # both kinds of labels in both parts; else the words are chosen where they are counted
    counted = ~F.col("choice") if apart else F.lit(True)
    m1, m0 = (float(sizes[k, False]) if apart else n for k, n in ((1, n1), (0, n0)))
    toxic = F.col("toxic") == 1
    counts = sample.mapInArrow(words, "word binary, toxic int, choice boolean").groupBy("word")
    sums = {"y1": toxic, "y0": ~toxic, "x1": toxic & counted, "x0": ~toxic & counted}
    counts = counts.agg(*[F.count_if(c).cast("double").alias(name) for name, c in sums.items()])
    all_odds, all_error = log_odds(F.col("y1"), F.col("y0"), n1, n0)
    part_odds, part_error = log_odds(F.col("x1"), F.col("x0"), m1, m0)
    rows = counts.select("word", "y0", "x0", all_odds.alias("odds"), all_error.alias("error"), part_odds.alias("part_odds"), part_error.alias("part_error"))
    least = min(e for e, _ in CHOICES)
    rows = rows.where((F.abs("odds") > least * F.col("error")) | (F.abs("part_odds") > least * F.col("part_error"))).collect()

    lexicons = [_lexicon(rows, "part_odds", "part_error", "x0", c) for c in CHOICES]
    n, best = _best_segments(sample.where(counted & ~toxic), [scores for scores, _ in lexicons])
    models = [_law(scores, share, n, best[:, k]) for k, (scores, share) in enumerate(lexicons)]
    y, x = _evidence(sample.where("choice") if apart else sample, models)
    curves = [_logistic(x[:, k], y) for k in range(len(CHOICES))]
    losses = [float(np.logaddexp(0, np.where(y == 1, -1, 1) * (slope * x[:, k] + offset)).sum()) for k, (slope, offset) in enumerate(curves)]
    k = int(np.argmin(losses))
    scores, share = _lexicon(rows, "odds", "error", "y0", CHOICES[k])
    n, best = _best_segments(sample.where(~toxic), [scores])
    model = _law(scores, share, n, best[:, 0])
    return ToxicModel(scores, model.decay, model.scale, *curves[k])


def _decay(share: dict[float, float], words: float) -> float:
    """The positive root of sum p(s) exp(root s) = 1 over the scores of harmless words."""
    values = np.array([GAP, *share])
    p = np.array([0.0, *share.values()]) / words
    p[0] = max(1e-9, 1 - p[1:].sum())
    if (p * values).sum() >= 0:  # no negative drift: scores say nothing about harmless text
        return 0.05
    low, high = 1e-6, 50.0
    for _ in range(200):
        mid = (low + high) / 2
        if (p * np.exp(np.minimum(mid * values, 700))).sum() > 1:
            high = mid
        else:
            low = mid
    return low


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[float, float]:
    """Slope and offset by Newton steps; the slope is not negative."""
    centre, width = float(x.mean()), float(x.std()) or 1.0
    u = np.clip((x - centre) / width, -10, 10)
    w = np.array([1.0, 0.0])
    design = np.stack([u, np.ones_like(u)], axis=1)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -30, 30)))
        gradient = design.T @ (p - y) + ridge * w
        hessian = (design * (p * (1 - p))[:, None]).T @ design + ridge * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    slope = max(0.0, float(w[0])) / width
    return slope, float(w[1]) - slope * centre


def scored(docs: DataFrame, model: ToxicModel) -> DataFrame:
    """The documents with ``toxicity``: a struct of ``score`` (0 to 1) and ``passages`` (first word, end, surprise).

    Null and empty texts get the score of a text without evidence.
    """
    sent = docs.sparkSession.sparkContext.broadcast((model.scores, model.decay, model.scale, model.slope, model.offset))
    span = struct(first=T.IntegerType(), end=T.IntegerType(), surprise=T.DoubleType())

    @F.pandas_udf(struct(score=T.DoubleType(), passages=T.ArrayType(span)))
    def score(texts: pd.Series) -> pd.DataFrame:
        own = ToxicModel(*sent.value)
        rows = [passages(t, own) for t in texts]
        x = np.array([r[0] for r in rows])
        return pd.DataFrame(
            {
                "score": 1 / (1 + np.exp(-np.clip(own.slope * x + own.offset, -500, 500))),
                "passages": [[{"first": a, "end": b, "surprise": s} for a, b, s in r[1]] for r in rows],
            }
        )

    return docs.withColumn("toxicity", score(F.col("text").cast("binary")))
