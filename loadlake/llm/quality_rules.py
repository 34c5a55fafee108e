"""Document quality by weak supervision: rules vote, their reliability is estimated, votes become a probability.

Each rule says good, bad or nothing about a document. The vote patterns of all documents are counted (3 to the power of
the number of rules at most), and expectation-maximisation on these counts estimates how often each rule casts each vote
for good and for bad documents. The posterior of a pattern is then a sum of weights, evaluated in the same plan.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlake.llm.common import BLANKS, struct

WINDOW = 5
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
SYMBOLS = b"#*$%&|<>"
KEEP_FROM = 0.5

MEASURES = (
    "n_words",
    "word_chars",
    "n_symbols",
    "n_dup_lines",
    "n_repeat_words",
    "n_lines",
    "n_upper",
    "n_letters",
    "n_shouts",
    "n_distinct",
    "n_marks",
    "n_symbol_lines",
)
_IS_BLANK = np.zeros(256, bool)
_IS_BLANK[list(BLANKS)] = True
_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True
_IS_MARK = np.array([33 <= b < 127 and not chr(b).isalnum() for b in range(256)])
_MIX = np.array([pow(0x9E3779B97F4A7C15, i + 1, 1 << 64) | 1 for i in range(WINDOW)], np.uint64)


def repeated_words(codes: np.ndarray, window: int = WINDOW) -> int:
    """Number of words inside a window of words that stands in the text twice or more, its first place included."""
    n = len(codes) - window + 1
    if n < 2:
        return 0
    mixed = np.zeros(n, np.uint64)
    for i in range(window):
        mixed += codes[i : i + n] * _MIX[i]
    mixed ^= mixed >> np.uint64(29)
    ordered = np.sort(mixed)
    again = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(again):
        return 0
    again = np.unique(again)
    at = np.searchsorted(again, mixed)
    starts = np.flatnonzero(again[np.minimum(at, len(again) - 1)] == mixed)
    change = np.zeros(len(codes) + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + window, -1)
    return int((np.cumsum(change[:-1]) > 0).sum())


def measure(text: bytes | None) -> tuple[int, ...]:
    """The counts in ``MEASURES`` for one UTF-8 text; all 0 for null or no text."""
    if not text:
        return (0,) * len(MEASURES)
    words = text.split()
    raw = np.frombuffer(text, np.uint8)
    counts = np.bincount(raw, minlength=256)
    continuation = int(counts[128:192].sum())
    blanks = int(counts[_IS_BLANK].sum())
    upper = int(counts[65:91].sum())
    letters = upper + int(counts[97:123].sum()) + int(counts[192:].sum())
    lines = text.split(b"\n")
    with_words = [line for line in lines if line.strip(BLANKS)]
    codes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    return (
        len(words),
        len(text) - continuation - blanks,
        int(counts[_IS_SYMBOL].sum()),
        len(with_words) - len(set(with_words)),
        repeated_words(codes),
        len(with_words),
        upper,
        letters,
        int(counts[ord("!")]),
        len(set(words)),
        int(counts[_IS_MARK].sum()),
        sum(len(line) - len(line.translate(None, SYMBOLS)) >= 3 for line in with_words),
    )


@F.pandas_udf(struct(**{name: T.LongType() for name in MEASURES}))
def measures(texts: pd.Series) -> pd.DataFrame:
    rows = np.array([measure(t) for t in texts], np.int64).reshape(-1, len(MEASURES))
    return pd.DataFrame(rows, columns=list(MEASURES))


def base_failed(m: Column) -> Column:
    few = m["n_words"] < MIN_WORDS
    return few | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, F.lit(-1)).when(good, F.lit(1)).otherwise(F.lit(0))


def rules(m: Column) -> dict[str, Column]:
    """Votes by name: 1 good, -1 bad, 0 abstains. Ratios are compared as products, so that nothing is divided by 0."""
    words, letters = m["n_words"], m["n_letters"]
    return {
        "symbols": _vote(10 * m["n_symbols"] > words, 200 * m["n_symbols"] <= words),
        "marks": _vote(5 * m["n_marks"] > m["word_chars"], 100 * m["n_marks"] <= 12 * m["word_chars"]),
        "symbol_lines": _vote(2 * m["n_symbol_lines"] > m["n_lines"], 10 * m["n_symbol_lines"] <= m["n_lines"]),
        "repetition": _vote(100 * m["n_repeat_words"] > 25 * words, 100 * m["n_repeat_words"] <= 2 * words),
        "lines": _vote(100 * m["n_dup_lines"] > 30 * m["n_lines"], (m["n_dup_lines"] == 0) & (m["n_lines"] > 1)),
        "capitals": _vote(100 * m["n_upper"] > 35 * letters, 100 * m["n_upper"] <= 15 * letters),
        "shouting": _vote(10 * m["n_shouts"] > words, 50 * m["n_shouts"] <= words),
        "word_length": _vote(
            (m["word_chars"] > 14 * words) | (10 * m["word_chars"] < 25 * words), m["word_chars"].between(3 * words, 10 * words)
        ),
        "variety": _vote((words >= 40) & (100 * m["n_distinct"] < 12 * words), 100 * m["n_distinct"] >= 30 * words),
        "length": _vote(words < MIN_WORDS, words >= 30),
    }


@dataclass(frozen=True)
class VoteModel:
    """Share of good documents, and P(vote | class) by rule: rows bad and good, columns votes -1, 0 and 1."""

    prior: float
    tables: dict[str, np.ndarray]

    def accuracy(self, rule: str) -> float:
        """Probability that the rule is right when it votes, over both classes."""
        t = self.tables[rule]
        right = (1 - self.prior) * t[0, 0] + self.prior * t[1, 2]
        wrong = (1 - self.prior) * t[0, 2] + self.prior * t[1, 0]
        return float(right / (right + wrong))

    def log_odds(self, votes: dict[str, Column]) -> Column:
        total = F.lit(math.log(self.prior / (1 - self.prior)))
        for name, t in self.tables.items():
            w = np.log(t[1] / t[0])
            total = total + F.when(votes[name] < 0, float(w[0])).when(votes[name] > 0, float(w[2])).otherwise(float(w[1]))
        return total


def fit(patterns: np.ndarray, counts: np.ndarray, names: list[str], rounds: int = 200, strength: float = 0.5) -> VoteModel:
    """Expectation-maximisation over counted vote patterns.

    It starts from the belief that a rule seldom says bad of a good document, while a bad document breaks one rule or
    few. A Dirichlet prior of that form, which weighs ``strength`` of the documents (1 at least), keeps the meaning of
    the classes. Without documents the start values are the model.
    """
    start = np.array([[0.25, 0.25, 0.5], [0.01, 0.25, 0.74]])
    total = counts.sum()
    weight = max(1.0, strength * total)
    tables = np.repeat(start[None], len(names), axis=0)
    prior = 0.8
    seen = np.stack([patterns == v for v in (-1, 0, 1)], axis=-1).astype(float)  # pattern, rule, vote
    for _ in range(rounds if total else 0):
        logs = np.log(tables)
        odds = math.log(prior / (1 - prior)) + np.einsum("prv,rv->p", seen, logs[:, 1] - logs[:, 0])
        good = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
        by_class = np.stack([counts * (1 - good), counts * good])
        of_class = weight * np.array([0.2, 0.8])[None, :, None] * start[None]
        votes = np.einsum("cp,prv->rcv", by_class, seen) + of_class
        new = votes / votes.sum(axis=2, keepdims=True)
        prior = float((by_class[1].sum() + 0.8 * weight) / (total + weight))
        moved = np.abs(new - tables).max()
        tables = new
        if moved < 1e-9:
            break
    return VoteModel(prior, dict(zip(names, tables, strict=True)))


def fit_votes(measured: DataFrame) -> VoteModel:
    """The model of a table with a struct ``measured``; what reaches the driver is one row per vote pattern."""
    votes = rules(F.col("measured"))
    names = list(votes)
    rows = measured.select(*[v.alias(n) for n, v in votes.items()]).groupBy(*names).count().collect()
    rows.sort()
    patterns = np.array([r[:-1] for r in rows], int).reshape(-1, len(names))
    return fit(patterns, np.array([r[-1] for r in rows], float), names)


def judged(docs: DataFrame) -> DataFrame:
    """The documents with ``measured``, ``base_failed``, ``quality`` (posterior probability) and ``kept``.

    Null and empty texts have no words and fail. Columns of these names in the input are replaced.
    """
    own = ("measured", "base_failed", "quality", "kept")
    docs = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c not in own])
    measured = docs.withColumn("measured", measures(F.col("text").cast("binary")))
    model = fit_votes(docs.select(measures(F.col("text").cast("binary")).alias("measured")))
    m = F.col("measured")
    quality = 1 / (1 + F.exp(-model.log_odds(rules(m))))
    return measured.withColumns({"base_failed": base_failed(m), "quality": quality}).withColumn(
        "kept", ~F.col("base_failed") & (F.col("quality") >= KEEP_FROM)
    )
