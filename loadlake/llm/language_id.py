"""Language identification by a bidirectional gated recurrent network over bytes, trained here with numpy.

The network reads a word's bytes forwards and backwards (its state does not cross white space) and labels every byte
with language probabilities; a document's probabilities pool the labels of all its bytes. Since a word's labels depend on
the word only, each different word of a task is run once; long words are run in parts of ``PART`` bytes.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadlake.llm.common import struct

#: Training words: about DOCS documents per language at most, WORDS words of each, drawn from the whole text.
DOCS = 400
WORDS = 60
HIDDEN = 16
PART = 24
EPOCHS = 8
BATCH = 256
RATE = 0.01
#: The pooled evidence counts for at most so many bytes, so that scores stay below certainty.
SURE_AFTER = 60.0
KNOWN_WORDS = 250_000
UNKNOWN = "und"
_LETTER = re.compile(rb"[A-Za-z]")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def parts_of(word: bytes) -> list[bytes]:
    return [word] if len(word) <= PART else [word[i : i + PART] for i in range(0, len(word), PART)]


class Network:
    """Gated recurrent units in both directions and one softmax layer per position.

    Parameters: for each direction input weights by byte, recurrent weights and bias of the three gates (update, reset,
    candidate); then output weights and bias.
    """

    def __init__(self, classes: int, hidden: int = HIDDEN, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.hidden = hidden
        self.p = {}
        for d in "fb":
            self.p[f"x{d}"] = rng.normal(0, 0.3, (256, 3 * hidden)).astype(np.float32)
            self.p[f"h{d}"] = rng.normal(0, hidden**-0.5, (hidden, 3 * hidden)).astype(np.float32)
            self.p[f"c{d}"] = np.zeros(3 * hidden, np.float32)
        self.p["o"] = rng.normal(0, 0.3, (2 * hidden, classes)).astype(np.float32)
        self.p["q"] = np.zeros(classes, np.float32)

    def _run(self, data: np.ndarray, d: str, keep: bool) -> tuple[np.ndarray, list]:
        """States after each position, in text order; with ``keep``, also what the way back needs."""
        n, steps = data.shape
        k = self.hidden
        wx, wh, c = self.p[f"x{d}"] + self.p[f"c{d}"], self.p[f"h{d}"], k * 2
        state = np.zeros((n, k), np.float32)
        states = np.empty((steps, n, k), np.float32)
        trace = []
        for t in range(steps) if d == "f" else reversed(range(steps)):
            seen = wx[data[:, t]]
            gates = 1 / (1 + np.exp(-(seen[:, :c] + state @ wh[:, :c])))
            z, r = gates[:, :k], gates[:, k:]
            candidate = np.tanh(seen[:, c:] + (r * state) @ wh[:, c:])
            new = z * state + (1 - z) * candidate
            if keep:
                trace.append((t, state, z, r, candidate))
            state = new
            states[t] = new
        return states, trace

    def log_labels(self, data: np.ndarray) -> np.ndarray:
        """Log probabilities [position, word, class] of words of one length."""
        both = np.concatenate([self._run(data, "f", False)[0], self._run(data, "b", False)[0]], axis=2)
        return _log_softmax(both @ self.p["o"] + self.p["q"])

    def gradient(self, data: np.ndarray, labels: np.ndarray, weights: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Weighted loss of all positions, and its gradient by backpropagation through time."""
        k, c = self.hidden, self.hidden * 2
        forward, traces = {}, {}
        for d in "fb":
            forward[d], traces[d] = self._run(data, d, True)
        both = np.concatenate([forward["f"], forward["b"]], axis=2)
        logs = _log_softmax(both @ self.p["o"] + self.p["q"])
        rows = np.arange(len(labels))
        share = weights / (weights.sum() * data.shape[1])
        loss = float(-(logs[:, rows, labels] * share).sum())
        error = np.exp(logs)
        error[:, rows, labels] -= 1
        error *= share[None, :, None]
        g = {"o": np.einsum("tnk,tnc->kc", both, error), "q": error.sum(axis=(0, 1))}
        back = error @ self.p["o"].T
        for i, d in enumerate("fb"):
            wh = self.p[f"h{d}"]
            gx, gh = np.zeros_like(self.p[f"x{d}"]), np.zeros_like(wh)
            gc = np.zeros(3 * k, np.float32)
            carried = np.zeros((len(data), k), np.float32)
            for t, state, z, r, candidate in reversed(traces[d]):
                at = carried + back[t, :, i * k : (i + 1) * k]
                e_c = at * (1 - z) * (1 - candidate**2)
                e_rs = e_c @ wh[:, c:].T
                e_z = at * (state - candidate) * z * (1 - z)
                e_r = e_rs * state * r * (1 - r)
                e_zr = np.concatenate([e_z, e_r], axis=1)
                every = np.concatenate([e_zr, e_c], axis=1)
                np.add.at(gx, data[:, t], every)
                gc += every.sum(axis=0)
                gh[:, :c] += state.T @ e_zr
                gh[:, c:] += (r * state).T @ e_c
                carried = at * z + e_rs * r + e_zr @ wh[:, :c].T
            g |= {f"x{d}": gx, f"h{d}": gh, f"c{d}": gc}
        return loss, g


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(axis=-1, keepdims=True)
    return x - np.log(np.exp(x).sum(axis=-1, keepdims=True))


def by_length(words: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places and bytes of the words of each length."""
    sizes = np.array([len(w) for w in words])
    for n in np.unique(sizes[sizes > 0]):
        at = np.flatnonzero(sizes == n)
        yield at, np.frombuffer(b"".join(words[i] for i in at), np.uint8).reshape(-1, n)


def train(words: list[bytes], labels: np.ndarray, weights: np.ndarray, classes: int, epochs: int = EPOCHS, seed: int = 7) -> Network:
    """Adam on batches of words of one length."""
    net = Network(classes, seed=seed)
    rng = np.random.default_rng(seed)
    groups = list(by_length(words))
    first = {k: np.zeros_like(v) for k, v in net.p.items()}
    second = {k: np.zeros_like(v) for k, v in net.p.items()}
    step = 0
    for epoch in range(epochs):
        rate = RATE * (1 - epoch / epochs) + 1e-3
        batches = []
        for g, (at, _) in enumerate(groups):
            order = rng.permutation(len(at))
            batches += [(g, order[i : i + BATCH]) for i in range(0, len(at), BATCH)]
        for b in rng.permutation(len(batches)):
            g, some = batches[b]
            at, data = groups[g]
            _, gradient = net.gradient(data[some], labels[at[some]], weights[at[some]])
            step += 1
            for k, value in gradient.items():
                first[k] += 0.1 * (value - first[k])
                second[k] += 0.001 * (value * value - second[k])
                net.p[k] -= (rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
    return net


def fit(docs: DataFrame, limit: int = DOCS, words: int = WORDS) -> tuple[list[str], Network | None]:
    """Languages and network, from documents with a language outside the held-out quarter.

    Documents are drawn by a hash of their id, up to about ``limit`` per language; ``words`` words are drawn from the
    whole text of each. So the training table is bounded by the number of languages. No languages: no network.
    """
    known = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull())
    known = known.where(~held_out(F.col("doc_id"))).select("doc_id", "text", "lang")
    sizes = {r.lang: r.n for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        return [], None
    parts = [(lang, int(min(1.0, limit / n) * (1 << 20))) for lang, n in sizes.items()]
    shares = docs.sparkSession.createDataFrame(parts, "lang string, share int")
    chosen = known.join(F.broadcast(shares), "lang").where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.col("share"))

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, langs = [], []
            for seed, text, lang in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                found = text.split()
                if found:
                    rng = np.random.default_rng(seed)
                    some = [p for i in rng.integers(0, len(found), words) for p in parts_of(found[i])[:1]]
                    out += some
                    langs += [lang] * len(some)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary()), pa.array(langs, pa.string())], ["word", "lang"])

    seeds = F.crc32(F.col("doc_id").cast("string")).alias("seed")
    drawn = chosen.select(seeds, F.col("text").cast("binary"), "lang").mapInArrow(draw, "word binary, lang string")
    table = drawn.groupBy("word", "lang").agg(F.count(F.lit(1)).alias("n")).toPandas().sort_values(["word", "lang"])
    langs = sorted(sizes)
    labels = table.lang.map({x: i for i, x in enumerate(langs)}).to_numpy()
    weights = np.minimum(table.n.to_numpy(), 200).astype(np.float32)
    per_class = np.bincount(labels, weights, minlength=len(langs))
    weights = weights / np.maximum(per_class, 1)[labels].astype(np.float32) * np.float32(len(table) / len(langs))
    return langs, train([bytes(w) for w in table.word], labels, weights, len(langs))


class Labeller:
    """Pooled evidence of texts, with the evidence of known words kept (``KNOWN_WORDS`` at most)."""

    def __init__(self, net: Network, classes: int):
        self.net, self.classes = net, classes
        self._clear()

    def _clear(self) -> None:
        self.number: defaultdict[bytes, int] = defaultdict()
        self.number.default_factory = self.number.__len__
        self.words: list[bytes] = []
        self.sums = np.zeros((0, self.classes + 1), np.float32)

    def evidence(self, texts: list[bytes]) -> np.ndarray:
        """For each text, log probabilities summed over its bytes, and the number of these bytes."""
        if len(self.number) > KNOWN_WORDS:
            self._clear()
        before = len(self.number)
        rows = [np.fromiter(map(self.number.__getitem__, words), np.int64, len(words)) for words in (t.split() for t in texts)]
        new = list(self.number)[before:] if len(self.number) > before else []
        if new:
            self.sums = np.concatenate([self.sums, self._of_words(new)])
        return np.array([self.sums[r].sum(axis=0, dtype=np.float64) for r in rows]).reshape(len(texts), -1)

    def _of_words(self, words: list[bytes]) -> np.ndarray:
        parts, owner = [], []
        for i, word in enumerate(words):
            for part in parts_of(word):
                parts.append(part)
                owner.append(i)
        out = np.zeros((len(words), self.classes + 1), np.float32)
        owner = np.array(owner)
        for at, data in by_length(parts):
            for k in range(0, len(at), 8192):
                some = at[k : k + 8192]
                labels = self.net.log_labels(data[k : k + 8192]).sum(axis=0)
                np.add.at(out, owner[some], np.concatenate([labels, np.full((len(some), 1), data.shape[1], np.float32)], axis=1))
        return out


def has_letter(text: bytes | None) -> bool:
    if not text:
        return False
    return bool(_LETTER.search(text)) or any(map(str.isalpha, text.decode("utf-8", "replace")))


def predicted(docs: DataFrame, langs: list[str], net: Network | None) -> DataFrame:
    """The documents with ``language``: a struct of ``lang`` and ``score``.

    Null texts and texts without letters are ``und`` with score 0; so is every text where nothing was learned.
    """
    sent = docs.sparkSession.sparkContext.broadcast(net.p if net else None)
    classes, hidden = len(langs), net.hidden if net else 0

    @F.pandas_udf(struct(lang=T.StringType(), score=T.DoubleType()))
    def label(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        labeller = None
        if sent.value is not None:
            own = Network(classes, hidden)
            own.p = sent.value
            labeller = Labeller(own, classes)
        for texts in batches:
            lang, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
            at = [i for i, t in enumerate(texts) if labeller and has_letter(t)]
            for k in range(0, len(at), 200):
                some = at[k : k + 200]
                found = labeller.evidence([texts.iloc[i] for i in some])
                n = np.maximum(found[:, -1:], 1)
                logs = found[:, :-1] / n * np.minimum(n, SURE_AFTER)
                odds = np.exp(_log_softmax(logs))
                best = odds.argmax(axis=1)
                for i, j, p in zip(some, best, odds.max(axis=1), strict=True):
                    lang[i], score[i] = langs[j], p
            yield pd.DataFrame({"lang": lang, "score": score})

    return docs.withColumn("language", label(F.col("text").cast("binary")))
