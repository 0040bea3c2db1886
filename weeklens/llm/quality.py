"""Quality classifier: random-indexing word vectors pooled per document, a two-layer network, calibrated by temperature."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq
from zlib import crc32

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weeklens.llm.common import fold_of
from weeklens.llm.toxicity import sample

THRESHOLD = 0.3
CACHED_WORDS = 100_000
_RUNS = re.compile(r"[^\W\d_]+|\d+")
_PARTS = re.compile(r"Aa|.", re.DOTALL)
LONG_SHAPE = 40
_BLOCK = 1 << 15
AGAIN = "<again>"


@dataclass(frozen=True)
class QualityConfig:
    """``rows`` of either class and ``max_chars`` bound the labelled sample that the model is fitted on."""

    rows: int = 1500
    max_chars: int = 60_000
    dim: int = 48
    ones: int = 6
    reach: int = 2
    least_count: int = 5
    hidden: int = 32
    epochs: int = 60
    batch: int = 64
    rate: float = 3e-3
    seed: int = 11


def index_vector(unit: str, dim: int, ones: int) -> np.ndarray:
    """The unit's fixed sparse vector of +1 and -1, drawn from a hash of it."""
    rng = np.random.default_rng(crc32(unit.encode()))
    out = np.zeros(dim, np.float32)
    out[rng.choice(dim, ones, replace=False)] = rng.choice(np.array([-1, 1], np.float32), ones)
    return out


def _kind(run: re.Match) -> str:
    found = run[0]
    return "0" if found[0].isdigit() else "a" if found.islower() else "A" if found.isupper() else "Aa"


def units(word: str) -> tuple[str, str]:
    """A word's letters in lower case, and its shape: runs of letters and digits by kind, other characters as they are.

    Of a shape longer than ``LONG_SHAPE`` the distinct parts stay, in the order in which they come first.
    """
    if word.isalpha():
        return word.lower(), "#a" if word.islower() else "#A" if word.isupper() else "#Aa"
    shape = _RUNS.sub(_kind, word)
    if len(shape) > LONG_SHAPE:
        shape = "".join(dict.fromkeys(_PARTS.findall(shape)))
    return "".join(c for c in word if c.isalpha()).lower(), "#" + shape


def repeats(words: list[str]) -> int:
    """How many words equal the word before them."""
    return sum(map(eq, words[1:], words))


@dataclass
class QualityModel:
    vectors: dict[str, np.ndarray]
    again: np.ndarray
    shift: np.ndarray
    scale: np.ndarray
    layers: tuple[np.ndarray, np.ndarray, np.ndarray, float] | None
    temperature: float
    prior: float


def word_vectors(texts: list[list[str]], config: QualityConfig) -> dict[str, np.ndarray]:
    """Random indexing: a unit's vector is the sum of the index vectors of itself and of the units around it.

    Letters and shape of a word are units of their own, and each takes the letters and shapes of its neighbours in. The
    sums are scaled to length 1. Units that are rarer than ``least_count`` have no vector.
    """
    in_text = Counter(w for words in texts for w in words)
    parts = {w: units(w) for w in in_text}
    counts: Counter = Counter()
    for w, n in in_text.items():
        for u in parts[w]:
            counts[u] += n
    kept = [u for u, n in counts.items() if n >= config.least_count]
    number = {u: i + 1 for i, u in enumerate(kept)}
    index = np.zeros((len(kept) + 1, config.dim), np.float32)
    for u, i in number.items():
        index[i] = index_vector(u, config.dim, config.ones)
    total = index.copy()
    both = {w: tuple(number.get(u, 0) for u in us) for w, us in parts.items()}
    for words in texts:
        pair = np.array([both[w] for w in words], np.int64).reshape(-1, 2)
        around = np.zeros((len(words), config.dim), np.float32)
        own = index[pair].sum(axis=1)
        for step in range(1, config.reach + 1):
            around[step:] += own[:-step]
            around[:-step] += own[step:]
        for side in range(2):
            order = np.argsort(pair[:, side], kind="stable")
            ids, first = np.unique(pair[order, side], return_index=True)
            if len(ids):
                total[ids] += np.add.reduceat(around[order], first, axis=0)
    total[0] = 0
    total /= np.maximum(np.linalg.norm(total, axis=1, keepdims=True), 1e-9)
    return {u: total[i] for u, i in number.items()}


class _Rows(dict):
    """Row of a word in ``table``, a growing table of word vectors (letters and shape added)."""

    def __init__(self, vectors: dict[str, np.ndarray], dim: int):
        super().__init__()
        self.vectors, self.none = vectors, np.zeros(dim, np.float32)
        self.table = np.zeros((1024, dim), np.float32)

    def __missing__(self, word: str) -> int:
        row = len(self)
        if row == len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        letters, shape = units(word)
        self.table[row] = self.vectors.get(letters, self.none) + self.vectors.get(shape, self.none)
        self[word] = row
        return row


def pooled(rows: _Rows, again: np.ndarray, text: str | None) -> np.ndarray:
    """Mean of the word vectors of the whole text, the share of words said twice in a row, and the log of the length."""
    words = (text or "").split()
    total = np.zeros(rows.table.shape[1], np.float64)
    for start in range(0, len(words), _BLOCK):
        if len(rows) > CACHED_WORDS:
            rows.clear()
        part = words[start : start + _BLOCK]
        at = np.fromiter(map(rows.__getitem__, part), np.int64, len(part))
        total += rows.table[at].sum(axis=0)
    n = max(1, len(words))
    return np.concatenate([(total + repeats(words) * again) / n, [repeats(words) / n, np.log1p(len(words))]])


def _logits(model: QualityModel, x: np.ndarray) -> np.ndarray:
    w1, b1, w2, b2 = model.layers
    return np.tanh((x - model.shift) / model.scale @ w1 + b1) @ w2 + b2


def fit(texts: list[str], y: np.ndarray, share: float, config: QualityConfig) -> QualityModel:
    """Word vectors, then the network by Adam on four fifths of the sample, then the temperature on the last fifth.

    Classes weigh the same in training; the scores are then moved to the share of label 1 among all rows.
    """
    prior = float(np.log(share / (1 - share)))
    again = index_vector(AGAIN, config.dim, config.ones)
    if len(set(y.tolist())) < 2:
        return QualityModel({}, again, np.zeros(1), np.ones(1), None, 1.0, prior)
    vectors = word_vectors([t.split() for t in texts], config)
    rows = _Rows(vectors, config.dim)
    x = np.stack([pooled(rows, again, t) for t in texts])
    rng = np.random.default_rng(config.seed)
    order = rng.permutation(len(y))
    held, used = order[: len(y) // 5], order[len(y) // 5 :]
    if len(set(y[used].tolist())) < 2 or len(set(y[held].tolist())) < 2:
        held = used = order
    model = QualityModel(vectors, again, x[used].mean(axis=0), x[used].std(axis=0) + 1e-6, None, 1.0, prior)
    scaled = (x - model.shift) / model.scale
    w = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], config.hidden)), np.zeros(config.hidden), rng.normal(0, 1 / np.sqrt(config.hidden), config.hidden), np.zeros(1)]
    first, second, step = [np.zeros_like(v) for v in w], [np.zeros_like(v) for v in w], 0
    weight = len(used) / 2 / np.maximum(1, np.bincount(y[used], minlength=2))
    for _ in range(config.epochs):
        shuffled = rng.permutation(used)
        for start in range(0, len(shuffled), config.batch):
            b = shuffled[start : start + config.batch]
            hidden = np.tanh(scaled[b] @ w[0] + w[1])
            p = 1 / (1 + np.exp(-(hidden @ w[2] + w[3])))
            d = (p - y[b]) * weight[y[b]] / len(b)
            dh = d[:, None] * w[2] * (1 - hidden**2)
            grads = [scaled[b].T @ dh + 1e-4 * w[0], dh.sum(axis=0), hidden.T @ d + 1e-4 * w[2], np.array([d.sum()])]
            step += 1
            for v, g, m, s in zip(w, grads, first, second):
                m += 0.1 * (g - m)
                s += 0.001 * (g * g - s)
                v -= config.rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    model.layers = (w[0], w[1], w[2], float(w[3][0]))
    z, t = _logits(model, x[held]), y[held]
    each = np.where(t == 1, 1 / max(1, (t == 1).sum()), 1 / max(1, (t == 0).sum()))

    def loss(temperature: float) -> float:
        return float((each * np.logaddexp(0, np.where(t == 1, -z, z) / temperature)).sum())

    model.temperature = min(np.geomspace(0.25, 8, 61).tolist(), key=loss)
    return model


def score_texts(model: QualityModel, batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    rows = _Rows(model.vectors, len(model.again))
    for texts in batches:
        if model.layers is None or not len(texts):
            logit = np.zeros(len(texts))
        else:
            logit = _logits(model, np.stack([pooled(rows, model.again, t) for t in texts])) / model.temperature
        yield pd.Series(1 / (1 + np.exp(-np.clip(logit + model.prior, -500, 500))))


def train(docs: DataFrame, labels: DataFrame, config: QualityConfig = QualityConfig()) -> QualityModel:
    texts, y, share = sample(docs, labels, "quality", config.rows, config.max_chars)
    return fit(texts, y, share, config)


def score_column(spark: SparkSession, model: QualityModel, text: str = "text") -> Column:
    sent = spark.sparkContext.broadcast(model)

    @F.pandas_udf(T.DoubleType())
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        yield from score_texts(sent.value, batches)

    return score(text)


def scored(docs: DataFrame, model: QualityModel, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with held_out, score and predicted, which replace columns of these names; the text alone decides, read whole.

    A null or blank text is scored as a text of no words. Without labels of both classes every text scores the share of
    label 1. Repeated rows are scored alike, and extra columns pass through.
    """
    return docs.withColumns({"held_out": fold_of() == 0, "score": score_column(docs.sparkSession, model)}).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )


def good_documents(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score at least the threshold, with the columns they came with, whatever their names.

    Null, blank and empty texts score as texts of no words; rows that repeat one another go or stay together.
    """
    return docs.where(score_column(docs.sparkSession, train(docs, labels)) >= threshold)
