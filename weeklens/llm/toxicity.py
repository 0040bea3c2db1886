"""Toxicity scores: averaged subword embeddings under a linear softmax, trained jointly."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weeklens.llm.common import fold_of, written

SHORTEST, LONGEST = 3, 6
CACHED_WORDS = 300_000


@dataclass(frozen=True)
class ToxicConfig:
    """``rows`` of either class and ``max_chars`` bound the labelled sample that the model is fitted on."""

    rows: int = 1800
    max_chars: int = 60_000
    features: int = 60_000
    dim: int = 4
    epochs: int = 30
    batch: int = 64
    rate: float = 100.0
    head_rate: float = 0.05
    pooled_scale: float = 30.0
    seed: int = 7


def subwords(word: str) -> list[str]:
    """The word between marks and its character n-grams."""
    marked = f"<{word}>"
    grams = [marked[i : i + n] for n in range(SHORTEST, LONGEST + 1) for i in range(len(marked) - n + 1)]
    return [*grams, f"={marked}"]


def sample(
    docs: DataFrame, labels: DataFrame, label: str, per_class: int, max_chars: int, folds: int = 5
) -> tuple[list[str], np.ndarray, float]:
    """Texts and labels of at most ``per_class`` ids of either class, the first by a hash, and the share of label 1.

    Only labelled rows outside the held-out fold may be learned from. Several labels of one id count as the largest; null
    labels and null ids are left out. Of each id one text is learned, that of the smallest hash among its texts of at most
    ``max_chars`` characters, however often its rows repeat. The choice is made on ids, sizes and hashes alone, and only the
    chosen texts reach the driver, ``2 * per_class * max_chars`` characters at most. The share is counted over all rows.
    """
    given = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & (fold_of("doc_id", folds) != 0))
    given = given.groupBy("doc_id").agg(F.max(label).cast("int").alias("y")).where("y in (0, 1)")
    chars = F.coalesce(F.length("text"), F.lit(0))
    text_hash = F.xxhash64(F.coalesce("text", F.lit("")))
    sizes = docs.select("doc_id", F.when(chars <= max_chars, text_hash).alias("t"))
    by_id = sizes.groupBy("doc_id").agg(F.count("*").alias("n"), F.min("t").alias("t"))
    by_id = written(by_id.join(given, "doc_id").withColumn("h", F.xxhash64("doc_id")), "labelled")
    counts = {r["y"]: r["n"] for r in by_id.groupBy("y").agg(F.sum("n").alias("n")).collect()}
    fits = by_id.where(F.col("t").isNotNull())
    picks = [fits.where(F.col("y") == y).orderBy("h", "doc_id").limit(per_class) for y in (0, 1)]
    chosen = picks[0].union(picks[1]).select("doc_id", "t", "y")
    texts = docs.where(chars <= max_chars).select("doc_id", F.coalesce("text", F.lit("")).alias("text"), text_hash.alias("t"))
    got = texts.join(F.broadcast(chosen), ["doc_id", "t"]).groupBy("doc_id").agg(F.min("text").alias("text"), F.first("y").alias("y"))
    frame = got.toPandas().sort_values(["doc_id", "text"])
    share = (counts.get(1, 0) + 1) / (sum(counts.values()) + 2)
    return list(frame["text"]), frame["y"].to_numpy(np.int64), share


@dataclass
class ToxicModel:
    """``weights``: for each n-gram its embedding seen through the difference of the two softmax columns."""

    weights: dict[str, float]
    bias: float


def _bags(texts: list[str], features: int) -> tuple[list[str], list[tuple[np.ndarray, np.ndarray]]]:
    """The n-grams that are in most words of most documents, and for each text their numbers and shares."""
    counts = [Counter(t.lower().split()) for t in texts]
    in_docs = Counter(w for words in counts for w in words)
    total: Counter = Counter()
    for word, docs in in_docs.items():
        for gram in subwords(word):
            total[gram] += docs
    kept = [g for g, _ in sorted(total.items(), key=lambda x: (-x[1], x[0]))[:features]]
    number = {g: i for i, g in enumerate(kept)}
    own = {w: np.array([number[g] for g in subwords(w) if g in number], np.int32) for w in in_docs}
    rows = []
    for words in counts:
        if not words:
            rows.append((np.zeros(0, np.int32), np.zeros(0, np.float32)))
            continue
        grams = [own[w] for w in words]
        times = np.repeat(list(words.values()), [len(g) for g in grams])
        sums = np.bincount(np.concatenate(grams), times, len(kept))
        at = np.flatnonzero(sums)
        rows.append((at.astype(np.int32), (sums[at] / max(1.0, sums.sum())).astype(np.float32)))
    return kept, rows


def fit(texts: list[str], y: np.ndarray, share: float, config: ToxicConfig) -> ToxicModel:
    """Embeddings and softmax trained together: plain stochastic gradients for the embeddings, so that rare n-grams stay
    near their start, and steps scaled by past gradients for the softmax.

    Both classes weigh the same in training; afterwards the bias is moved to the share of label 1 among all rows.
    """
    prior = float(np.log(share / (1 - share)))
    if len(set(y.tolist())) < 2:
        return ToxicModel({}, prior)
    kept, rows = _bags(texts, config.features)
    rng = np.random.default_rng(config.seed)
    size, dim = len(kept), config.dim
    embed = rng.normal(0, 0.1, (size, dim))
    soft, bias = rng.normal(0, 0.5, (dim, 2)), np.zeros(2)
    past = [np.full_like(x, 1e-6) for x in (soft, bias)]
    weight = len(y) / 2 / np.bincount(y, minlength=2)
    for epoch in range(config.epochs):
        rate = config.rate * (1 - epoch / config.epochs)
        shuffled = rng.permutation(len(rows))
        for start in range(0, len(rows), config.batch):
            chosen = shuffled[start : start + config.batch]
            at = np.concatenate([rows[i][0] for i in chosen])
            part = np.concatenate([rows[i][1] for i in chosen]) * config.pooled_scale
            row = np.repeat(np.arange(len(chosen)), [len(rows[i][0]) for i in chosen])
            near = embed[at]
            mean = np.stack([np.bincount(row, near[:, d] * part, len(chosen)) for d in range(dim)], axis=1)
            logits = mean @ soft + bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(chosen)), y[chosen]] -= 1
            p *= (weight[y[chosen]] / len(chosen))[:, None]
            back = p @ soft.T
            for value, grad, square in zip((soft, bias), (mean.T @ p, p.sum(axis=0)), past):
                square += grad * grad
                value -= config.head_rate * grad / np.sqrt(square)
            for d in range(dim):
                embed[:, d] -= rate * np.bincount(at, part * back[row, d], size)
    seen_through = embed @ (soft[:, 1] - soft[:, 0]) * config.pooled_scale
    return ToxicModel(dict(zip(kept, seen_through.tolist())), float(bias[1] - bias[0] + prior))


class _Words(dict):
    """For a word the sum of its n-grams' weights and, as the imaginary part, how many n-grams are known."""

    def __init__(self, weights: dict[str, float]):
        super().__init__()
        self.weights = weights

    def __missing__(self, word: str) -> complex:
        known = [self.weights[g] for g in subwords(word) if g in self.weights]
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = out = complex(sum(known), len(known))
        return out


def score_texts(model: ToxicModel, batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    words = _Words(model.weights)
    for texts in batches:
        sums = [sum(map(words.__getitem__, (t or "").lower().split()), 0j) for t in texts]
        logit = np.array([s.real / max(1.0, s.imag) for s in sums], np.float64) + model.bias
        yield pd.Series(1 / (1 + np.exp(-np.clip(logit, -500, 500))))


def train(docs: DataFrame, labels: DataFrame, config: ToxicConfig = ToxicConfig(), label: str = "toxic") -> ToxicModel:
    texts, y, share = sample(docs, labels, label, config.rows, config.max_chars)
    return fit(texts, y, share, config)


def scored(docs: DataFrame, model: ToxicModel, threshold: float = 0.5) -> DataFrame:
    """``docs`` with held_out, score and predicted, which replace columns of these names.

    The text alone decides. A null or blank text, and one without any known n-gram, scores the share of label 1. Without
    labels of both classes every text does. Extra columns pass through.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf(T.DoubleType())
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        yield from score_texts(sent.value, batches)

    return docs.withColumns({"held_out": fold_of() == 0, "score": score("text")}).withColumn(
        "predicted", (F.col("score") >= threshold).cast("int")
    )
