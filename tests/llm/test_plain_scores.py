"""Scores of the trained classifiers against a plain forward pass over every text."""

import math

import numpy as np
import pytest

from weeklens.llm import quality, toxicity

GOOD = ["the river runs past the old mill and the town", "a letter came from the sea, with news of the ships"] * 15
BAD = ["you stupid fool!! stupid stupid", "fool fool you moron!! 123 !!", "moron!!! xX99 you stup1d fool"] * 10
LABELS = np.array([0] * len(GOOD) + [1] * len(BAD))


def sigmoid(v):
    return 1 / (1 + math.exp(-max(-500.0, min(500.0, v))))


@pytest.fixture(scope="module")
def texts(odd_docs):
    odd = [r["text"] for r in odd_docs.collect()]
    return list(enumerate(odd + GOOD[:3] + BAD[:4] + ["unseen ZZTOP words 777", "a" * 300, "é ß !? 1a"]))


def test_toxicity_scores(docs_of, texts):
    model = toxicity.fit(GOOD + BAD, LABELS, 0.3, toxicity.ToxicConfig(epochs=6))
    assert model.weights
    want = {}
    for i, text in texts:
        total, known = 0.0, 0
        for word in (text or "").lower().split():
            marked = f"<{word}>"
            for gram in [marked[a:b] for a in range(len(marked)) for b in range(a + toxicity.SHORTEST, min(len(marked), a + toxicity.LONGEST) + 1)] + [f"={marked}"]:
                if gram in model.weights:
                    total, known = total + model.weights[gram], known + 1
        want[i] = sigmoid(total / max(1, known) + model.bias)
    for r in toxicity.scored(docs_of(texts), model).collect():
        assert r["score"] == pytest.approx(want[r["doc_id"]], abs=1e-9)
        assert r["predicted"] == int(r["score"] >= 0.5)


def test_quality_scores(docs_of, texts):
    config = quality.QualityConfig(epochs=10, least_count=2)
    model = quality.fit(GOOD + BAD, LABELS, 0.4, config)
    w1, b1, w2, b2 = model.layers
    none = np.zeros(config.dim)
    want = {}
    for i, text in texts:
        words, total, again = (text or "").split(), np.zeros(config.dim), 0
        for k, word in enumerate(words):
            total += sum((model.vectors.get(u, none) for u in quality.units(word)), none)
            if k and word == words[k - 1]:
                total, again = total + model.again, again + 1
        n = max(1, len(words))
        x = (np.array([*(total / n), again / n, math.log1p(len(words))]) - model.shift) / model.scale
        hidden = [math.tanh(sum(x[j] * w1[j, h] for j in range(len(x))) + b1[h]) for h in range(config.hidden)]
        logit = sum(v * w for v, w in zip(hidden, w2)) + b2
        want[i] = sigmoid(logit / model.temperature + model.prior)
    for r in quality.scored(docs_of(texts), model).collect():
        assert r["score"] == pytest.approx(want[r["doc_id"]], abs=1e-4)
        assert r["predicted"] == int(r["score"] >= quality.THRESHOLD)


def test_word_vectors_are_sums_of_index_vectors():
    config = quality.QualityConfig(least_count=1, reach=2)
    lists = [["Red", "fox", "99", "fox"], ["fox"]]
    got = quality.word_vectors(lists, config)
    total = {u: quality.index_vector(u, config.dim, config.ones).astype(float) for words in lists for w in words for u in quality.units(w)}
    own = {u: v.copy() for u, v in total.items()}
    for words in lists:
        for i, word in enumerate(words):
            for j in range(max(0, i - 2), min(len(words), i + 3)):
                if j != i:
                    for u in quality.units(word):
                        total[u] += sum(own[v] for v in quality.units(words[j]))
    for u, v in total.items():
        assert got[u] == pytest.approx(v / max(np.linalg.norm(v), 1e-9), abs=1e-5), u
