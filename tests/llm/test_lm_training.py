import math

import numpy as np
import pytest

from weeklens.llm import recurrent_lm


@pytest.mark.parametrize("tokens", [10_000, 100_000_000])
def test_every_document_trains_once_at_every_size(docs_of, monkeypatch, tmp_path, tokens):
    """Whatever the corpus size that the lexicon names, the rounds see each training row once."""
    docs = docs_of([(i, f"only{i} word") for i in range(300)])
    config = recurrent_lm.LmConfig()
    counts = recurrent_lm.word_counts(docs)
    lex = recurrent_lm.lexicon(counts, config)
    lex.total = tokens
    seen = []

    def kept(df, name):
        if name != "nets":
            return df
        rows = df.toPandas()
        seen.append(int(rows["tokens"].sum()))
        return df.sparkSession.createDataFrame(rows, recurrent_lm._PART)

    monkeypatch.setattr(recurrent_lm, "written", kept)
    recurrent_lm.train_network(docs, lex, config)
    assert sum(seen) == 300 * 3


def test_scores_do_not_depend_on_partitions(spark, docs_of):
    texts = [f"the {w} sat on the {v} and {w} was {v}" for w in ("cat", "dog", "owl", "fox") for v in ("mat", "log", "hut")]
    docs = docs_of([(i, texts[i % 12] + f" {i % 5}") for i in range(120)] + [(500, "the same row")] * 40)
    config = recurrent_lm.LmConfig(part_tokens=300)
    runs = [recurrent_lm.scored(docs.repartition(n), config).select("doc_id", "n_tokens", "base_score", "score").collect() for n in (1, 8)]
    assert sorted(map(tuple, runs[0])) == sorted(map(tuple, runs[1]))


def test_copies_of_a_row_are_dealt_apart(docs_of):
    docs = docs_of([(1, "one row")] * 200 + [(2, "another")])
    rows = recurrent_lm._dealt(docs).collect()
    assert len(rows) == 201 and len({r["h"] for r in rows}) == 201


def plain_log10(net, lex, counts, text):
    """The network's word probabilities one token after the other; a word of a tail class by its count in the class."""
    shape, h = lex.shape, lex.shape.hidden
    numbers = recurrent_lm._numbers(lex, text)
    sigmoid = lambda v: 1 / (1 + np.exp(-v))
    softmax = lambda v: np.exp(v - v.max()) / np.exp(v - v.max()).sum()
    state, total, read = np.zeros(h), 0.0, shape.begin
    for word, number in zip(recurrent_lm.tokens(text), numbers):
        x, u = net["read"][read].astype(float), state @ net["turn"].astype(float)
        if read == shape.begin:
            state = np.zeros(h)
            u = np.zeros(3 * h)
        gates = sigmoid(x[: 2 * h] + u[: 2 * h])
        r, z = gates[:h], gates[h:]
        state = (1 - z) * np.tanh(x[2 * h :] + r * u[2 * h :]) + z * state
        kind = int(shape.class_of(np.array([number]))[0])
        total += math.log10(softmax(state @ net["class_w"] + net["class_b"])[kind])
        if number < shape.words:
            own = slice(kind * shape.per_class, min(shape.words, (kind + 1) * shape.per_class))
            total += math.log10(softmax(net["word_w"][own] @ state + net["word_b"][own])[number - own.start])
        else:
            total += math.log10(counts.get(word, 0) + 1) - lex.class_mass[number - shape.words]
        read = number
    return total


def test_scores_are_the_sum_over_tokens(docs_of):
    words = [f"w{i}" for i in range(60)]
    docs = docs_of([(i, " ".join(words[(i * k) % 60] for k in range(1, 5 + i % 30))) for i in range(80)] + [(200, None), (201, "Never seen")])
    config = recurrent_lm.LmConfig(words=20, tails=3, sent=30, part_tokens=500)
    training = docs.where(recurrent_lm.fold_of("doc_id", config.folds) != config.held_out).select("doc_id", "text")
    table = recurrent_lm.word_counts(training)
    lex = recurrent_lm.lexicon(table, config)
    net = recurrent_lm.train_network(training, lex, config)
    counts = {bytes(r["word"]): r["n"] for r in table.collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in recurrent_lm.scored(docs, config).collect():
        assert r["score"] == pytest.approx(plain_log10(net, lex, counts, texts[r["doc_id"]]), rel=1e-4), r["doc_id"]
