import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from weeklens.llm import gru, quality, recurrent_lm, toxicity, weak_rules

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts_of(text):
    words = WORD.findall(text or "")
    at = {}
    for i in range(len(words) - 2):
        at.setdefault(tuple(words[i : i + 3]), []).append(i)
    hit = {p for v in at.values() if len(v) > 1 for i in v for p in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    return (len(words), sum(map(len, words)), sum(c in weak_rules.SYMBOLS for c in text or ""), len(lines) - len(set(lines)), len(hit))


def test_counts_equal_a_plain_loop(docs_of, odd_docs, no_docs):
    texts = ["a b c a b c", "a a a a", "a a a", "x\nx\n\n y\n y\nx", "é # | é # | \x0b end", "a b c d a b c a b", "1 2 3 1 2 3 1 2 3 4"]
    docs = docs_of(list(enumerate(texts, 100))).union(odd_docs)
    want = sorted((str(r["doc_id"]), *counts_of(r["text"])) for r in docs.select("doc_id", "text").collect())
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    rows = weak_rules.judged(docs).collect()
    assert sorted((str(r["doc_id"]), *(r[n] for n in names)) for r in rows) == want
    for r in rows:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert not (r["kept"] and r["base_failed"])
    assert weak_rules.judged(no_docs).count() == 0


def test_estimates_find_known_rates(spark):
    rng = np.random.default_rng(0)
    good = rng.random(6000) < 0.8
    rates = {True: (0.05, 0.25, 0.70), False: (0.55, 0.30, 0.15)}
    votes = [[int(rng.choice([-1, 0, 1], p=rates[bool(g)])) for _ in range(8)] for g in good]
    frame = spark.createDataFrame(votes, ", ".join(f"v{i} int" for i in range(8)))
    model = weak_rules.estimate(frame)
    assert abs(model.prior - 0.8) < 0.05
    assert all(abs(g[2] - 0.70) < 0.08 for g in model.on_good) and all(abs(b[0] - 0.55) < 0.12 for b in model.on_bad)
    assert all(model.accuracy(i) > 0.8 for i in range(8))


def test_no_python_on_the_way(odd_docs):
    for frame in (weak_rules.judged(odd_docs), weak_rules.features(odd_docs)):
        plan = frame._jdf.queryExecution().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


@pytest.fixture(scope="module")
def tables(spark):
    return spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")


def test_rules_and_labels_agree(tables):
    docs, labels = tables
    rows = weak_rules.judged(docs).join(labels, "doc_id").where("not base_failed").groupBy("quality", "kept").count().collect()
    right = sum(r["count"] for r in rows if r["kept"] == (r["quality"] == 1))
    assert right / sum(r["count"] for r in rows) > 0.97


def test_quality_on_held_out_rows(tables, odd_docs, no_docs):
    docs, labels = tables
    model = quality.train(docs, labels)
    rows = quality.scored(docs, model).where("held_out").join(labels, "doc_id").collect()
    assert sum(r["predicted"] == r["quality"] for r in rows) / len(rows) > 0.97
    again = quality.scored(odd_docs, model).collect()
    assert len(again) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in again)
    assert quality.scored(no_docs, model).count() == 0
    none = quality.train(no_docs, labels)
    assert {r["score"] for r in quality.scored(odd_docs, none).collect()} == {0.5}
    kept = quality.good_documents(docs, labels)
    assert kept.columns == docs.columns and kept.count() < docs.count()


def test_quality_sees_no_ids(tables):
    """Rows whose other columns are changed score as before."""
    docs, labels = tables
    model = quality.train(docs, labels)
    changed = docs.selectExpr("doc_id + 1000000 as doc_id", "text", "'xx' as lang", "'yy' as source", "0L as n_chars")
    one = sorted(r["score"] for r in quality.scored(docs, model).collect())
    assert one == sorted(r["score"] for r in quality.scored(changed, model).collect())


def test_toxicity_of_unseen_spellings(odd_docs, no_docs, docs_of, spark):
    fill = "the man went to the house and sat in the sun for a day with his old dog near the wide river "
    bad = ["rotten", "filthy", "stinker", "vermin"]
    rows = [(i, fill * (i % 3 + 1) + (f"{bad[i % 4]} {bad[(i + 1) % 4]} " if i % 2 else "") + f"n{i}") for i in range(400)]
    docs = docs_of(rows)
    labels = spark.createDataFrame([(i, 1, i % 2) for i in range(400)], "doc_id bigint, quality int, toxic int")
    model = toxicity.train(docs, labels)
    held = toxicity.scored(docs, model).where("held_out").collect()
    assert len(held) > 40 and all(r["predicted"] == r["doc_id"] % 2 for r in held)
    odd = docs_of([(1, fill + "rottenn filthyy"), (2, fill + "garden window")])
    spelt, other = (r["score"] for r in toxicity.scored(odd, model).orderBy("doc_id").collect())
    assert spelt > other
    assert all(0 <= r["score"] <= 1 for r in toxicity.scored(odd_docs, model).collect())
    assert toxicity.scored(no_docs, model).count() == 0
    assert {r["score"] for r in toxicity.scored(odd_docs, toxicity.train(no_docs, labels)).collect()} == {0.5}


def test_gru_gradients_equal_differences():
    shape = gru.Shape(words=7, tails=2, per_class=3, hidden=4)
    rng = np.random.default_rng(2)
    net = {k: v.astype(np.float64) + rng.normal(0, 0.3, v.shape) for k, v in gru.fresh(shape, np.arange(9), 1).items()}
    texts = [np.array(rng.integers(0, 9, n), np.int32) for n in (5, 3)]
    gru_f32, gru.F32 = gru.F32, np.float64
    try:
        loss = lambda: -gru.log_likelihood(net, shape, texts, width=2, window=8).sum()
        before = {k: v.copy() for k, v in net.items()}
        past = {k: np.zeros_like(v) + 1e-30 for k, v in net.items()}
        copy = {k: v.copy() for k, v in net.items()}
        after = gru.train(copy, shape, texts, 2, 8, 0.0, past)
        for name in net:
            for at in list(np.ndindex(net[name].shape))[::5]:
                net[name][at] = before[name][at] + 1e-5
                up = loss()
                net[name][at] = before[name][at] - 1e-5
                down = loss()
                net[name][at] = before[name][at]
                slope = (up - down) / 2e-5 / 8  # training divides by the tokens of the window
                assert math.isclose(math.sqrt(after[name][at]), abs(slope), rel_tol=1e-3, abs_tol=1e-6), (name, at)
    finally:
        gru.F32 = gru_f32


def test_gru_carries_state_over_windows_and_sums_to_one():
    shape = gru.Shape(words=6, tails=2, per_class=3, hidden=5)
    net = gru.fresh(shape, np.arange(8) * 3, 4)
    rng = np.random.default_rng(0)
    net["class_w"] += rng.normal(0, 1, net["class_w"].shape).astype(np.float32)
    net["word_w"] += rng.normal(0, 1, net["word_w"].shape).astype(np.float32)
    texts = [np.array(rng.integers(0, 8, n), np.int32) for n in (40, 1, 17, 33, 2)]
    whole = gru.log_likelihood(net, shape, texts, width=5, window=64)
    assert np.allclose(whole, gru.log_likelihood(net, shape, texts, width=2, window=3), atol=1e-4)
    uneven = [*texts * 8, np.array(rng.integers(0, 8, 3000), np.int32)]
    one_by_one = np.concatenate([gru.log_likelihood(net, shape, [t], 1, 16) for t in uneven])
    assert np.allclose(gru.log_likelihood(net, shape, uneven, width=64, window=32), one_by_one, rtol=1e-4, atol=1e-3)
    prefix = texts[2]
    ends = [np.append(prefix, np.int32(i)) for i in range(8)]
    rest = gru.log_likelihood(net, shape, ends, 8, 16) - gru.log_likelihood(net, shape, [prefix], 1, 16)
    assert abs(np.exp(rest).sum() - 1) < 1e-4


def test_lm_counts_and_scores(tables, odd_docs, no_docs):
    docs, _ = tables
    config = recurrent_lm.LmConfig(sent=3000)  # so that most words meet their counts by the join
    rows = {r["doc_id"]: r for r in recurrent_lm.scored(docs, config).collect()}
    lower = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    words = {r["doc_id"]: WORD.findall(lower(r["text"])) + ["\n"] for r in docs.select("doc_id", "text").collect()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in words}
    seen = Counter(w for i, ws in words.items() if not held[i] for w in ws)
    n, v = sum(seen.values()), len(seen)
    for i, ws in words.items():
        r = rows[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (held[i], len(ws), sum(w in seen for w in ws), n)
        assert math.isclose(r["base_score"], sum(math.log10((seen[w] + 1) / (n + v + 1)) for w in ws), rel_tol=1e-9)
        assert r["score"] < 0
    out = [r for r in rows.values() if r["held_out"]]
    assert sum(r["score"] for r in out) > sum(r["base_score"] for r in out)
    odd = recurrent_lm.scored(odd_docs).collect()
    assert len(odd) == odd_docs.count() and all(r["n_tokens"] == 1 for r in odd if r["doc_id"] in (1, 2, 3))
    assert recurrent_lm.scored(no_docs).count() == 0


def test_held_out_texts_change_no_counts(docs_of):
    """Scores of the other rows are the same whatever a held-out row says."""
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    rows = [(i, f"some words {i % 3} here") for i in range(30) if i != held]
    one, two = (
        {r["doc_id"]: (r["base_score"], r["score"]) for r in recurrent_lm.scored(docs_of([*rows, (held, text)])).collect() if r["doc_id"] != held}
        for text in ("quite different things", "some words")
    )
    assert one == two
