import numpy as np
import pyarrow as pa

from weeklens.llm import gru, recurrent_lm


def test_networks_trained_together_know_nothing_of_one_another(monkeypatch):
    """Each comes out as if trained alone: uneven texts, one text only, none; classes with many and with few targets."""
    monkeypatch.setattr(gru, "F32", np.float64)
    shape = gru.Shape(words=40, tails=3, per_class=9, hidden=5)
    rng = np.random.default_rng(3)
    fresh = [{k: v.astype(np.float64) for k, v in gru.fresh(shape, np.arange(43), seed).items()} for seed in range(4)]
    rounds = [
        [[np.minimum(rng.geometric(0.08, n), 42).astype(np.int32) for n in sizes] for sizes in part]
        for part in (((700, 30, 1, 45), (9,), (), (60,) * 9), ((20,) * 5, (), (33, 2), (1,)))
    ]
    alone, together = ([{k: v.copy() for k, v in net.items()} for net in fresh] for _ in range(2))
    pasts, joint = [None] * 4, [None] * 4
    for texts in rounds:
        pasts = [gru.train(net, shape, own, 6, 8, 0.2, past) for net, own, past in zip(alone, texts, pasts)]
        joint = gru.train_together(together, shape, texts, 6, 8, 0.2, joint)
    for a, b in zip(alone + pasts, together + joint):
        assert all(np.allclose(a[k], b[k], rtol=1e-10, atol=1e-12) for k in a)
    assert not np.allclose(together[0]["turn"], fresh[0]["turn"])


def test_words_of_a_batch_are_those_of_each_text():
    texts = [None, "", " \n\t ", "  A b\x0bB ", "Ünd z y\x1c\x85x\r\n", "one", "a " * 3000]
    lex = recurrent_lm.Lexicon(
        gru.Shape(3, 4), pa.array([b"a", b"\n", b"b", b"one"], pa.binary()), np.array([0, 1, 2, 5], np.int32), np.ones(4), 9, 4, np.ones(4), np.ones(7)
    )
    for most in (1, 12, 1 << 20):
        runs = list(recurrent_lm._runs(pa.array(texts, pa.string()), most))
        assert [t for run in runs for t in run.to_pylist()] == texts
        read = [recurrent_lm._read(lex, run) for run in runs]
        assert [w for r in read for w in r.words.to_pylist()] == [w for t in texts for w in recurrent_lm.tokens(t)[:-1]]
        assert [len(n) for r in read for n in r.texts()] == [len(recurrent_lm.tokens(t)) for t in texts]
        numbers = {b"a": 0, b"\n": 1, b"b": 2, b"one": 5}
        for t, found in zip(texts, [n for r in read for n in r.texts()]):
            known = [numbers.get(w) for w in recurrent_lm.tokens(t)]
            assert all(n == k if k is not None else n >= 3 for n, k in zip(found.tolist(), known))
