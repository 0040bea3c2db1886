import numpy as np

from weeklens.llm import weak_rules


def test_estimates_follow_a_corpus_of_mostly_junk(spark):
    rng = np.random.default_rng(0)
    good = rng.random(6000) < 0.2
    rates = {True: (0.05, 0.25, 0.70), False: (0.55, 0.30, 0.15)}
    votes = [[int(rng.choice([-1, 0, 1], p=rates[bool(g)])) for _ in range(8)] for g in good]
    model = weak_rules.estimate(spark.createDataFrame(votes, ", ".join(f"v{i} int" for i in range(8))))
    assert abs(model.prior - 0.2) < 0.05
