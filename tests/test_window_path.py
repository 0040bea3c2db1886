import numpy as np
import pytest

from weeklens.config import WindowConfig
from weeklens.operators import split, window_model

CONFIG = WindowConfig(window=4)


def plain_windows(series, n_train):
    """(x, y) of training and validation windows of min-max scaled series."""
    out = {"train": ([], []), "val": ([], [])}
    for name, values in series.items():
        v = np.array(values, float)[: n_train[name][1]]
        cut = n_train[name][0]
        spread = v[:cut].max() - v[:cut].min() or 1.0
        v = (v - v[:cut].min()) / spread
        for t in range(CONFIG.window, len(v)):
            x, y = out["train" if t < cut else "val"]
            x.append(v[t - CONFIG.window : t])
            y.append(v[t])
    return {k: (np.array(x), np.array(y)) for k, (x, y) in out.items()}


@pytest.fixture(scope="module")
def case(make_weekly):
    rng = np.random.default_rng(8)
    series = {f"A__{i}": (50 + 20 * np.sin(np.arange(60) / 3) + rng.normal(0, 4, 60)).tolist() for i in range(4)}
    series |= {"B__short": [1, 2, 3, 4, 5], "B__tiny": list(range(20)), "B__flat": [7] * 40}
    labelled = split.temporal_split(make_weekly(series))
    sizes = {r["series_id"]: (r["n_train"], r["n_train"] + r["n_val"]) for r in split.split_sizes(labelled).collect()}
    usable = {k: v for k, v in series.items() if sizes[k][0] > 0}
    return labelled, plain_windows(usable, sizes)


def ridge(x, y, penalty):
    n, mean = len(y), x.mean(axis=0)
    a = (x - mean).T @ (x - mean) / n + penalty * np.eye(x.shape[1])
    w = np.linalg.solve(a, (x - mean).T @ (y - y.mean()) / n)
    return w, y.mean() - mean @ w


def test_path_equals_plain_ridge(case):
    labelled, windows = case
    x, y = windows["train"]
    for r in window_model.window_path(labelled, CONFIG, (1e-3, 0.5)).collect():
        w, a = ridge(x, y, r["penalty"])
        assert r["weights"] == pytest.approx(list(w)) and r["intercept"] == pytest.approx(a)
        for name in ("train", "val"):
            u, v = windows[name]
            assert r[f"{name}_loss"] == pytest.approx(((v - a - u @ w) ** 2).mean())


def test_validation_weeks_choose(case):
    labelled, windows = case
    model = window_model.window_choose(labelled, CONFIG, (1e-6, 1e-2, 1.0, 100.0))
    losses = {}
    for penalty in (1e-6, 1e-4, 1e-2, 1.0, 100.0):
        w, a = ridge(*windows["train"], penalty)
        losses[penalty] = ((windows["val"][1] - a - windows["val"][0] @ w) ** 2).mean()
    assert model.penalty == min(losses, key=losses.get)
    told = {r["split"]: r for r in window_model.window_losses(labelled, model).collect()}
    assert told["val"]["loss"] == pytest.approx(losses[model.penalty]) and told["val"]["n_windows"] == len(windows["val"][1])


def test_without_validation_weeks_the_configured_penalty_stands(case):
    labelled, _ = case
    model = window_model.window_choose(labelled.where("split = 'train'"), CONFIG)
    assert model.penalty == CONFIG.reg_param and len(model.weights) == 4


def test_no_window_at_all_is_an_error(make_weekly):
    labelled = split.temporal_split(make_weekly({"A__x": [1, 2, 3, 4, 5, 6] * 3}))
    with pytest.raises(ValueError, match="no series has a training window of 52 weeks"):
        window_model.window_choose(labelled)


def test_trees_stop_early(case):
    labelled, _ = case
    few = window_model.window_fit_trees(labelled, CONFIG, rounds=15, tolerance=0.5)
    every = window_model.window_fit_trees(labelled.where("split = 'train'"), CONFIG, rounds=15)
    assert few.getNumTrees < every.getNumTrees == 15
