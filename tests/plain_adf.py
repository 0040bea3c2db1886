"""The unit-root test on one series by least squares for every lag order."""

import math
from statistics import NormalDist

import numpy as np


def unit_root_p(statistic):
    if statistic > 2.74:
        return 1.0
    if statistic < -18.83:
        return 0.0
    surface = (2.1659, 1.4412, 0.038269) if statistic <= -1.61 else (1.7339, 0.93202, -0.12745, -0.010368)
    return NormalDist().cdf(sum(c * statistic**i for i, c in enumerate(surface)))


def adf_regression(y, lags, trim):
    """AIC and t value of the level term: dy on level, ``lags`` lagged changes and a constant."""
    dy = np.diff(y)
    target = dy[trim:]
    x = np.column_stack([y[trim:-1], *[dy[trim - k : len(dy) - k] for k in range(1, lags + 1)], np.ones(len(target))])
    coef = np.linalg.lstsq(x, target, rcond=None)[0]
    rss = float(((target - x @ coef) ** 2).sum())
    n, p = x.shape
    aic = n * (math.log(2 * math.pi) + math.log(rss / n) + 1) + 2 * p
    return aic, float(coef[0] / math.sqrt(rss / (n - p) * np.linalg.inv(x.T @ x)[0, 0]))


def adf_values(y):
    """Statistic, p-value, chosen lags and sample size of one series."""
    most = min(len(y) // 2 - 2, math.ceil(12 * (len(y) / 100) ** 0.25))
    lags = min(range(most + 1), key=lambda k: adf_regression(y, k, most)[0])
    statistic = adf_regression(y, lags, lags)[1]
    return statistic, unit_root_p(statistic), lags, len(y) - 1 - lags
