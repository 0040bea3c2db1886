import numpy as np
import pytest
from pyspark.sql import functions as F

from weeklens.config import SeasonalArConfig
from weeklens.functions.arrays import solve
from weeklens.operators import sma

SEASON = 4
CONFIG = SeasonalArConfig(season=SEASON)


def moving_series(seed, n, phi=0.4, far=0.5, theta=0.5, far_theta=0.4):
    """A series whose double differences follow the model, started at zero."""
    rng = np.random.default_rng(seed)
    e, w, y = rng.normal(0, 5, n + 60), np.zeros(n + 60), np.zeros(n + 60)
    for t in range(SEASON + 1, n + 60):
        w[t] = phi * w[t - 1] + far * w[t - SEASON] - phi * far * w[t - SEASON - 1]
        w[t] += e[t] + theta * e[t - 1] + far_theta * e[t - SEASON] + theta * far_theta * e[t - SEASON - 1]
        y[t] = y[t - 1] + y[t - SEASON] - y[t - SEASON - 1] + w[t]
    return y[60:]


def plain_terms(y, lags):
    """Second-stage rows (w1, ws, wx, e1, es, ex, w) and the shocks, from a least-squares long autoregression."""
    s, n = SEASON, len(y)
    w = np.full(n, np.nan)
    w[s + 1 :] = y[s + 1 :] - y[s:-1] - y[1 : n - s] + y[: n - s - 1]
    back = lambda a, k: np.concatenate([np.full(k, np.nan), a[:-k]])
    x = np.column_stack([back(w, k) for k in lags])
    whole = ~np.isnan(x).any(axis=1)
    e = w - x @ np.linalg.lstsq(x[whole], w[whole], rcond=None)[0]
    rows = np.column_stack([back(w, 1), back(w, s), back(w, s + 1), back(e, 1), back(e, s), back(e, s + 1), w])
    return rows[~np.isnan(rows).any(axis=1)], w, e


def loss(c, rows):
    p, f, t, g = c
    return float(((rows @ np.array([-p, -f, p * f, -t, -g, -t * g, 1.0])) ** 2).sum())


@pytest.fixture(scope="module")
def fitted(make_weekly):
    series = {f"A__{i}": moving_series(i, 400) for i in range(3)} | {"B__short": [1.0, 2.0, 3.0], "B__flat": [5.0] * 40, "B__mid": list(range(14))}
    frame = make_weekly(series)
    return series, frame, sma.sma_fit(frame, CONFIG).cache()


def test_coefficients_are_a_minimum(fitted):
    series, _, params = fitted
    for r in params.where("series_id like 'A%'").collect():
        rows, _, _ = plain_terms(series[r["series_id"]], sma._lags(SEASON))
        c = np.array([r[x] for x in sma.COEFFICIENTS])
        assert r["n_used"] == len(rows)
        assert abs(r["sigma2"] - loss(c, rows) / len(rows)) < 1e-6
        for i in range(4):
            for step in (1e-3, -1e-3):
                moved = c.copy()
                moved[i] += step
                assert loss(moved, rows) > loss(c, rows)
        assert abs(c - np.array([0.4, 0.5, 0.5, 0.4])).max() < 0.3
        assert r["error"] is None


def test_short_and_flat_series_say_why(fitted):
    _, frame, params = fitted
    rows = {r["series_id"]: r for r in params.where("series_id like 'B%'").collect()}
    assert set(rows) == {"B__short", "B__flat", "B__mid"}
    assert all(r["phi1"] is None and r["sigma2"] is None and "regression rows" in r["error"] for r in rows.values())
    ahead = sma.sma_forecast(frame, params, 5, CONFIG)
    assert ahead.groupBy("series_id").count().where("count <> 5").count() == 0 and ahead.count() == 30
    assert ahead.where("series_id like 'B%' and predicted_value is not null").count() == 0


def test_forecast_equals_the_recursion(fitted):
    series, frame, params = fitted
    p = {r["series_id"]: r for r in params.collect()}
    got = sma.sma_forecast(frame, params, 6, CONFIG).where("series_id = 'A__1'").orderBy("horizon").collect()
    y = list(series["A__1"])
    _, w, e = plain_terms(np.array(y), sma._lags(SEASON))
    w, e = list(w), list(e)
    f, g, t, h = (p["A__1"][c] for c in sma.COEFFICIENTS)
    impulse_w, impulse_e, impulse_y = [0.0] * 10 + [1.0], [0.0] * 10 + [1.0], [0.0] * 10 + [1.0]
    spread = 0.0
    for r in got:
        spread += impulse_y[-1] ** 2
        nxt = lambda w, e: f * w[-1] + g * w[-4] - f * g * w[-5] + t * e[-1] + h * e[-4] + t * h * e[-5]
        new, push = nxt(w, e), nxt(impulse_w, impulse_e)
        y.append(y[-1] + y[-4] - y[-5] + new)
        impulse_y.append(impulse_y[-1] + impulse_y[-4] - impulse_y[-5] + push)
        w.append(new), e.append(0.0), impulse_w.append(push), impulse_e.append(0.0)
        half = 1.959963984540054 * (p["A__1"]["sigma2"] * spread) ** 0.5
        assert r["predicted_value"] == pytest.approx(max(0.0, y[-1]), abs=1e-6)
        assert r["upper_bound"] == pytest.approx(max(0.0, y[-1] + half), abs=1e-6)


def test_residuals_leave_the_loss(fitted):
    _, frame, params = fitted
    rest = sma.sma_residuals(frame, params, SEASON).groupBy("series_id").agg(F.avg(F.col("residual") ** 2).alias("m"))
    want = {r["series_id"]: r["sigma2"] for r in params.where("sigma2 is not null").collect()}
    got = {r["series_id"]: r["m"] for r in rest.where("m is not null").collect()}
    assert got == pytest.approx(want)


def test_solve(spark):
    rng = np.random.default_rng(2)
    a = rng.normal(size=(6, 4))
    m, b = a.T @ a, rng.normal(size=4)
    rows = spark.createDataFrame([([[*map(float, m[i]), float(b[i])] for i in range(4)],), (None,), ([[0.0, 1.0]],)], "s array<array<double>>")
    got = [r["x"] for r in rows.select(solve(F.col("s")).alias("x")).collect()]
    assert got[0] == pytest.approx(list(np.linalg.solve(m, b))) and got[1:] == [None, [None]]
