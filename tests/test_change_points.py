import numpy as np
import pytest
from conftest import MONDAY, week
from pyspark.sql import functions as F

from weeklens.config import RETAIL_STATES, AdditiveConfig
from weeklens.operators import additive, forecasts

CONFIG = AdditiveConfig(changepoints=8, fourier_order=2)


@pytest.fixture(scope="module")
def calendar(spark):
    days = spark.range(7 * 260).select(F.date_add(F.lit(MONDAY), F.col("id").cast("int")).alias("date"))
    event = F.when(F.dayofyear("date") == 100, F.lit("Fair"))
    return days.select("date", event.alias("event_name_1"), *[(F.dayofmonth("date") < k + 3).cast("int").alias(c) for k, c in enumerate(RETAIL_STATES.values())])


@pytest.fixture(scope="module")
def series():
    rng = np.random.default_rng(12)
    t = np.arange(200) / 199
    broken = 100 + 50 * t - 300 * np.maximum(0, t - 0.4) + 10 * np.sin(2 * np.pi * np.arange(200) / 52)
    return {
        "CA_1__broken": (broken + rng.normal(0, 2, 200)).tolist(), "CA_1__straight": (80 + 20 * t + rng.normal(0, 5, 200)).tolist(),
        "TX_1__noise": rng.normal(50, 10, 200).tolist(), "TX_1__zero": [0.0] * 200, "WI_1__short": [3.0, 5.0, 4.0],
    }


@pytest.fixture(scope="module")
def fitted(make_weekly, calendar, series):
    df = make_weekly(series)
    return df, additive.additive_fit(df, calendar, RETAIL_STATES, CONFIG).cache()


def test_stationarity(fitted, calendar, series):
    """No slope is above the cost of a change, and those of changes that happen equal it."""
    df, params = fitted
    spans = params.select(*additive.SPAN).distinct()
    systems = {(r.state, r.n): r for r in additive.span_systems(spans, additive.week_holidays(calendar, RETAIL_STATES), CONFIG).collect()}
    few = {}
    for p in params.collect():
        s = systems[p.state, p.n]
        x, y, k = np.array(s["columns"]).T, np.array(series[p.series_id]), CONFIG.changepoints
        ridge = additive._penalties(CONFIG, len(s.names))
        rest = np.delete(np.arange(x.shape[1]), np.s_[2 : 2 + k])
        plain = np.linalg.solve(x[:, rest].T @ x[:, rest] + np.diag(ridge[rest]), x[:, rest].T @ y)
        cost = ((y - x[:, rest] @ plain) ** 2).mean() / (CONFIG.changepoint_prior_scale * max(abs(y).max(), 1e-300))
        beta = np.array(p.coef)
        slope = x.T @ (y - x @ beta)
        assert slope[rest] == pytest.approx(ridge[rest] * beta[rest], abs=1e-6)
        changes, pull = beta[2 : 2 + k], slope[2 : 2 + k]
        size = max(abs(x.T @ y).max(), 1.0)
        for d, g in zip(changes, pull):
            assert (abs(g - cost * np.sign(d)) if d else max(0.0, abs(g) - cost)) <= 1e-6 * size, p.series_id
        assert p.sigma2 == pytest.approx(((y - x @ beta) ** 2).mean())
        few[p.series_id] = np.count_nonzero(changes)
    assert 1 <= few["CA_1__broken"] <= 4 and few["CA_1__straight"] == few["TX_1__noise"] == few["TX_1__zero"] == 0
    assert set(few) == set(series)


def test_intervals_widen_by_the_changes(fitted, calendar):
    df, params = fitted
    ahead = forecasts.future_weeks(df, 30)
    rows = additive.additive_forecast(ahead, params, calendar, RETAIL_STATES, CONFIG)
    half = {(r.series_id, r.horizon): (r.upper_bound - r.predicted_value) for r in rows.where("lower_bound > 0").collect()}
    p = {r.series_id: r for r in params.collect()}
    for sid in ("CA_1__broken", "CA_1__straight"):
        scale = np.abs(p[sid].coef[2 : 2 + CONFIG.changepoints]).mean()
        for h in (1, 10, 20):
            extra = 2 * CONFIG.changepoints / 3 * scale**2 * (h / 199) ** 3
            if (sid, h) in half:
                assert half[sid, h] == pytest.approx(1.2815515655446004 * np.sqrt(p[sid].sigma2 + extra), rel=1e-9)
    assert half["CA_1__straight", 30] == pytest.approx(half["CA_1__straight", 1])


def test_series_without_parameters_keep_their_rows(fitted, calendar):
    df, params = fitted
    some = params.where("series_id <> 'TX_1__noise'")
    out = additive.additive_forecast(forecasts.future_weeks(df, 4), some, calendar, RETAIL_STATES, CONFIG)
    assert out.count() == 20 and out.where("series_id = 'TX_1__noise' and predicted_value is null and upper_bound is null").count() == 4
    assert out.where("predicted_value is null").count() == 4
    parts = additive.additive_components(df.select("series_id", "week_start"), some, calendar, RETAIL_STATES, CONFIG)
    assert parts.count() == df.count() and parts.where("fitted is null").count() == 200


def test_unknown_prior_is_an_error(fitted, calendar):
    with pytest.raises(ValueError, match="unknown changepoint_prior 'flat'"):
        additive.additive_fit(fitted[0], calendar, RETAIL_STATES, AdditiveConfig(changepoint_prior="flat"))
    assert week(0) == MONDAY
