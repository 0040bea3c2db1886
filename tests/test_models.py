import numpy as np
import pytest
from conftest import values, week
from pyspark.sql import functions as F

from weeklens.config import RETAIL_STATES, AdditiveConfig, SeasonalArConfig, WindowConfig
from weeklens.operators import additive, forecasts, sar, split, window_model
from weeklens.sources.calendar import calendar_from_days
from weeklens.sources.store import latest_params, read_params, require_params, write_params

SMALL = SeasonalArConfig(season=4)


def seasonal(n, seed, period=52, scale=2.0):
    t = np.arange(n)
    return 100 + 10 * np.sin(2 * np.pi * t / period) + np.random.default_rng(seed).normal(0, scale, n)


@pytest.fixture(scope="module")
def series():
    return {"CA_1__A": seasonal(200, 1), "TX_1__B": seasonal(200, 2)}


@pytest.fixture(scope="module")
def calendar(spark):
    days = spark.sql(
        "SELECT posexplode(sequence(date'2010-01-04', date'2014-12-28', interval 1 day)) AS (i, date)"
    ).selectExpr(
        "concat('d_', i + 1) AS d", "date",
        "CASE WHEN month(date) = 12 AND day(date) = 25 THEN 'Christmas' END AS event_name_1",
        "int(day(date) <= 10) AS snap_CA", "int(day(date) > 25) AS snap_TX", "0 AS snap_WI",
    )
    return calendar_from_days(days, RETAIL_STATES.values()).persist()


def differences(y, s):
    w = np.full(len(y), np.nan)
    w[s + 1 :] = y[s + 1 :] - y[s:-1] - y[1:-s] + y[: -s - 1]
    return w


def test_sar_fit_is_least_squares(make_weekly):
    y = seasonal(120, 3, period=4)
    row = sar.sar_fit(make_weekly({"A": y}), SMALL).first()
    w = differences(y, 4)
    t = np.arange(9, 120)
    x = np.column_stack([w[t - 1], w[t - 4]])
    beta, rss, *_ = np.linalg.lstsq(x, w[t], rcond=None)
    assert (row.phi1, row.phi_s) == pytest.approx(tuple(beta))
    assert row.sigma2 == pytest.approx(rss[0] / len(t)) and row.n_used == len(t)
    assert row.bic - row.aic == pytest.approx(3 * np.log(len(t)) - 6)
    residual = values(sar.sar_residuals(make_weekly({"A": y}), sar.sar_fit(make_weekly({"A": y}), SMALL), 4), "residual")
    assert residual == pytest.approx(list(w[t] - x @ beta))


def test_sar_forecast_equals_a_loop(make_weekly):
    y = seasonal(120, 4, period=4)
    df = make_weekly({"A": y})
    params = sar.sar_fit(df, SMALL)
    p = params.first()
    rows = sar.sar_forecast(df, params, 9, SMALL).orderBy("horizon").collect()
    ys, ws = list(y), list(differences(y, 4))
    psi, us = [0.0] * 5 + [1.0], [0.0] * 5 + [1.0]
    for _ in range(9):
        ws.append(p.phi1 * ws[-1] + p.phi_s * ws[-4])
        ys.append(ys[-1] + ys[-4] - ys[-5] + ws[-1])
        us.append(p.phi1 * us[-1] + p.phi_s * us[-4])
        psi.append(psi[-1] + psi[-4] - psi[-5] + us[-1])
    assert [r.predicted_value for r in rows] == pytest.approx(ys[120:])
    for h, r in enumerate(rows):
        half = 1.959963984540054 * np.sqrt(p.sigma2 * sum(v * v for v in psi[5 : 6 + h]))
        assert r.upper_bound - r.predicted_value == pytest.approx(half)
    assert rows[0].forecast_date == week(120)


def test_sar_singular_series_gets_null_and_others_survive(make_weekly, series):
    df = make_weekly({**series, "CA_1__flat": [5.0] * 200})
    rows = {r.series_id: r.phi1 for r in sar.sar_fit(df).collect()}
    assert rows["CA_1__flat"] is None and rows["CA_1__A"] is not None
    out = sar.sar_forecast(df, sar.sar_fit(df), 13)
    assert out.where("predicted_value < 0 or lower_bound < 0").count() == 0
    assert out.where("series_id = 'CA_1__A'").count() == 13


def reference_ridge(x, y, config, n_holidays):
    return np.linalg.solve(x.T @ x + np.diag(additive._penalties(config, n_holidays)), x.T @ y)


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_additive_fit_is_ridge(spark, make_weekly, calendar, series, threshold, request):
    """The same coefficients whether Spark sends the solutions to the series or shuffles both."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    request.addfinalizer(lambda: spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before))
    config = AdditiveConfig(changepoint_prior="normal", changepoints=5, fourier_order=3)
    df = make_weekly(series)
    rows = {r.series_id: r for r in additive.additive_fit(df, calendar, RETAIL_STATES, config).collect()}
    spans = df.groupBy("series_id").agg(F.min("week_start").alias("first_week"), F.count("*").alias("n")).selectExpr(
        "split_part(series_id, '_', 1) AS state", "first_week", "n"
    ).distinct()
    solved = additive.span_systems(spans, additive.week_holidays(calendar, RETAIL_STATES), config)
    for state, sid in (("CA", "CA_1__A"), ("TX", "TX_1__B")):
        s = solved.where(F.col("state") == state).first()
        x = np.array(s["columns"]).T
        assert x.shape == (200, 2 + 5 + 6 + len(s.names)) and "Christmas" in s.names and f"SNAP_{state}" in s.names
        beta = reference_ridge(x, series[sid], config, len(s.names))
        assert rows[sid].coef == pytest.approx(list(beta))
        assert rows[sid].sigma2 == pytest.approx(np.mean((series[sid] - x @ beta) ** 2))


def test_additive_forecast_components_and_in_sample(make_weekly, calendar, series):
    df = make_weekly(series)
    params = additive.additive_fit(df, calendar, RETAIL_STATES)
    parts = additive.additive_components(df, params, calendar, RETAIL_STATES)
    assert parts.where("abs(trend + yearly + holidays - fitted) > 1e-9").count() == 0
    inside = additive.additive_in_sample(df, params, calendar, RETAIL_STATES)
    assert inside.count() == 400
    error = inside.join(df.withColumnRenamed("week_start", "forecast_date"), ["series_id", "forecast_date"])
    assert error.select(F.avg(F.abs(F.col("predicted_value") - F.col("total_sales")))).first()[0] < 4
    ahead = additive.additive_forecast(forecasts.future_weeks(df, 13), params, calendar, RETAIL_STATES)
    rows = ahead.collect()
    assert len(rows) == 26 and all(0 <= r.lower_bound <= r.predicted_value <= r.upper_bound for r in rows)
    truth = 100 + 10 * np.sin(2 * np.pi * np.arange(200, 213) / 52)
    got = values(ahead.where("series_id = 'CA_1__A'"), "predicted_value", order=("horizon",))
    assert np.abs(np.array(got) - truth).mean() < 6


@pytest.fixture(scope="module")
def labelled(make_weekly, series):
    return split.temporal_split(make_weekly(series)).persist()


def test_window_fit_matches_numpy(labelled, series):
    config = WindowConfig(window=8, reg_param=0.0)
    model = window_model.window_fit(labelled, config)
    xs, ts = [], []
    for y in series.values():
        train = y[: 200 - 13 - 20]
        z = (train - train.min()) / (train.max() - train.min())
        for i in range(8, len(z)):
            xs.append([*z[i - 8 : i], 1.0])
            ts.append(z[i])
    beta = np.linalg.lstsq(np.array(xs), np.array(ts), rcond=None)[0]
    assert list(model.weights) + [model.intercept] == pytest.approx(list(beta), abs=1e-6)
    losses = {r.split: r for r in window_model.window_losses(labelled, model).collect()}
    assert losses["train"].n_windows == len(xs) and losses["val"].n_windows == 40
    assert losses["train"].loss == pytest.approx(np.mean((np.array(xs) @ beta - ts) ** 2))


def test_window_forecast_equals_a_loop(labelled, series):
    model = window_model.window_fit(labelled, WindowConfig(window=8))
    known = labelled.where("split <> 'test'")
    out = window_model.window_forecast(known, split.scaler_params(labelled), model, 10)
    y = series["CA_1__A"]
    train = y[: 200 - 33]
    lo, hi = train.min(), train.max()
    path = list((y[:187] - lo) / (hi - lo))
    for _ in range(10):
        path.append(float(np.dot(path[-8:], model.weights) + model.intercept))
    got = values(out.where("series_id = 'CA_1__A'"), "predicted_value", order=("horizon",))
    assert got == pytest.approx([v * (hi - lo) + lo for v in path[187:]])


def test_window_history_and_short_seed(labelled, make_weekly):
    model = window_model.window_fit(labelled, WindowConfig(window=8), solver="l-bfgs")
    assert len(model.losses) > 1 and model.losses[-1] <= model.losses[0]
    short = make_weekly({"CA_1__A": [1, 2, 3], "CA_9__Z": range(20)})
    rows = window_model.window_forecast(short, split.scaler_params(labelled), model, 3).collect()
    assert sorted((r.series_id, r.horizon) for r in rows) == [(s, h) for s in ("CA_1__A", "CA_9__Z") for h in (1, 2, 3)]
    assert all(r.predicted_value is None for r in rows)  # one is short, the other has no scaler


def test_short_series_keep_their_rows(make_weekly):
    weekly = make_weekly({"long": [float(i % 7 + i % 52) for i in range(160)], "short": range(30), "none": [None] * 3 + [1.0]})
    params = sar.sar_fit(weekly)
    assert {r.series_id: r.n_used > 0 for r in params.collect()} == {"long": True, "short": False, "none": False}
    rows = sar.sar_forecast(weekly, params.where("series_id <> 'none'"), 4).collect()
    assert len(rows) == 12 and {r.series_id for r in rows if r.predicted_value is not None} == {"long"}
    model = window_model.window_fit_trees(split.temporal_split(weekly.where("series_id = 'long'")), WindowConfig(window=8), rounds=2)
    scaler = split.scaler_params(split.temporal_split(weekly.where("series_id = 'long'")))
    rows = window_model.window_forecast_trees(weekly, scaler, model, 2, size=8).collect()
    assert len(rows) == 6 and sum(r.predicted_value is not None for r in rows) == 2


def test_tree_forecast(labelled):
    model = window_model.window_fit_trees(labelled, WindowConfig(window=8), rounds=3)
    known = labelled.where("split <> 'test'")
    out = window_model.window_forecast_trees(known, split.scaler_params(labelled), model, 5, size=8).collect()
    assert len(out) == 10 and all(r.predicted_value >= 0 for r in out)


def test_saved_parameters_give_equal_forecasts(spark, make_weekly, series, tmp_path):
    df = make_weekly(series)
    fitted = sar.sar_fit(df)
    stamped = fitted.select(
        "series_id", F.lit("sar").alias("model_type"), F.lit("v1").alias("version"),
        F.lit("2020-01-01").cast("timestamp").alias("generated_at"), F.array("phi1", "phi_s").alias("coef"), "sigma2",
    )
    path = str(tmp_path / "params")
    write_params(stamped, path)
    older = stamped.withColumn("version", F.lit("zz")).withColumn("generated_at", F.lit("2019-01-01").cast("timestamp"))
    write_params(older.withColumn("coef", F.array(F.lit(0.0), F.lit(0.0))), path)
    newest = latest_params(read_params(spark, path))
    assert {r.version for r in newest.collect()} == {"v1"}
    loaded = newest.select("series_id", F.col("coef")[0].alias("phi1"), F.col("coef")[1].alias("phi_s"), "sigma2")
    order = ("series_id", "horizon")
    assert values(sar.sar_forecast(df, loaded, 5), "predicted_value", order=order) == values(
        sar.sar_forecast(df, fitted, 5), "predicted_value", order=order
    )


def test_use_before_fit_names_the_series(make_weekly, series):
    df = make_weekly(series)
    with pytest.raises(RuntimeError, match="not fitted: TX_1__B"):
        require_params(df, sar.sar_fit(df.where("series_id = 'CA_1__A'")))
