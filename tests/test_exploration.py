import datetime as dt

import numpy as np
import plain_adf
import pytest
from conftest import values, week
from pyspark.sql import functions as F

from weeklens.operators import correlation, decompose


@pytest.fixture(scope="module")
def wave():
    t = np.arange(130)
    return 240 - 0.3 * t + 17 * np.cos(2 * np.pi * (t - 9) / 52) + np.random.default_rng(6).normal(0, 0.8, 130)


@pytest.fixture(scope="module")
def long_wave():
    t = np.arange(260)
    return 100 + 0.1 * t + 10 * np.sin(2 * np.pi * t / 52) + np.random.default_rng(1).standard_normal(260)


def test_moving_average_parts(make_weekly, long_wave):
    rows = decompose.decompose_ma(make_weekly({"A": long_wave})).orderBy("week_start").collect()
    trend = np.full(260, np.nan)
    weights = np.r_[0.5, np.ones(51), 0.5] / 52
    trend[26:-26] = np.convolve(long_wave, weights, "valid")
    raw = np.array([np.nanmean((long_wave - trend)[p::52]) for p in range(52)])
    seasonal = np.tile(raw - raw.mean(), 5)
    assert rows[0].trend is None and rows[0].residual is None
    assert [r.trend for r in rows[26:-26]] == pytest.approx(list(trend[26:-26]))
    assert [r.seasonal for r in rows] == pytest.approx(list(seasonal))
    for r in rows[26:-26]:
        assert r.trend + r.seasonal + r.residual == pytest.approx(r.observed)


def test_stl_parts_add_up_and_separate(make_weekly, wave):
    df = decompose.decompose_stl(make_weekly({"A": wave, "short": [1.0, 2.0, 3.0]}))
    rows = df.where("series_id = 'A'").orderBy("week_start").collect()
    assert len(rows) == 130
    assert all(r.trend + r.seasonal + r.residual == pytest.approx(r.observed) for r in rows)
    trend = np.array([r.trend for r in rows])
    assert np.abs(trend - (240 - 0.3 * np.arange(130)))[20:-20].max() < 4
    assert np.std([r.residual for r in rows]) < 2
    assert {(r.trend, r.error) for r in df.where("series_id = 'short'").collect()} == {(None, "3 values are less than two periods of 52")}
    assert df.where("series_id = 'A' and error is not null").count() == 0


def test_stl_batch_equals_single(long_wave, wave):
    y = np.vstack([long_wave, long_wave[::-1]])
    both = decompose.stl_arrays(y, 52, True)
    one = decompose.stl_arrays(y[:1], 52, True)
    assert np.allclose(both[0][0], one[0][0]) and np.allclose(both[1][0], one[1][0])


def naive_loess(x, y, span, at, robust):
    """Straight weighted line fit at one point, for comparison."""
    n = len(x)
    order = np.argsort(np.abs(x - at), kind="stable")[: min(span, n)]
    idx = np.sort(order)
    reach = np.abs(x[idx] - at).max() + (max(span - n, 0) // 2)
    d = np.abs(x[idx] - at) / reach
    w = np.where(d <= 0.001, 1, np.where(d <= 0.999, (1 - d**3) ** 3, 0)) * robust[idx]
    a = np.column_stack([np.ones(len(idx)), x[idx] - at]) * np.sqrt(w)[:, None]
    return np.linalg.lstsq(a, y[idx] * np.sqrt(w), rcond=None)[0][0]


def test_loess_against_weighted_least_squares():
    rng = np.random.default_rng(3)
    y, robust = rng.standard_normal((1, 40)), rng.uniform(0.2, 1, (1, 40))
    at = np.arange(40, dtype=float)
    got = decompose._loess(y, 11, at, robust)[0]
    assert got == pytest.approx([naive_loess(at, y[0], 11, p, robust[0]) for p in at])


def test_anomalies(spark, make_weekly):
    sales = [31, 29, 33, 4, 30, 32, 28, 31, 30, 29, 33, 30]
    residual = [1, -1, 2, -27, 0, 1, -2, 0, -1, 0, 2, -1]
    rows = [("A", week(i), float(s), float(r)) for i, (s, r) in enumerate(zip(sales, residual))]
    parts = spark.createDataFrame(rows, "series_id string, week_start date, observed double, residual double")
    events = spark.createDataFrame([(week(3), "StoreRefit")], "week_start date, event_name string")
    out = decompose.detect_anomalies(parts, events, sigmas=1.5).orderBy("week_start").collect()
    assert [r.is_anomaly for r in out] == [i == 3 for i in range(12)]
    assert (out[3].anomaly_class, out[3].event_label) == ("explainable", "StoreRefit")
    assert (out[0].anomaly_class, out[0].event_label) == ("normal", "")
    for shift, kind in ((1, "explainable"), (-1, "explainable"), (2, "unexplained")):
        moved = spark.createDataFrame([(week(3 + shift), "E")], "week_start date, event_name string")
        assert decompose.detect_anomalies(parts, moved, 1.5).where("is_anomaly").first().anomaly_class == kind
    both = spark.createDataFrame([(week(2), "early"), (week(4), "late")], "week_start date, event_name string")
    assert decompose.detect_anomalies(parts, both, 1.5).where("is_anomaly").first().event_label == "early"
    assert decompose.detect_anomalies(parts, None, 1.5).where("is_anomaly").first().anomaly_class == "unexplained"
    assert decompose.anomaly_counts(decompose.detect_anomalies(parts, None, 1.5)).first().n_anomalies == 1


def brute_acf(y, nlags):
    c = y - y.mean()
    return np.array([(c[k:] * c[: len(c) - k]).sum() for k in range(nlags + 1)]) / (c * c).sum()


def test_acf_and_band(make_weekly, wave):
    rows = correlation.acf(make_weekly({"A": wave}), nlags=20).orderBy("lag").collect()
    r = brute_acf(wave, 20)
    assert [x.acf for x in rows] == pytest.approx(list(r))
    half = 1.959963984540054 * np.sqrt((1 + 2 * (r[1:5] ** 2).sum()) / 130)
    assert rows[5].acf_upper - rows[5].acf == pytest.approx(half)
    assert rows[0].acf_lower == rows[0].acf_upper == 1


def test_pacf_solves_yule_walker(make_weekly, wave):
    rows = values(correlation.pacf(make_weekly({"A": wave}), nlags=15), "pacf", order=("lag",))
    r = brute_acf(wave, 15)
    for k in range(1, 16):
        toeplitz = np.array([[r[abs(i - j)] for j in range(k)] for i in range(k)])
        assert rows[k] == pytest.approx(np.linalg.solve(toeplitz, r[1 : k + 1])[-1])


def test_pacf_of_a_short_series_is_null_with_an_error(make_weekly):
    frame = correlation.pacf(make_weekly({"A": [1.0, 3.0, 2.0, 5.0], "B": [1.0, 3.0, 2.0, 5.0, 4.0]}), nlags=2)
    rows = frame.collect()
    assert [r.lag for r in rows if r.series_id == "A"] == [0, 1, 2]
    assert all((r.pacf is None) == (r.error is not None) == (r.series_id == "A") for r in rows)
    assert {r.pacf for r in frame.select("series_id", "pacf").where("series_id = 'A'").collect()} == {None}


def test_ljung_box(make_weekly):
    y = np.random.default_rng(5).standard_normal(200)
    row = correlation.ljung_box(make_weekly({"A": y}), lags=10, value="total_sales").first()
    r = brute_acf(y, 10)
    assert row.lb_stat == pytest.approx(200 * 202 * sum(r[k] ** 2 / (200 - k) for k in range(1, 11)))
    assert row.passed and 0.05 < row.lb_pvalue <= 1


def test_adf(make_weekly):
    rng = np.random.default_rng(7)
    noise, walk = rng.standard_normal(300), rng.standard_normal(300).cumsum()
    df = make_weekly({"noise": noise, "walk": walk, "line": range(50), "flat": [3] * 60})
    rows = {r.series_id: r for r in correlation.adf_test(df).collect()}
    assert rows["noise"].status == "STATIONARY" and rows["noise"].p_value < 0.01
    assert rows["walk"].status == "NON-STATIONARY"
    assert rows["flat"].error and rows["flat"].test_stat is None
    assert set(rows["line"].critical_values) == {"1%", "5%", "10%"}
    assert rows["walk"].critical_values["5%"] == pytest.approx(-2.87, abs=0.01)
    assert 0 <= rows["walk"].lags_used <= 16


def test_adf_equals_least_squares_for_every_order(make_weekly):
    rng = np.random.default_rng(11)
    noise = lambda n: rng.standard_normal(n)
    series = {
        "walk80": noise(80).cumsum(), "walk400": 1000 + 30 * noise(400).cumsum(), "noise": 5 + noise(200), "short": noise(9),
        "shorter": noise(5), "trend": np.arange(120) + noise(120), "season": 400 + 100 * np.sin(np.arange(357) / 8) + 20 * noise(357),
        "four": noise(4).cumsum(),
    }
    got = {r.series_id: r for r in correlation.adf_test(make_weekly(series)).collect()}
    for name, y in series.items():
        if name in ("shorter", "four"):
            continue
        stat, p, lags, n = plain_adf.adf_values(y)
        assert (got[name].lags_used, got[name].n_used) == (lags, n), name
        assert got[name].test_stat == pytest.approx(stat, rel=1e-9, abs=1e-9) and got[name].p_value == pytest.approx(p, abs=1e-9)
    assert got["shorter"].lags_used == 0 and got["four"].series_id == "four"
    assert set(got) == set(series)


def test_p_value_at_critical_points(spark):
    p = lambda stat: spark.range(1).select(correlation.unit_root_p(F.lit(stat)).alias("p")).first().p
    for stat, share in ((-3.43, 0.01), (-2.86, 0.05), (-2.57, 0.10)):
        assert p(stat) == pytest.approx(share, abs=0.002)
    assert p(3.0) == 1 and p(-20.0) == 0
    for stat in (-18.0, -9.5, -4.0, -1.61, -1.6, 0.0, 1.5, 2.7):
        assert p(stat) == pytest.approx(plain_adf.unit_root_p(stat), abs=1e-12)


def test_adf_stays_in_the_jvm(make_weekly):
    plan = correlation.adf_test(make_weekly({"a": range(30)}))._jdf.queryExecution().toString()
    assert "Python" not in plan and "MapInPandas" not in plan


def test_control_limits(spark):
    rows = [("A", week(i), float(i), float(v)) for i, v in enumerate([1, -1, 2, -2])]
    out = decompose.control_limits(spark.createDataFrame(rows, "series_id string, week_start date, observed double, residual double")).first()
    assert out.residual_limit == pytest.approx(3 * np.std([1, -1, 2, -2])) and out.bias_limit == pytest.approx(0.15)
    assert isinstance(out.week_start, dt.date)
