import numpy as np
import pytest
from conftest import week
from pyspark.sql import functions as F

from weeklens.operators import inventory, monitoring


def history(spark, mase, error=None, mean_demand=100.0, series="A"):
    error = error if error is not None else [0.0] * len(mase)
    n = len(mase)
    rows = [(series, "m", week(i), float(error[i]), float(mase[i]), mean_demand, n - i) for i in range(n)]
    return spark.createDataFrame(
        rows, "series_id string, model_type string, forecast_date date, error double, mase double, mean_demand double, rank int"
    )


@pytest.mark.parametrize("mase,expected", [
    ([2, 2, 2], False), ([1.15] * 4, False), ([1.16] * 4, True), ([9, 1, 1, 1, 1], False), ([0, 2, 2, 2, 2], True),
])
def test_mase_alert(spark, mase, expected):
    assert monitoring.mase_check(history(spark, mase)).first().mase_alert is expected


@pytest.mark.parametrize("error,expected,direction", [
    ([11, 11, 11], True, "over-forecasting"), ([-11, -12, -13], True, "under-forecasting"),
    ([11, 11], False, "over-forecasting"), ([11, 10, 11], False, "over-forecasting"), ([0, 50, 11, 12, 13], True, "over-forecasting"),
    ([20, -11, 20], True, "over-forecasting"),
])
def test_bias_alert(spark, error, expected, direction):
    row = monitoring.bias_check(history(spark, [0] * len(error), error)).first()
    assert (row.bias_alert, row.direction) == (expected, direction)


def numpy_psi(reference, current, bins=10):
    edges = np.histogram_bin_edges(reference, bins=bins)
    edges[0], edges[-1] = -np.inf, np.inf
    r = np.histogram(reference, edges)[0] / (len(reference) + 1e-6)
    c = np.histogram(current, edges)[0] / (len(current) + 1e-6)
    r, c = np.where(r == 0, 1e-6, r), np.where(c == 0, 1e-6, c)
    return float(np.sum((c - r) * np.log(c / r)))


def test_psi_matches_numpy(spark, make_weekly):
    rng = np.random.default_rng(1)
    samples = {
        "same": (rng.normal(0, 1, 200), None),
        "shifted": (rng.normal(0, 1, 200), rng.normal(1, 1, 30)),
        "outside": (rng.uniform(0, 1, 100), np.array([-5.0, 7.0, 0.5])),
        "edges": (np.arange(11.0), np.arange(11.0)[::2]),
        "flat": (np.full(20, 4.0), np.array([4.0, 4.0, 5.0])),
    }
    reference = make_weekly({k: v[0] for k, v in samples.items()} | {"absent": [1.0, 2.0]})
    current = make_weekly({k: v[0] if v[1] is None else v[1] for k, v in samples.items()})
    rows = {r.series_id: r for r in monitoring.psi(reference, current).collect()}
    assert set(rows) == set(samples)
    for k, (r, c) in samples.items():
        assert rows[k].psi_score == pytest.approx(numpy_psi(r, r if c is None else c), abs=1e-6), k
    assert rows["same"].psi_score == 0 and rows["same"].band == "stable"
    assert rows["shifted"].psi_alert and rows["shifted"].band == "significant"


def test_psi_with_one_hot_key(spark):
    """A third of all values under one key."""
    reference = spark.range(30000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('k', id % 500) END AS series_id", "double(id % 101) AS total_sales"
    )
    rows = monitoring.psi(reference, reference).collect()
    assert len(rows) == 501 and max(abs(r.psi_score) for r in rows) == 0


def test_all_checks_in_one_row(spark):
    psi = spark.createDataFrame([("A", 0.5, True)], "series_id string, psi_score double, psi_alert boolean")
    df = history(spark, [1.2] * 4, [30, 30, 30, 30]).unionByName(history(spark, [0.1] * 4, series="B"))
    rows = {r.series_id: r for r in monitoring.drift_checks(df, psi).collect()}
    assert (rows["A"].mase_alert, rows["A"].bias_alert, rows["A"].psi_alert, rows["A"].psi_score) == (True, True, True, 0.5)
    assert (rows["B"].mase_alert, rows["B"].bias_alert, rows["B"].psi_alert, rows["B"].psi_score) == (False, False, False, 0.0)
    checks = monitoring.drift_checks(df, psi)
    assert monitoring.active(checks).count() == 1
    alerts = {r.alert_type: r for r in monitoring.alert_rows(checks).collect()}
    assert set(alerts) == {"mase_alert", "bias_alert", "psi_alert"}
    assert alerts["psi_alert"].action == "retrain" and "A/m" in alerts["mase_alert"].message
    assert "over-forecasting" in alerts["bias_alert"].message
    assert monitoring.drift_checks(df).first().psi_score == 0.0
    assert "1.200" in monitoring.mase_warnings(df).first().message


def test_health(spark):
    df = history(spark, [1.2] * 4, [4, 4, 4, 4], series="red")
    df = df.unionByName(history(spark, [0.96] * 5, [1] * 5, series="amber")).unionByName(history(spark, [0.1, 0.3], [9, 9], series="green"))
    rows = {r.series_id: (r.status, r.mase_4w, r.bias) for r in monitoring.health_table(df).collect()}
    assert rows["red"][0] == "RED" and rows["red"][2] == 4
    assert rows["amber"][0] == "AMBER"
    assert rows["green"] == ("GREEN", pytest.approx(0.2), 0.0)
    assert {r.status: r.n for r in monitoring.health_counts(monitoring.health_table(df)).collect()} == {"RED": 1, "AMBER": 1, "GREEN": 1}


def test_error_histories(spark, make_weekly):
    weekly = make_weekly({"A": range(10, 20)})
    rows = [("A", "m", week(i), float(i + 12), float(i + 10)) for i in range(12)]
    stored = spark.createDataFrame(rows, "series_id string, model_type string, forecast_date date, predicted_value double, lower_bound double")
    got = monitoring.error_history(stored, weekly, weekly, weeks=4).orderBy("rank").collect()
    assert [r.forecast_date for r in got] == [week(9), week(8), week(7), week(6)]
    assert {r.error for r in got} == {2.0} and {r.mase for r in got} == {2.0}
    proxy = monitoring.proxy_history(stored.withColumn("lower_bound", F.when(F.col("predicted_value") > 20, None).otherwise(F.col("lower_bound"))))
    assert sorted({r.error for r in proxy.collect()}) == [0.0, 2.0]


def test_newsvendor(spark):
    rows = [("A", "x", 10.0, 100.0), ("A", "y", 20.0, 100.0), ("B", "x", 500.0, 1.0)]
    df = spark.createDataFrame(rows, "series_id string, model string, MAE double, mean_demand double")
    out = {(r.series_id, r.model): r for r in inventory.newsvendor(df, 8.0, 2.0).collect()}
    z, sigma = 0.8416212335729143, 10 * np.sqrt(np.pi / 2)
    phi = np.exp(-z * z / 2) / np.sqrt(2 * np.pi)
    a = out["A", "x"]
    assert a.critical_ratio == 0.8 and a.sigma == pytest.approx(sigma)
    assert a.order_quantity == pytest.approx(100 + z * sigma)
    assert a.expected_cost == pytest.approx(2 * sigma * phi + 8 * sigma * 0.2 * phi)
    assert a.expected_cost_textbook == pytest.approx(10 * sigma * phi)
    cheap = {r.series_id: r for r in inventory.newsvendor(df, 1.0, 9.0).collect()}
    assert cheap["B"].order_quantity == 0
    by_column = inventory.newsvendor(df, F.lit(8.0), F.lit(2.0)).where("series_id = 'A' and model = 'x'").first()
    assert by_column.expected_cost == pytest.approx(a.expected_cost)
    costs = inventory.newsvendor(df)
    best = {r.series_id: r for r in inventory.cheapest_and_dearest(costs).collect()}
    assert (best["A"].best_model, best["A"].worst_model) == ("x", "y") and best["B"].savings == 0
    spread = {(r.series_id, r.model): r.savings_vs_worst for r in inventory.cost_spread(costs).collect()}
    assert spread["A", "y"] == 0 and spread["A", "x"] == pytest.approx(best["A"].savings)
