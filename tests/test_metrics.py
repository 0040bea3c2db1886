import math

import numpy as np
import pytest
from conftest import values, week

from weeklens.operators import forecasts, metrics


@pytest.fixture(scope="module")
def make_pairs(spark):
    def build(actual, forecast, series="S", model="m", start=0):
        rows = [
            (series, model, i + 1, week(start + i), float(f), float(a)) for i, (a, f) in enumerate(zip(actual, forecast))
        ]
        return spark.createDataFrame(
            rows,
            "series_id string, model_type string, horizon int, forecast_date date, predicted_value double, actual double",
        )

    return build


def evaluate(make_weekly, make_pairs, actual, forecast, train):
    return metrics.evaluate_models(make_pairs(actual, forecast), make_weekly({"S": train})).first()


def seeded_train():
    return 200 + 20 * np.random.default_rng(42).standard_normal(104)


def test_perfect_forecast_scores_zero(make_weekly, make_pairs):
    y = [100, 110, 105, 120, 115]
    row = evaluate(make_weekly, make_pairs, y, y, seeded_train())
    assert (row.MASE, row.RMSE, row.MAE, row.ME) == (0, 0, 0, 0)


def test_mase_against_numpy(make_weekly, make_pairs):
    rng = np.random.default_rng(0)
    train = 100 + 5 * rng.standard_normal(60)
    row = evaluate(make_weekly, make_pairs, train[52:], train[:8], train)
    assert row.MASE == pytest.approx(1.0)


def test_constant_train_gives_null(make_weekly, make_pairs):
    assert evaluate(make_weekly, make_pairs, [100, 100], [110, 90], [100] * 60).MASE is None


def test_short_train_uses_lag_one(make_weekly, make_pairs):
    assert evaluate(make_weekly, make_pairs, [22, 24], [21, 23], [10, 12, 14, 16, 18, 20]).MASE == 0.5


def test_errors(make_pairs):
    row = metrics.accuracy(make_pairs([1, 2, 3], [2, 2, 2])).first()
    assert row.RMSE == pytest.approx(math.sqrt(2 / 3)) and row.MAE == pytest.approx(2 / 3) and row.RMSE >= row.MAE
    assert metrics.accuracy(make_pairs([1, 2], [3, 4])).first().ME == 2
    assert metrics.accuracy(make_pairs([3, 4], [1, 2])).first().ME == -2


def test_results_table(spark):
    rows = [("B", "x", 0.9, 1.0, 1.0), ("A", "y", 0.9, 1.0, 1.0), ("A", "x", 0.80005, 1.0, 1.0), ("A", "z", None, 1.0, 1.0)]
    table = metrics.results_table(spark.createDataFrame(rows, "series_id string, model string, MASE double, RMSE double, MAE double"))
    assert [(r.series_id, r.model) for r in table.collect()] == [("A", "x"), ("A", "y"), ("A", "z"), ("B", "x")]
    assert table.first().MASE == 0.8
    with pytest.raises(ValueError, match="missing columns"):
        metrics.results_table(spark.createDataFrame([("A",)], "series_id string"))
    best = {r.series_id: r.model for r in metrics.best_model(table).collect()}
    assert best == {"A": "x", "B": "x"}
    assert {r.model: r.MASE for r in metrics.model_means(table).collect()}["x"] == pytest.approx(0.85)


def test_rolling_mase(make_weekly, make_pairs):
    pairs = make_pairs([10, 12, 11, 13, 15, 14], [11, 12, 13, 13, 10, 14])
    train = [10, 12, 14, 16]
    rows = values(metrics.rolling_mase(pairs, make_weekly({"S": train})), "rolling_mase", order=("forecast_date",))
    assert rows[:3] == [None, None, None]
    assert rows[3:] == pytest.approx([3 / 4 / 2, 7 / 4 / 2, 7 / 4 / 2])


def test_rolling_mase_zero_scale_divides_by_one(make_weekly, make_pairs):
    rows = values(metrics.rolling_mase(make_pairs([1] * 4, [3] * 4), make_weekly({"S": [5, 5, 5]})), "rolling_mase", order=("forecast_date",))
    assert rows[3] == 2


def test_metrics_by_horizon(make_weekly, make_pairs):
    pairs = make_pairs(range(13), [v + 1 for v in range(13)])
    rows = metrics.metrics_by_horizon(pairs, make_weekly({"S": [1, 2, 3]})).orderBy("horizon").collect()
    assert [(r.horizon, r.MAE, r.MASE) for r in rows] == [(4, 1, 1), (8, 1, 1), (13, 1, 1)]


def test_bands(spark):
    rows = [("A", "m", v) for v in (0.5, 0.8, 1.0, 1.15)] + [("A", "m", None)]
    banded = metrics.accuracy_band(spark.createDataFrame(rows, "series_id string, model string, MASE double"))
    assert [r.band for r in banded.collect()] == ["Excellent", "Good", "Marginal", "Poor", None]


def test_seasonal_naive_repeats_the_season(make_weekly):
    history = make_weekly({"A": range(60), "B": range(5)})
    out = forecasts.seasonal_naive(history, 55)
    a = values(out.where("series_id = 'A'"), "predicted_value", order=("horizon",))
    assert a[:3] == [8, 9, 10] and a[51] == 59 and a[52] == 8 and len(a) == 55
    b = values(out.where("series_id = 'B'"), "predicted_value", order=("horizon",))
    assert b[:7] == [0, 1, 2, 3, 4, 0, 1]
    first = out.where("series_id = 'A' and horizon = 1").first()
    assert first.forecast_date == week(60)


def test_drift_line(make_weekly):
    out = forecasts.drift_line(make_weekly({"A": range(20), "B": [4, 5], "C": range(20, 0, -1)}), 3)
    rows = {(r.series_id, r.horizon): r.predicted_value for r in out.collect()}
    assert rows["A", 2] == pytest.approx(19 + 2 * 7 / 8)
    assert rows["B", 3] == 5
    assert rows["C", 3] == 0.0


def test_assembled_rows_follow_the_dates(make_weekly):
    history, test = make_weekly({"A": range(60)}), make_weekly({"A": [None] * 60 + [1, 2, 3, 4]})
    rows = forecasts.assemble_rows(forecasts.seasonal_naive(history, 3), test, "v1").orderBy("horizon").collect()
    assert [(r.horizon, r.forecast_date, r.predicted_value) for r in rows] == [
        (1, week(60), 8.0), (2, week(61), 9.0), (3, week(62), 10.0), (4, week(63), None),
    ]
    longer = forecasts.assemble_rows(forecasts.seasonal_naive(history, 9), test, "v1")
    assert longer.count() == 4


def test_bounds_range_and_horizon(make_weekly):
    history = make_weekly({"A": range(60)})
    out = forecasts.heuristic_bounds(forecasts.seasonal_naive(history, 8))
    row = out.where("horizon = 1").first()
    assert (row.lower_bound, row.upper_bound) == pytest.approx((8 * 0.88, 8 * 1.12))
    assert forecasts.first_horizon(out, 4).count() == 4
    pairs = forecasts.with_actuals(out, make_weekly({"A": [None] * 60 + [100]}))
    span = forecasts.value_range(pairs).first()
    assert (span.low, span.high) == (8, 100)
