import numpy as np
import pytest
from conftest import MONDAY, week
from pyspark.sql import functions as F

from weeklens.config import RETAIL_STATES, AdditiveConfig, ModelDefaults, SeasonalArConfig, WindowConfig
from weeklens.operators import registry, window_model
from weeklens.plans import jobs
from weeklens.sources.store import ForecastTable, read_params

SMALL = ModelDefaults(SeasonalArConfig(season=4), AdditiveConfig(changepoints=3, fourier_order=1), WindowConfig(window=4))


class Killed(Exception):
    pass


@pytest.fixture(scope="module")
def calendar(spark):
    days = spark.range(7 * 140).select(F.date_add(F.lit(MONDAY), F.col("id").cast("int")).alias("date"))
    flags = [F.lit(0).cast("tinyint").alias(c) for c in ("is_holiday", "is_thanksgiving", "is_black_friday")]
    return days.select(
        "date", F.lit(None).cast("string").alias("event_name_1"), F.date_trunc("week", "date").cast("date").alias("week_start"),
        F.concat(F.extract(F.lit("YEAROFWEEK"), F.col("date")), F.lit("-W"), F.lpad(F.weekofyear("date").cast("string"), 2, "0")).alias("week_id"),
        *[F.lit(0).cast("tinyint").alias(c) for c in RETAIL_STATES.values()], *flags,
    ).cache()


@pytest.fixture(scope="module")
def weekly(make_weekly, calendar):
    rng = np.random.default_rng(5)
    series = {f"{s}_1__{c}": (60 + 10 * np.sin(np.arange(110) / 2) + rng.normal(0, 4, 110)).tolist() for s in ("CA", "TX") for c in "AB"}
    weeks = calendar.select("week_start", "week_id", *RETAIL_STATES.values(), "is_holiday", "is_thanksgiving", "is_black_friday").distinct()
    return make_weekly(series).join(weeks, "week_start").cache()


def run(spark, weekly, calendar, out, **more):
    return jobs.run_all(spark, weekly, calendar, RETAIL_STATES, out, F.lit("2020-01-01").cast("timestamp"), with_eda=False, defaults=SMALL, **more)


def rows(df):
    return sorted(map(str, df.collect()))


STEPS = [
    (jobs, "validation_scores"), (jobs, "decide"), (registry.RunTable, "log"), (registry, "rollback_alerts"), (jobs, "write_params"),
    (jobs, "_append_once"), (jobs, "write_results_csv"), (jobs, "drift_job"), (jobs, "_stages"), (jobs, "_publish"),
]


@pytest.fixture(scope="module")
def whole(spark, weekly, calendar, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("whole") / "run")
    return out, rows(run(spark, weekly, calendar, out))


@pytest.mark.parametrize("when", ["before", "after"])
def test_a_run_killed_at_every_step_goes_on_to_the_same_results(spark, weekly, calendar, whole, tmp_path, monkeypatch, when):
    """One folder, killed at one step after the other, each time called again with the same number."""
    out = str(tmp_path / "run")
    for owner, name in STEPS:
        real = getattr(owner, name)

        def killed(*args, real=real, **more):
            if when == "after":
                real(*args, **more)
            raise Killed

        if (when, name) == ("after", "_publish"):
            continue
        with monkeypatch.context() as patch:
            patch.setattr(owner, name, killed)
            with pytest.raises(Killed):
                run(spark, weekly, calendar, out)
        assert jobs._published(spark, out) is None
    assert rows(run(spark, weekly, calendar, out)) == whole[1]
    for table in ("runs", "stages", "champions/v1", "decisions/v1", "candidates/v1", "forecasts", "params", "alerts/drift/v1"):
        got, want = (spark.read.parquet(f"{folder}/{table}") for folder in (out, whole[0]))
        assert got.count() == want.count(), table
    with pytest.raises(ValueError, match="run 1 is not above the last run, 1"):
        run(spark, weekly, calendar, out)


def test_series_selection(spark, weekly, calendar, tmp_path):
    out = str(tmp_path / "run")
    results = run(spark, weekly, calendar, out, series=["TX_1__A", "CA_1__B", "CA_1__A"], first_series=2).collect()
    assert {r.series_id for r in results} == {"CA_1__A", "CA_1__B"}


def test_retrain_promotes_and_scoring_uses_what_was_saved(spark, weekly, calendar, tmp_path):
    out, stamp = str(tmp_path / "job"), lambda day: F.lit(day).cast("timestamp")
    history = weekly.where(F.col("week_start") < F.lit(week(97)))
    first = jobs.retrain_job(spark, history, calendar, RETAIL_STATES, out, stamp("2020-01-01"), 1, SMALL).collect()
    assert len(first) == 12 and all(r.promoted for r in first)
    worse = history.withColumn("total_sales", F.when(F.col("week_start") >= F.lit(week(80)), F.col("total_sales") * 5).otherwise(F.col("total_sales")))
    second = jobs.retrain_job(spark, worse, calendar, RETAIL_STATES, out, stamp("2020-02-01"), 2, SMALL).collect()
    assert not all(r.promoted for r in second)
    assert read_params(spark, f"{out}/params").count() == 24

    models = jobs.load_models(spark, f"{out}/params")
    fitted, _ = jobs.retrain(jobs.temporal_split(worse), calendar, RETAIL_STATES, 3, SMALL)
    ahead = lambda m: rows(jobs.forecast_models(history, m, 6, calendar, RETAIL_STATES, SMALL).orderBy("series_id"))
    assert ahead(models) == ahead(fitted)

    score = lambda known, version, day: jobs.scoring_job(
        spark, known, calendar, RETAIL_STATES, f"{out}/params", out, version, stamp(day), 13, defaults=SMALL
    )
    assert score(history, "w1", "2020-03-01").count() == 0  # nothing that was forecast is known yet
    assert score(history, "w1", "2020-03-01").count() == 0
    table = ForecastTable(spark, f"{out}/forecasts").scan()
    assert table.count() == 3 * 4 * 13 and table.select("model_version").distinct().count() == 1
    shifted = weekly.withColumn("total_sales", F.when(F.col("week_start") >= F.lit(week(97)), F.col("total_sales") * 9).otherwise(F.col("total_sales")))
    alerts = score(shifted, "w2", "2020-06-01")
    assert alerts.where("alert_type = 'mase_alert'").count() > 0
    assert ForecastTable(spark, f"{out}/forecasts").scan().count() == 2 * 3 * 4 * 13


def test_use_before_fit_names_model_and_series(spark, weekly, calendar, tmp_path):
    out = str(tmp_path / "job")
    jobs.retrain_job(spark, weekly.where("series_id <> 'TX_1__B'"), calendar, RETAIL_STATES, out, F.lit("2020-01-01").cast("timestamp"), 1, SMALL)
    models = jobs.load_models(spark, f"{out}/params")
    with pytest.raises(RuntimeError, match="sar not fitted: TX_1__B"):
        jobs.score_next_weeks(weekly, calendar, RETAIL_STATES, models, "v1", defaults=SMALL)
    with pytest.raises(RuntimeError, match="window not fitted: TX_1__B"):
        jobs.require_models(weekly, jobs.Models(models.sar.unionByName(models.sar.withColumn("series_id", F.lit("TX_1__B"))),
                                                models.additive.unionByName(models.additive.withColumn("series_id", F.lit("TX_1__B"))), models.window))


def test_weights_of_each_series_version(spark, weekly):
    """Tables of window models may hold other weights for every series."""
    models = {s: window_model.WindowModel(tuple(w), a, ()) for s, w, a in (("CA_1__A", (0.1, 0.2, 0.3, 0.4), 0.0), ("CA_1__B", (0, 0, 0, 1.0), 0.5))}
    scaler = weekly.groupBy("series_id").agg(F.min("total_sales").alias("data_min"), F.max("total_sales").alias("data_max"))
    one = lambda s: scaler.where(F.col("series_id") == s)
    table = window_model.window_rows(models["CA_1__A"], one("CA_1__A")).unionByName(window_model.window_rows(models["CA_1__B"], one("CA_1__B")))
    got = window_model.window_forecast_rows(weekly, table, 5, 4)
    for s, m in models.items():
        assert rows(got.where(F.col("series_id") == s)) == rows(window_model.window_forecast(weekly.where(F.col("series_id") == s), scaler, m, 5))
    assert got.where("series_id like 'TX%' and predicted_value is null").count() == 10
