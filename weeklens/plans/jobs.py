"""Batch jobs: retrain with champion selection, weekly scoring, drift check, full run.

Every job covers all series in one plan; tables between the steps are Parquet, so a lost executor costs
one stage and lineage never spans a whole job.
"""

from __future__ import annotations

import logging
from collections.abc import Iterable
from dataclasses import dataclass, fields, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weeklens.config import TEST_WEEKS, ModelDefaults, work_path
from weeklens.operators import additive, correlation, decompose, metrics, monitoring, registry, sar, window_model
from weeklens.operators.features import features, rolling_stats
from weeklens.operators.forecasts import (
    future_weeks, heuristic_bounds, seasonal_naive, union_forecasts, with_actuals,
)
from weeklens.operators.split import scaler_params, temporal_split, train_rows
from weeklens.operators.weekly import last_rows, restrict_series
from weeklens.sources.calendar import event_weeks
from weeklens.sources.files import path_exists, read_through, require_sources, write_results_csv
from weeklens.sources.store import (
    ForecastTable, latest_forecasts, latest_params, read_params, read_params_or_none, require_params, write_params,
)

log = logging.getLogger("weeklens")
ACF_LAGS = 60


@dataclass(frozen=True)
class Models:
    """Parameter tables of the three models, as forecasting reads them and the parameter table keeps them."""

    sar: DataFrame
    additive: DataFrame
    window: DataFrame

    def stored(self, spark: SparkSession, path: str) -> Models:
        """The same tables written once and read back; finished ones are read as they are."""
        table = lambda name: read_through(spark, f"{path}/{name}", lambda: getattr(self, name))
        return Models(table("sar"), table("additive"), table("window"))

    def params(self, version: str, generated_at: Column) -> DataFrame:
        """Rows of the parameter table, with all that ``load_models`` needs to rebuild each model."""

        def rows(frame: DataFrame, model: str, coef: Column, sigma2: Column, numbers: dict, texts: dict, names: Column) -> DataFrame:
            pairs = lambda d, kind: F.create_map(*[x for k, c in d.items() for x in (F.lit(k), c.cast(kind))]) if d else F.lit(None)
            return frame.select(
                "series_id", F.lit(model).alias("model_type"), F.lit(version).alias("version"), generated_at.alias("generated_at"),
                coef.alias("coef"), sigma2.cast("double").alias("sigma2"),
                pairs(numbers, "double").cast("map<string,double>").alias("numbers"),
                pairs(texts, "string").cast("map<string,string>").alias("texts"), names.cast("array<string>").alias("names"),
            )

        none = F.lit(None)
        columns = lambda *names: {n: F.col(n) for n in names}
        parts = (
            rows(self.sar, sar.MODEL, F.array("phi1", "phi_s"), F.col("sigma2"), {}, {}, none),
            rows(self.additive, additive.MODEL, F.col("coef"), F.col("sigma2"), columns("n"), columns("state", "first_week"), F.col("names")),
            rows(self.window, window_model.MODEL, F.col("coef"), none, columns("penalty", "data_min", "data_max"), {}, none),
        )
        return reduce(DataFrame.unionByName, parts)


def load_models(spark: SparkSession, path: str) -> Models:
    """The newest version of every series' models from the parameter table."""
    newest = latest_params(read_params(spark, path))
    of = lambda model: newest.where(F.col("model_type") == model)
    number = lambda name, kind="double": F.col("numbers")[name].cast(kind).alias(name)
    return Models(
        of(sar.MODEL).select("series_id", F.get("coef", F.lit(0)).alias("phi1"), F.get("coef", F.lit(1)).alias("phi_s"), "sigma2"),
        of(additive.MODEL).select(
            "series_id", F.col("texts")["state"].alias("state"), F.col("texts")["first_week"].cast("date").alias("first_week"),
            number("n", "bigint"), "names", "coef", "sigma2",
        ),
        of(window_model.MODEL).select("series_id", "coef", number("penalty"), number("data_min"), number("data_max")),
    )


def require_models(weekly: DataFrame, models: Models) -> None:
    """Forecasting a series before any of its models is fitted is an error that names the model and the series."""
    for model in fields(models):
        require_params(weekly, getattr(models, model.name), what=model.name)


def fit_models(
    labelled: DataFrame, calendar: DataFrame, states: dict[str, str], defaults: ModelDefaults = ModelDefaults()
) -> Models:
    """Fits all models on the training rows of a dense split frame.

    The window learner takes the penalty of the smallest validation loss; without validation weeks the configured one.
    """
    train = train_rows(labelled)
    return Models(
        sar.sar_fit(train, defaults.sar),
        additive.additive_fit(train, calendar, states, defaults.additive),
        window_model.window_rows(window_model.window_choose(labelled, defaults.window), scaler_params(labelled)),
    )


def forecast_models(
    history: DataFrame, models: Models, steps: int, calendar: DataFrame, states: dict[str, str],
    defaults: ModelDefaults = ModelDefaults(),
) -> DataFrame:
    """Forecasts of all models from the last history week of every series."""
    ahead = future_weeks(history, steps)
    return union_forecasts(
        sar.sar_forecast(history, models.sar, steps, defaults.sar),
        additive.additive_forecast(ahead, models.additive, calendar, states, defaults.additive),
        heuristic_bounds(window_model.window_forecast_rows(history, models.window, steps, defaults.window.window)),
    )


def _as_training(labelled: DataFrame, *splits: str) -> DataFrame:
    """Rows of the given splits, all marked as training rows."""
    return labelled.where(F.col("split").isin(list(splits))).withColumn("split", F.lit("train"))


def validation_scores(
    labelled: DataFrame, calendar: DataFrame, states: dict[str, str], fitted: Models,
    defaults: ModelDefaults = ModelDefaults(),
) -> DataFrame:
    """Validation MASE per series and model of forecasts that start at the end of training."""
    weeks = labelled.groupBy("series_id").agg(F.count_if(F.col("split") == "val").alias("n")).agg(F.max("n")).first()[0]
    predicted = forecast_models(train_rows(labelled), fitted, int(weeks), calendar, states, defaults)
    pairs = with_actuals(predicted, labelled.where(F.col("split") == "val"))
    return metrics.evaluate_models(pairs, train_rows(labelled))


def retrain(
    labelled: DataFrame, calendar: DataFrame, states: dict[str, str], seq: int,
    defaults: ModelDefaults = ModelDefaults(), path: str | None = None,
) -> tuple[Models, DataFrame]:
    """Fits on train, scores on val and returns the models, stored under ``path``, with their candidate runs."""
    spark = labelled.sparkSession
    fitted = fit_models(labelled, calendar, states, defaults).stored(spark, path or work_path(spark, "models"))
    scores = validation_scores(labelled, calendar, states, fitted, defaults).select(
        F.lit(seq).alias("seq"), "series_id", F.col("model").alias("model_type"), F.col("MASE").alias("val_mase")
    )
    return fitted, registry.candidate_runs(scores)


def retrain_summary(decided: DataFrame) -> DataFrame:
    """One line per retrained model over all model families."""
    return decided.select("series_id", F.col("model_type").alias("model"), "val_mase", "run_id", "promoted")


def load_for_retrain(
    spark: SparkSession, weekly_path: str, calendar_path: str
) -> tuple[DataFrame, DataFrame] | None:
    """Split weekly sales and calendar, or nothing (logged) when a source is missing."""
    try:
        require_sources(spark, [weekly_path, calendar_path])
    except FileNotFoundError as missing:
        log.warning("retrain skipped: %s", missing)
        return None
    return temporal_split(spark.read.parquet(weekly_path)), spark.read.parquet(calendar_path)


def score_next_weeks(
    weekly: DataFrame, calendar: DataFrame, states: dict[str, str], fitted: Models, version: str,
    steps: int = TEST_WEEKS, defaults: ModelDefaults = ModelDefaults(),
) -> DataFrame:
    """Store rows for the weeks after the last known one."""
    require_models(weekly, fitted)
    predicted = forecast_models(weekly, fitted, steps, calendar, states, defaults)
    return predicted.withColumn("model_version", F.lit(version))


def _append_once(table: ForecastTable, rows: DataFrame, version: str, generated_at: Column) -> None:
    """Appends a version's forecasts unless the table has them: an append is whole or not there."""
    if table.read(model_version=version).isEmpty():
        table.append(rows.withColumn("model_version", F.lit(version)), generated_at)


def scoring_job(
    spark: SparkSession, weekly: DataFrame, calendar: DataFrame, states: dict[str, str], params_path: str, out: str,
    version: str, generated_at: Column, steps: int = TEST_WEEKS, error_mode: str = "actual",
    defaults: ModelDefaults = ModelDefaults(),
) -> DataFrame:
    """Weekly scoring in one go: saved models, forecasts appended to ``out``/forecasts, drift checks, alerts.

    Returns the alerts, which are also written to ``out``/alerts/drift/``version``. Checks compare the newest forecasts of
    all versions with the weeks that are known by now. A repeated run of one version appends nothing twice.
    """
    table = ForecastTable(spark, f"{out}/forecasts")
    rows = score_next_weeks(weekly, calendar, states, load_models(spark, params_path), version, steps, defaults)
    _append_once(table, rows, version, generated_at)
    _, alerts = drift_job(table.latest(), weekly, train_rows(temporal_split(weekly)), error_mode)
    path = f"{out}/alerts/drift/{version}"
    alerts.write.mode("overwrite").parquet(path)
    return spark.read.schema(alerts.schema).parquet(path)


def drift_job(
    forecasts: DataFrame, weekly: DataFrame, train: DataFrame, error_mode: str = "actual", weeks: int = 8,
    recent_weeks: int = 4,
) -> tuple[DataFrame, DataFrame]:
    """Active checks and alert rows of the forecasts in the store."""
    newest = latest_forecasts(forecasts)
    if error_mode == "actual":
        history = monitoring.error_history(newest, weekly, train, weeks)
    elif error_mode == "interval_proxy":
        history = monitoring.proxy_history(newest, weeks)
    else:
        raise ValueError(f"unknown error_mode {error_mode!r}")
    shift = monitoring.psi(train, last_rows(weekly, recent_weeks))
    checks = monitoring.active(monitoring.drift_checks(history, shift))
    return checks, monitoring.alert_rows(checks)


def eda_report(weekly: DataFrame, calendar: DataFrame, path: str) -> dict[str, DataFrame]:
    """All exploratory reports of every series, written as one table each; finished tables are read as they are.

    Anomalies read the stored decomposition, and both correlation reports the stored autocorrelations.
    """
    spark = weekly.sparkSession

    def table(frame: DataFrame, name: str) -> DataFrame:
        return read_through(spark, f"{path}/{name}", lambda: frame)

    stl = table(decompose.decompose_stl(weekly), "stl")
    correlations = table(correlation.autocorrelations(weekly, ACF_LAGS), "autocorrelations")
    return {
        "stl": stl,
        "anomalies": table(decompose.detect_anomalies(stl, event_weeks(calendar)), "anomalies"),
        "acf": table(correlation.acf_rows(correlations), "acf"),
        "pacf": table(correlation.pacf_rows(correlations, ACF_LAGS), "pacf"),
        "adf": table(correlation.adf_test(weekly), "adf"),
        "rolling": table(rolling_stats(weekly), "rolling"),
    }


def decide(spark: SparkSession, candidates: DataFrame, out: str, seq: int, last_seq: int | None) -> DataFrame:
    """Decisions on the candidates of run ``seq`` against the champions of run ``last_seq``; finished tables stay."""
    if last_seq is None:
        current = candidates.select(*registry.KEY, "run_id", "val_mase").limit(0)
    else:
        current = spark.read.parquet(f"{out}/champions/v{last_seq}")
    decided = read_through(spark, f"{out}/decisions/v{seq}", lambda: registry.promote(current, candidates))
    read_through(spark, f"{out}/champions/v{seq}", lambda: registry.next_champions(current, decided))
    return decided


def _published(spark: SparkSession, out: str) -> int | None:
    """The last run of the folder that came to its end."""
    if not path_exists(spark, f"{out}/published"):
        return None
    return spark.read.schema("seq bigint").parquet(f"{out}/published").agg(F.max("seq")).first()[0]


def _publish(spark: SparkSession, out: str, seq: int) -> None:
    """The run's last step: from here on it counts."""
    spark.range(1).select(F.lit(seq).cast("bigint").alias("seq")).write.mode("append").parquet(f"{out}/published")


def _next_run(spark: SparkSession, out: str, seq: int) -> int | None:
    last_seq = _published(spark, out)
    if last_seq is not None and seq <= last_seq:
        raise ValueError(f"run {seq} is not above the last run, {last_seq}")
    return last_seq


def _promoted(
    labelled: DataFrame, calendar: DataFrame, states: dict[str, str], out: str, seq: int, last_seq: int | None, defaults: ModelDefaults
) -> tuple[Models, DataFrame]:
    """Models fitted on train, and the decisions on them; run log, stages and rollback alerts are written."""
    spark = labelled.sparkSession
    judged, scored = retrain(labelled, calendar, states, seq, defaults, f"{out}/judged/v{seq}")
    candidates = read_through(spark, f"{out}/candidates/v{seq}", lambda: scored)
    decided = decide(spark, candidates, out, seq, last_seq)
    runs = registry.RunTable(spark, f"{out}/runs")
    if runs.scan().where(F.col("seq") == seq).isEmpty():
        runs.log(candidates)
    read_through(spark, f"{out}/alerts/rollback/v{seq}", lambda: registry.rollback_alerts(decided))
    return judged, decided


def _stages(spark: SparkSession, out: str) -> None:
    registry.stages(spark.read.parquet(f"{out}/decisions/*")).write.mode("overwrite").parquet(f"{out}/stages")


def retrain_job(
    spark: SparkSession, weekly: DataFrame, calendar: DataFrame, states: dict[str, str], out: str, generated_at: Column,
    seq: int, defaults: ModelDefaults = ModelDefaults(),
) -> DataFrame:
    """Retrains all models, promotes those that are not worse than their champions and saves them; returns the summary.

    Runs into one folder have rising ``seq``. A run that was cut off is called again with its ``seq``: finished steps are
    read, the others done, and nothing is appended twice.
    """
    last_seq = _next_run(spark, out, seq)
    judged, decided = _promoted(temporal_split(weekly), calendar, states, out, seq, last_seq, defaults)
    if read_params_or_none(spark, f"{out}/params", f"v{seq}") is None:
        write_params(judged.params(f"v{seq}", generated_at), f"{out}/params")
    _stages(spark, out)
    _publish(spark, out, seq)
    return retrain_summary(decided)


def run_all(
    spark: SparkSession, weekly: DataFrame, calendar: DataFrame, states: dict[str, str], out: str,
    generated_at: Column, with_eda: bool = True, seq: int = 1, defaults: ModelDefaults = ModelDefaults(),
    series: Iterable[str] | None = None, first_series: int | None = None,
) -> DataFrame:
    """Features, reports, retraining, champion selection, test scores, store and alerts; returns the results.

    Models are judged on val after training on train, then refitted on train + val before the test weeks. A folder
    takes any number of runs, each with a ``seq`` above those before: inputs are written anew, candidates meet the
    champions that the last run left, and results are those of this run's forecasts. ``series`` or the ``first_series``
    in order restrict the run. A run that was cut off is called again with its ``seq``: it goes on with the inputs that
    it has written, reads what is finished and appends nothing twice.
    """
    last_seq = _next_run(spark, out, seq)
    chosen = restrict_series(weekly, series, first_series)
    at = lambda name: f"{out}/{name}/v{seq}"
    weekly = read_through(spark, f"{at('inputs')}/weekly_sales", lambda: chosen)
    calendar_in = calendar
    calendar = read_through(spark, f"{at('inputs')}/calendar", lambda: calendar_in)
    read_through(spark, at("features"), lambda: features(weekly, states))
    labelled = temporal_split(weekly)
    if with_eda:
        eda_report(weekly, calendar, at("eda"))
    judged, _ = _promoted(labelled, calendar, states, out, seq, last_seq, defaults)

    known = _as_training(labelled, "train", "val")
    penalty = judged.window.agg(F.first("penalty")).first()[0]
    defaults = replace(defaults, window=replace(defaults.window, reg_param=penalty))
    refitted = fit_models(known, calendar, states, defaults).stored(spark, at("models"))
    if read_params_or_none(spark, f"{out}/params", f"v{seq}") is None:
        write_params(refitted.params(f"v{seq}", generated_at), f"{out}/params")
    predicted = union_forecasts(
        forecast_models(known, refitted, TEST_WEEKS, calendar, states, defaults), seasonal_naive(known, TEST_WEEKS)
    )
    store = ForecastTable(spark, f"{out}/forecasts")
    _append_once(store, predicted, f"v{seq}", generated_at)
    own = store.scan().where(F.col("model_version") == f"v{seq}")
    pairs = with_actuals(own, labelled.where(F.col("split") == "test"))
    results = metrics.results_table(metrics.evaluate_models(pairs, known))
    write_results_csv(results, at("evaluation_results"))
    _, alerts = drift_job(own, weekly, known)
    alerts.write.mode("overwrite").parquet(at("alerts/drift"))
    _stages(spark, out)
    _publish(spark, out, seq)
    return spark.read.option("header", True).schema(results.schema).csv(at("evaluation_results"))


def stored_sar(spark: SparkSession, path: str) -> DataFrame:
    """Seasonal autoregression parameters from the parameter table, newest version per series."""
    rows = latest_params(read_params(spark, path).where(F.col("model_type") == sar.MODEL))
    return rows.select("series_id", F.col("coef")[0].alias("phi1"), F.col("coef")[1].alias("phi_s"), "sigma2")

