"""Registered queries: every operator applied to the star tables of one data folder."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from weeklens.config import SEASON, TEST_WEEKS, SeasonalArConfig, work_path
from weeklens.functions.numeric import chi_square_tail
from weeklens.operators import (
    additive, correlation, decompose, features, forecasts, inventory, metrics, monitoring, registry, sar, sma, split,
    weekly, window_model,
)
from weeklens.plans import jobs
from weeklens.sources import files, star, store
from weeklens.sources.calendar import event_weeks, holiday_table
from weeklens.streaming import weekly as stream

ONE_SERIES = "ASIA_1__BUILDING"
SERIES_LIST = ("ASIA_1__BUILDING", "EUROPE_1__MACHINERY", "AFRICA_1__FURNITURE")
STATES = star.REGION_STATES
DIGITS = 6
#: Values that come out of a solved system are compared with fewer digits.
MODEL_DIGITS = 3


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Doubles at a fixed number of digits and without negative zero, so engines agree on equal results."""
    doubles = {
        f.name: F.round(f.name, digits) + F.lit(0.0) for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)
    }
    return df.withColumns(doubles) if doubles else df


class Inputs:
    """Frames shared by the queries over one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir

    def written(self, df: DataFrame, name: str) -> DataFrame:
        """The frame as a table in the shared work folder, so that later branches read the result."""
        path = work_path(self.spark, name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    @cached_property
    def calendar(self) -> DataFrame:
        """Calendar rows, one per day of the span: found by one scan of the shipping days, then a small table."""
        return self.written(star.calendar(self.spark, self.sf_dir), "calendar")

    @cached_property
    def daily(self) -> DataFrame:
        return star.daily_sales(self.spark, self.sf_dir)

    @cached_property
    def weekly(self) -> DataFrame:
        return weekly.weekly_sales(self.daily, self.calendar, "date")

    @cached_property
    def series(self) -> DataFrame:
        return weekly.dense_series(self.weekly, self.calendar)

    @cached_property
    def dense(self) -> DataFrame:
        return weekly.dense_weekly(self.weekly, self.calendar)

    @cached_property
    def stored(self) -> DataFrame:
        """The dense series as a written table, for queries that read them in several branches.

        The fact tables are scanned once per query; what is read again is the weekly result.
        """
        return self.written(self.series, "series")

    @cached_property
    def labelled(self) -> DataFrame:
        return split.temporal_split(self.stored)

    @cached_property
    def train(self) -> DataFrame:
        return split.train_rows(self.labelled)

    @cached_property
    def known(self) -> DataFrame:
        return self.labelled.where(F.col("split") != "test")

    @cached_property
    def test(self) -> DataFrame:
        return self.labelled.where(F.col("split") == "test")

    @cached_property
    def forecasts(self) -> DataFrame:
        """Two baselines from the last week before the test window."""
        return forecasts.union_forecasts(
            forecasts.seasonal_naive(self.known, TEST_WEEKS), forecasts.drift_line(self.known, TEST_WEEKS)
        )

    @cached_property
    def pairs(self) -> DataFrame:
        return forecasts.with_actuals(self.forecasts, self.test)

    @cached_property
    def results(self) -> DataFrame:
        return metrics.evaluate_models(self.pairs, self.train)

    @cached_property
    def history(self) -> DataFrame:
        """Errors of the last-year forecast in the weeks after training."""
        return monitoring.error_history(self.yearly_forecasts, self.stored, self.train)

    @cached_property
    def yearly_forecasts(self) -> DataFrame:
        return forecasts.one_step_seasonal(self.stored)

    @cached_property
    def psi(self) -> DataFrame:
        return monitoring.psi(self.train, weekly.last_rows(self.stored, TEST_WEEKS))

    @cached_property
    def checks(self) -> DataFrame:
        return monitoring.drift_checks(self.history, self.psi)

    @cached_property
    def parts(self) -> DataFrame:
        return decompose.decompose_ma(self.series)

    @cached_property
    def anomalies(self) -> DataFrame:
        return decompose.detect_anomalies(self.parts, event_weeks(self.calendar), sigmas=2.5)

    @cached_property
    def costs(self) -> DataFrame:
        return inventory.newsvendor(self.results.join(metrics.mean_demand(self.train), "series_id"))

    @cached_property
    def sar_params(self) -> DataFrame:
        return sar.sar_fit(self.known)

    @cached_property
    def sma_params(self) -> DataFrame:
        return self.written(sma.sma_fit(self.known), "sma_params")

    @cached_property
    def additive_params(self) -> DataFrame:
        return self.written(additive.additive_fit(self.known, self.calendar, STATES), "additive_params")

    @cached_property
    def window_model(self) -> window_model.WindowModel:
        return window_model.window_fit(self.labelled)

    def fitted(self) -> jobs.Models:
        rows = window_model.window_rows(self.window_model, split.scaler_params(self.labelled))
        return jobs.Models(self.sar_params, self.additive_params, rows)

    def forecast_store(self) -> store.ForecastTable:
        """Two appended versions of the baseline forecasts, the later one with bounds."""
        table = store.ForecastTable(self.spark, work_path(self.spark, "forecasts"))
        first = self.forecasts.withColumn("model_version", F.lit("v1"))
        second = forecasts.heuristic_bounds(self.forecasts).withColumn("model_version", F.lit("v2"))
        table.append(first, F.lit("2001-08-06 00:00:00").cast("timestamp"))
        table.append(second, F.lit("2001-08-13 00:00:00").cast("timestamp"))
        return table

    @cached_property
    def runs(self) -> DataFrame:
        """One run per series and quarter: MASE of the last-year forecast in that quarter."""
        known = forecasts.with_actuals(self.yearly_forecasts, self.stored)
        quarter = (F.year("forecast_date") * 4 + F.quarter("forecast_date")).cast("bigint")
        scores = known.groupBy("series_id", "model_type", quarter.alias("seq")).agg(
            F.avg(F.abs(F.col("predicted_value") - F.col("actual"))).alias("mae")
        )
        scaled = scores.join(metrics.naive_scale(self.train), "series_id").select(
            "seq", "series_id", "model_type", F.round(F.col("mae") / F.col("naive_mae"), DIGITS).alias("val_mase")
        )
        return registry.candidate_runs(scaled)

    @cached_property
    def decided(self) -> DataFrame:
        return registry.replay(self.runs)

    @cached_property
    def staged(self) -> DataFrame:
        return registry.stages(self.decided)

    def wide_csv(self) -> str:
        """Writes wide daily sales as CSV: one row per item and store, one column per calendar day."""
        days = self.calendar.count()
        keyed = self.daily.withColumns(
            {"id": F.concat_ws("_", "item_id", "store_id"), "dept_id": F.concat("cat_id", F.lit("_1"))}
        ).join(self.calendar.select("date", F.substring("d", 3, 9).cast("int").alias("day")), "date")
        ids = list(files.WIDE_ID_COLUMNS)
        sold = keyed.groupBy(*ids, "day").agg(F.sum("sales").alias("sales"))
        # The days without sales are filled in within the row: a zero for each day, dropped where the day has sales.
        zeros = F.transform(F.sequence(F.lit(1), F.lit(days)), lambda d: F.struct(d.alias("day"), F.lit(1).alias("empty"), F.lit(0).cast("bigint").alias("sales")))
        cells = F.collect_list(F.struct("day", F.lit(0).alias("empty"), "sales"))
        rows = sold.groupBy(*ids).agg(F.array_sort(F.concat(cells, zeros)).alias("cells"))
        first = F.filter("cells", lambda c, i: (c["empty"] == 0) | (i == 0) | (F.get("cells", i - 1)["day"] != c["day"]))
        line = F.concat_ws(",", *ids, F.transform(first, lambda c: c["sales"].cast("string")))
        header = ",".join([*ids, *[f"{files.DAY_PREFIX}{i + 1}" for i in range(days)]])
        path = work_path(self.spark, "sales_wide")
        # The lines hold their own commas, so the writer gets a separator that never occurs.
        rows.select(line.alias(header)).write.option("header", True).option("sep", "\u0001").csv(path)
        return path


def _dates(df: DataFrame) -> DataFrame:
    return df.withColumn("generated_at", F.to_date("generated_at"))


# -- sources and sinks ---------------------------------------------------------------------------


def wide_scan(d: Inputs) -> DataFrame:
    path = d.wide_csv()
    files.require_sources(d.spark, [path])
    return weekly.melt_wide(files.read_wide_sales(d.spark, path))


def wide_to_weekly(d: Inputs) -> DataFrame:
    melted = weekly.melt_wide(files.read_wide_sales(d.spark, d.wide_csv()))
    return weekly.weekly_sales(melted, d.calendar)


def calendar_scan(d: Inputs) -> DataFrame:
    path = work_path(d.spark, "calendar_csv")
    star.raw_calendar(d.spark, d.sf_dir).write.option("header", True).csv(path)
    return files.read_calendar(d.spark, path, STATES.values())


def sell_prices_scan(d: Inputs) -> DataFrame:
    """Cheapest unit price per part in cents, written as CSV and passed through."""
    lines = star.table(d.spark, d.sf_dir, "lineitem")
    price = F.floor(F.col("l_extendedprice") / F.col("l_quantity") * 100 + 0.5)
    prices = lines.groupBy(F.col("l_partkey").alias("item_id")).agg(F.min(price).alias("sell_price"))
    path = work_path(d.spark, "sell_prices")
    prices.write.option("header", True).csv(path)
    return files.read_sell_prices(d.spark, path, "item_id bigint, sell_price bigint")


def weekly_cached(d: Inputs) -> DataFrame:
    path = work_path(d.spark, "weekly_sales")
    files.read_through(d.spark, path, lambda: d.weekly)

    def missed() -> DataFrame:
        raise RuntimeError(f"no finished table in {path}")

    return files.read_through(d.spark, path, missed)


def calendar_cached(d: Inputs) -> DataFrame:
    return files.read_through(d.spark, work_path(d.spark, "calendar"), lambda: d.calendar, force_reload=True)


def dashboard_scan(d: Inputs) -> DataFrame:
    """Cached tables with dates kept as text, coerced on reading."""
    sales_path, calendar_path = work_path(d.spark, "weekly_text"), work_path(d.spark, "calendar_text")
    d.weekly.withColumn("week_start", F.col("week_start").cast("string")).write.parquet(sales_path)
    texts = {c: F.col(c).cast("string") for c in ("date", "week_start")}
    d.calendar.withColumns(texts).write.parquet(calendar_path)
    sales, calendar = files.read_dashboard_tables(d.spark, sales_path, calendar_path)
    first_days = calendar.groupBy("week_start").agg(F.min("date").alias("first_date"))
    return sales.join(first_days, "week_start").select("series_id", "week_start", "first_date", "total_sales")


def store_export(d: Inputs) -> DataFrame:
    path = work_path(d.spark, "forecast_export")
    d.forecast_store().export(path)
    other = store.ForecastTable(d.spark, work_path(d.spark, "forecasts_imported"))
    other.import_from(path)
    return _dates(other.scan())


def params_scan(d: Inputs) -> DataFrame:
    """Seasonal autoregression coefficients of two versions, read back as the newest."""
    path = work_path(d.spark, "params")
    for version, stamp, rows in (("v9", "2001-01-01", d.train), ("monthly", "2001-08-06", d.known)):
        fitted = sar.sar_fit(rows).select(
            "series_id",
            F.lit(sar.MODEL).alias("model_type"),
            F.lit(version).alias("version"),
            F.lit(stamp).cast("timestamp").alias("generated_at"),
            F.array("phi1", "phi_s").alias("coef"),
            "sigma2",
        )
        store.write_params(fitted, path)
    newest = store.latest_params(store.read_params(d.spark, path))
    return newest.select(
        "series_id", "model_type", "version", F.col("coef")[0].alias("phi1"), F.col("coef")[1].alias("phi_s"), "sigma2"
    )


def scaler_scan(d: Inputs) -> DataFrame:
    path = work_path(d.spark, "scaler")
    split.scaler_params(d.labelled).write.parquet(path)
    return d.spark.read.parquet(path)


def results_csv(d: Inputs) -> DataFrame:
    path = work_path(d.spark, "results_csv")
    files.write_results_csv(metrics.results_table(d.results, 3), path)
    schema = "series_id string, model string, MASE double, RMSE double, MAE double, ME double"
    return d.spark.read.option("header", True).schema(schema).csv(path)


def retrain_source(d: Inputs) -> DataFrame:
    sales_path, calendar_path = work_path(d.spark, "weekly_sales"), work_path(d.spark, "calendar")
    d.series.write.parquet(sales_path)
    d.calendar.write.parquet(calendar_path)
    labelled, _ = jobs.load_for_retrain(d.spark, sales_path, calendar_path)
    return split.split_sizes(labelled)


# -- modelling -----------------------------------------------------------------------------------


def sar_residual_acf(d: Inputs) -> DataFrame:
    return correlation.acf(sar.sar_residuals(d.known, d.sar_params), nlags=40, value="residual")


def sar_diagnostics(d: Inputs) -> DataFrame:
    tested = correlation.ljung_box(sar.sar_residuals(d.known, d.sar_params))
    return tested.join(d.sar_params.select("series_id", "aic", "bic"), "series_id")


def sar_evaluation(d: Inputs) -> DataFrame:
    predicted = sar.sar_forecast(d.known, d.sar_params, TEST_WEEKS)
    return metrics.evaluate_models(forecasts.with_actuals(predicted, d.test), d.train)


def sma_coefficients(d: Inputs) -> DataFrame:
    return d.sma_params.select("series_id", *sma.COEFFICIENTS, "sigma2", "n_used", "aic", "bic", "error")


def sma_diagnostics(d: Inputs) -> DataFrame:
    tested = correlation.ljung_box(sma.sma_residuals(d.known, d.sma_params))
    return tested.join(d.sma_params.select("series_id", "aic", "bic"), "series_id")


def sma_evaluation(d: Inputs) -> DataFrame:
    predicted = sma.sma_forecast(d.known, d.sma_params, TEST_WEEKS)
    return metrics.evaluate_models(forecasts.with_actuals(predicted, d.test), d.train)


def additive_coefficients(d: Inputs) -> DataFrame:
    rows = d.additive_params.select("series_id", "n", "sigma2", F.posexplode("coef").alias("pos", "coef"))
    return rounded(rows.select("series_id", "n", (F.col("pos") + 1).alias("term"), "coef", "sigma2"), MODEL_DIGITS)


def additive_future(d: Inputs) -> DataFrame:
    ahead = forecasts.future_weeks(d.known, TEST_WEEKS)
    return rounded(additive.additive_forecast(ahead, d.additive_params, d.calendar, STATES), MODEL_DIGITS)


def additive_bounds(d: Inputs) -> DataFrame:
    """Forecasts from given changes of the trend, whose size widens the intervals."""
    n = additive.AdditiveConfig.changepoints
    bent = F.transform(
        "coef", lambda v, i: F.when((i >= 2) & (i < 2 + n), F.when((i + 1) % 2 == 0, -8.0).otherwise(10.0) * (i + 1)).otherwise(v)
    )
    ahead = forecasts.future_weeks(d.known, TEST_WEEKS)
    return rounded(additive.additive_forecast(ahead, d.additive_params.withColumn("coef", bent), d.calendar, STATES), MODEL_DIGITS)


def additive_parts(d: Inputs) -> DataFrame:
    return rounded(additive.additive_components(d.stored, d.additive_params, d.calendar, STATES), MODEL_DIGITS)


def additive_inside(d: Inputs) -> DataFrame:
    return rounded(additive.additive_in_sample(d.known, d.additive_params, d.calendar, STATES), MODEL_DIGITS)


def window_path(d: Inputs) -> DataFrame:
    """One row for each penalty, and which of them the validation weeks choose."""
    best = F.min_by("penalty", F.struct("val_loss", -F.col("penalty"))).over(Window.partitionBy(F.lit(0)))
    return window_model.window_path(d.labelled).select(
        "penalty", "train_loss", "val_loss", "intercept", (F.col("penalty") == best).alias("chosen")
    )


def window_weights(d: Inputs) -> DataFrame:
    """Weights of the model that the validation weeks choose."""
    path = window_model.window_path(d.labelled).agg(F.min_by("weights", F.struct("val_loss", -F.col("penalty"))).alias("weights"))
    size = F.size("weights")
    return path.select(size.alias("n"), F.posexplode("weights").alias("at", "weight")).select((F.col("n") - F.col("at")).alias("weeks_back"), "weight")


def window_future(d: Inputs) -> DataFrame:
    return window_model.window_forecast(d.known, split.scaler_params(d.labelled), d.window_model, TEST_WEEKS)


def window_future_trees(d: Inputs) -> DataFrame:
    model = window_model.window_fit_trees(d.labelled)
    return window_model.window_forecast_trees(d.known, split.scaler_params(d.labelled), model, TEST_WEEKS)


def window_history(d: Inputs) -> DataFrame:
    model = window_model.window_fit(d.labelled, solver="l-bfgs")
    rows = list(enumerate(float(v) for v in model.losses))
    return d.spark.createDataFrame(rows, "iteration int, loss double")


def prediction_pairs(d: Inputs) -> DataFrame:
    return d.pairs.select("series_id", "model_type", "forecast_date", "actual", "predicted_value")


def retrain_runs(d: Inputs) -> DataFrame:
    _, runs = jobs.retrain(d.labelled, d.calendar, STATES, seq=1)
    return rounded(runs.select("series_id", "model_type", "val_mase", "stage"), MODEL_DIGITS)


def score_next_weeks(d: Inputs) -> DataFrame:
    fitted = d.fitted().stored(d.spark, work_path(d.spark, "models"))
    return rounded(jobs.score_next_weeks(d.stored, d.calendar, STATES, fitted, "v1"), MODEL_DIGITS)


def stored_scoring(d: Inputs) -> DataFrame:
    """Coefficients written to the parameter table, read back and used for the weeks after the last one."""
    path = work_path(d.spark, "params")
    fitted = sar.sar_fit(d.stored)
    rows = fitted.select(
        "series_id",
        F.lit(sar.MODEL).alias("model_type"),
        F.lit("v1").alias("version"),
        F.lit("2001-11-05").cast("timestamp").alias("generated_at"),
        F.array("phi1", "phi_s").alias("coef"),
        "sigma2",
    )
    store.write_params(rows, path)
    return sar.sar_forecast(d.stored, jobs.stored_sar(d.spark, path), TEST_WEEKS)


def saved_models(d: Inputs) -> str:
    """A parameter table with two versions of all models; the first one's numbers are all zero."""
    path = work_path(d.spark, "params")
    fitted = d.fitted()
    store.write_params(fitted.params("v2", F.lit("2001-08-06").cast("timestamp")), path)
    older = fitted.params("v9", F.lit("2001-01-01").cast("timestamp")).withColumn("coef", F.transform("coef", lambda v: v * 0))
    store.write_params(older, path)
    return path


def stored_models(d: Inputs) -> DataFrame:
    """Forecasts by all models as they come back from the parameter table."""
    models = jobs.load_models(d.spark, saved_models(d))
    return rounded(jobs.forecast_models(d.known, models, TEST_WEEKS, d.calendar, STATES), MODEL_DIGITS)


def weekly_scoring(d: Inputs) -> DataFrame:
    """The forecast store after the scoring job has run twice with one version."""
    out, stamp = work_path(d.spark, "scoring"), F.lit("2001-08-06").cast("timestamp")
    history = d.written(d.known.drop("split", "too_short"), "known")
    path = saved_models(d)
    for _ in range(2):
        jobs.scoring_job(d.spark, history, d.calendar, STATES, path, out, "v1", stamp)
    return rounded(_dates(store.ForecastTable(d.spark, f"{out}/forecasts").scan()), MODEL_DIGITS)


def eda_tables(d: Inputs) -> DataFrame:
    """Row counts of the exploratory reports."""
    reports = jobs.eda_report(d.stored, d.calendar, work_path(d.spark, "eda"))
    counts = [r.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("report"), "n_rows") for name, r in reports.items()]
    return reduce(DataFrame.unionByName, counts)


def full_run(d: Inputs) -> DataFrame:
    out = work_path(d.spark, "run")
    stamp = F.lit("2001-11-05 00:00:00").cast("timestamp")
    return jobs.run_all(d.spark, d.dense, d.calendar, STATES, out, stamp)


# -- monitoring ----------------------------------------------------------------------------------


def proxy_checks(d: Inputs) -> DataFrame:
    return monitoring.drift_checks(monitoring.proxy_history(d.forecast_store().latest(), 8))


def drift_job_alerts(d: Inputs) -> DataFrame:
    _, alerts = jobs.drift_job(d.yearly_forecasts.withColumns(
        {"model_version": F.lit("v1"), "generated_at": F.lit("2001-11-05").cast("timestamp")}
    ), d.stored, d.train)
    return alerts.select("series_id", "model_type", "alert_type", "action", "metric_value")


def monitoring_source(d: Inputs) -> DataFrame:
    table = d.forecast_store()
    rows = store.latest_forecasts(table.read(series_id=ONE_SERIES))
    return monitoring.proxy_history(rows).select("series_id", "model_type", "forecast_date", "error", "mase")


def unscored_decisions(d: Inputs) -> DataFrame:
    """The run history with some scores missing: NULL in every fifth quarter, not a number in the one after."""
    mase = (
        F.when(F.col("seq") % 5 == 0, F.lit(None).cast("double"))
        .when(F.col("seq") % 5 == 1, F.lit(float("nan")))
        .otherwise(F.col("val_mase"))
    )
    decided = registry.replay(registry.candidate_runs(d.runs.select("seq", *registry.KEY, mase.alias("val_mase"))))
    return decided.select("seq", *registry.KEY, "val_mase", "promoted", "champion_mase", "reason")


def model_coverage(d: Inputs) -> DataFrame:
    """Forecast rows and values of every series where three of them are only 32 weeks long and the additive model has none of these."""
    week = F.row_number().over(Window.partitionBy("series_id").orderBy("week_start"))
    cut = d.stored.withColumn("at", week).where(~F.col("series_id").isin(*SERIES_LIST) | (F.col("at") <= 32)).drop("at")
    weights = window_model.WindowModel((1.0 / SEASON,) * SEASON, 0.0, ())
    scaler = d.labelled.select("series_id").distinct().withColumns({"data_min": F.lit(0.0), "data_max": F.lit(1.0)})
    fitted_for_some = additive.additive_fit(d.known.where(~F.col("series_id").isin(*SERIES_LIST)), d.calendar, STATES)
    frames = (
        sar.sar_forecast(cut, sar.sar_fit(cut), TEST_WEEKS), sma.sma_forecast(cut, sma.sma_fit(cut), TEST_WEEKS),
        window_model.window_forecast(cut, scaler, weights, TEST_WEEKS),
        additive.additive_forecast(forecasts.future_weeks(cut, TEST_WEEKS), fitted_for_some, d.calendar, STATES),
    )
    rows = forecasts.union_forecasts(*frames).select("series_id", F.col("model_type").alias("model"), F.col("predicted_value").alias("value"))
    lags = correlation.pacf(cut).select("series_id", F.lit("pacf").alias("model"), F.col("pacf").alias("value"))
    return rows.unionByName(lags).groupBy("series_id", "model").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count("value").alias("n_values")
    )


def demand_limits(d: Inputs) -> DataFrame:
    return decompose.control_limits(d.parts)


def promotion_step(d: Inputs) -> DataFrame:
    """The last quarter's runs against the champions of all earlier quarters."""
    last = d.runs.groupBy("series_id", "model_type").agg(F.max("seq").alias("last_seq"))
    marked = d.runs.join(last, ["series_id", "model_type"])
    earlier = marked.where(F.col("seq") < F.col("last_seq"))
    current = registry.champions(registry.stages(registry.replay(earlier)))
    return registry.promote(current, marked.where(F.col("seq") == F.col("last_seq")))


# -- streaming -----------------------------------------------------------------------------------


def weekly_stream(d: Inputs) -> DataFrame:
    source = d.spark.readStream.schema(star.SCHEMAS["events"]).option("pathGlobFilter", "events.parquet").parquet(d.sf_dir)
    sink, mark = work_path(d.spark, "stream_weekly"), work_path(d.spark, "stream_mark")
    cents = source.select(F.col("ts").cast("timestamp").alias("ts"), "event_type", F.round(F.col("value") * 100).cast("bigint").alias("cents"))
    stream.drain_weekly_totals(cents, "event_type", "cents", sink, mark)
    return stream.read_weekly_totals(d.spark, sink, "event_type")


def drift_stream(d: Inputs) -> DataFrame:
    inbox = work_path(d.spark, "errors")
    rows = d.history.select(*monitoring.KEY, "forecast_date", "error", "mase", "mean_demand")
    rows.write.parquet(inbox)
    source = d.spark.readStream.schema(rows.schema).parquet(inbox)
    history, checks = work_path(d.spark, "error_history"), work_path(d.spark, "checks")
    stream.drain_drift_monitor(source, history, checks, work_path(d.spark, "stream_mark"))
    return stream.read_checks(d.spark, checks)


_BUILDERS: dict[str, Callable[[Inputs], DataFrame]] = {
    # sources and sinks
    "wide_scan": wide_scan,
    "wide_to_weekly": wide_to_weekly,
    "calendar_scan": calendar_scan,
    "calendar_flags": lambda d: star.calendar(d.spark, d.sf_dir),
    "sell_prices_scan": sell_prices_scan,
    "weekly_cached": weekly_cached,
    "calendar_cached": calendar_cached,
    "dashboard_scan": dashboard_scan,
    "store_scan": lambda d: _dates(d.forecast_store().scan()),
    "store_filtered": lambda d: _dates(
        d.forecast_store().read(ONE_SERIES, "drift", "v2", start_date="2001-08-20", end_date="2001-10-15")
    ),
    "store_empty_filter": lambda d: _dates(d.forecast_store().read(series_id="", model_type="drift")),
    "store_export": store_export,
    "store_series": lambda d: d.forecast_store().all_series(),
    "latest_version": lambda d: d.forecast_store().latest_version(),
    "latest_forecasts": lambda d: _dates(d.forecast_store().latest()),
    "latest_forecasts_between": lambda d: _dates(d.forecast_store().latest("2001-08-20", "2001-10-15")),
    "params_scan": params_scan,
    "scaler_scan": scaler_scan,
    "results_csv": results_csv,
    "retrain_source": retrain_source,
    # weekly series
    "weekly_sales": lambda d: d.weekly,
    "daily_calendar_join": lambda d: weekly.join_calendar(d.daily, d.calendar, "date")
    .groupBy("state_id", "cat_id", "date", "week_id", "is_holiday")
    .agg(F.sum("sales").alias("sales")),
    "dense_weekly": lambda d: d.dense,
    "whole_weeks": lambda d: weekly.partial_weeks_dropped(d.weekly, d.calendar).select(
        "series_id", "week_start", "total_sales"
    ),
    "series_ids": lambda d: weekly.series_ids(d.weekly),
    "series_count": lambda d: weekly.series_count(d.weekly),
    "requested_series": lambda d: weekly.restrict_series(d.weekly, SERIES_LIST).select(
        "series_id", "week_start", "total_sales"
    ),
    "first_series": lambda d: weekly.restrict_series(d.written(d.weekly, "weekly"), first_n=5).select(
        "series_id", "week_start", "total_sales"
    ),
    "one_series": lambda d: weekly.one_series(d.weekly, ONE_SERIES),
    # features, split, scaling
    "features": lambda d: features.features(d.dense, STATES),
    "snap_weeks": lambda d: d.dense.select(
        "series_id", weekly.state_of("series_id").alias("state"), "week_start", weekly.snap_flag(STATES).alias("is_snap_week")
    ),
    "rolling_stats": lambda d: features.rolling_stats(d.series),
    "lag_difference": lambda d: features.lag_difference(d.series),
    "split_labels": lambda d: split.temporal_split(d.series).select("series_id", "week_start", "total_sales", "split", "too_short"),
    "split_sizes": lambda d: split.split_sizes(split.temporal_split(d.series)),
    "scaler_params": lambda d: split.scaler_params(split.temporal_split(d.series)),
    "scaled_series": lambda d: split.scale(
        d.labelled.select("series_id", "week_start", "split", "total_sales"), split.scaler_params(d.labelled)
    ),
    "scaled_in_place": lambda d: split.scale_in_place(split.temporal_split(d.series)).select("series_id", "week_start", "scaled"),
    "restored_series": lambda d: split.unscale(
        split.scale_in_place(d.labelled).select("series_id", "week_start", "scaled"), split.scaler_params(d.labelled)
    ),
    "training_windows": lambda d: split.training_windows(split.temporal_split(d.series)).select(
        "series_id", "week_start", F.array_join("inputs", ",").alias("inputs"), "target"
    ),
    "validation_windows": lambda d: split.validation_windows(split.temporal_split(d.series)).select(
        "series_id", "week_start", F.array_join("inputs", ",").alias("inputs"), "target"
    ),
    # forecasts and accuracy
    "seasonal_naive": lambda d: forecasts.seasonal_naive(d.known, 60),
    "drift_line": lambda d: forecasts.drift_line(d.known, TEST_WEEKS),
    "future_weeks": lambda d: forecasts.future_weeks(d.series, TEST_WEEKS),
    "assembled_rows": lambda d: forecasts.assemble_rows(
        forecasts.seasonal_naive(d.known, 10), d.test, "v1"
    ),
    "heuristic_bounds": lambda d: forecasts.heuristic_bounds(d.forecasts),
    "first_horizon": lambda d: forecasts.first_horizon(d.forecasts, 8),
    "forecast_actuals": prediction_pairs,
    "value_range": lambda d: forecasts.value_range(d.pairs),
    "accuracy": lambda d: metrics.accuracy(d.pairs),
    "naive_scale": lambda d: metrics.naive_scale(d.train),
    "model_results": lambda d: d.results,
    "results_order": lambda d: metrics.results_table(d.results, 12),
    "best_model": lambda d: metrics.best_model(d.results),
    "model_means": lambda d: metrics.model_means(d.results),
    "mean_demand": lambda d: metrics.mean_demand(d.train),
    "series_results": lambda d: metrics.series_results(d.results, ONE_SERIES),
    "accuracy_bands": lambda d: metrics.accuracy_band(d.results).select("series_id", "model", "band"),
    "rolling_mase": lambda d: metrics.rolling_mase(
        forecasts.with_actuals(d.yearly_forecasts, d.stored), d.train
    ),
    "metrics_by_horizon": lambda d: metrics.metrics_by_horizon(d.pairs, d.train),
    # exploration
    "decompose_ma": lambda d: d.parts,
    "decompose_stl": lambda d: rounded(decompose.decompose_stl(d.series), MODEL_DIGITS),
    "decompose_stl_plain": lambda d: decompose.decompose_stl(d.series, robust=False),
    "residual_stats": lambda d: decompose.residual_stats(d.parts),
    "control_limits": demand_limits,
    "anomalies": lambda d: d.anomalies,
    "anomaly_counts": lambda d: decompose.anomaly_counts(d.anomalies),
    "anomaly_summary": lambda d: decompose.anomaly_summary(d.anomalies),
    "anomalies_without_calendar": lambda d: decompose.anomaly_summary(decompose.detect_anomalies(d.parts, None, 2.5)),
    "anomalies_stl": lambda d: rounded(
        decompose.detect_anomalies(decompose.decompose_stl(d.series), event_weeks(d.calendar)), MODEL_DIGITS
    ),
    "event_weeks": lambda d: event_weeks(d.calendar),
    "acf": lambda d: correlation.acf(d.series),
    "pacf": lambda d: correlation.pacf(d.series),
    "adf_test": lambda d: correlation.adf_test(d.series).select(
        "series_id", "test_stat", "p_value", "lags_used", "n_used", "status",
        *[F.col("critical_values")[f"{level}%"].alias(f"critical_{level}") for level in (1, 5, 10)], "error",
    ),
    # models
    "sar_fit": lambda d: d.sar_params,
    "sar_residuals": lambda d: sar.sar_residuals(d.known, d.sar_params),
    "sar_forecast": lambda d: sar.sar_forecast(d.known, d.sar_params, TEST_WEEKS),
    "sar_evaluation": sar_evaluation,
    "sar_diagnostics": sar_diagnostics,
    "sar_residual_acf": sar_residual_acf,
    "sma_fit": sma_coefficients,
    "sma_residuals": lambda d: sma.sma_residuals(d.known, d.sma_params),
    "sma_forecast": lambda d: sma.sma_forecast(d.known, d.sma_params, TEST_WEEKS),
    "sma_evaluation": sma_evaluation,
    "sma_diagnostics": sma_diagnostics,
    "design_input": lambda d: additive.design_input(d.train),
    "holiday_table": lambda d: holiday_table(d.calendar, STATES),
    "additive_fit": additive_coefficients,
    "additive_forecast": additive_future,
    "additive_bounds": additive_bounds,
    "additive_components": additive_parts,
    "additive_in_sample": additive_inside,
    "window_path": window_path,
    "window_weights": window_weights,
    "window_losses": lambda d: window_model.window_losses(d.labelled, d.window_model),
    "window_forecast": window_future,
    "window_forecast_trees": window_future_trees,
    "window_history": window_history,
    # monitoring and cost
    "error_history": lambda d: d.history.select("series_id", "model_type", "forecast_date", "error", "mase", "rank"),
    "monitoring_source": monitoring_source,
    "mase_check": lambda d: monitoring.mase_check(d.history),
    "bias_check": lambda d: monitoring.bias_check(d.history),
    "histogram_counts": lambda d: monitoring.histogram_counts(d.train, d.test).select(
        "series_id",
        F.array_join("reference_counts", ",").alias("reference_counts"),
        F.array_join("current_counts", ",").alias("current_counts"),
    ),
    "psi": lambda d: d.psi,
    "drift_checks": lambda d: d.checks,
    "active_checks": lambda d: monitoring.active(d.checks).select("series_id", "model_type", "mase_alert", "bias_alert", "psi_alert"),
    "proxy_checks": proxy_checks,
    "alert_rows": lambda d: monitoring.alert_rows(d.checks),
    "mase_warnings": lambda d: monitoring.mase_warnings(d.history),
    "health_table": lambda d: monitoring.health_table(d.history),
    "health_counts": lambda d: monitoring.health_counts(monitoring.health_table(d.history)),
    "newsvendor": lambda d: d.costs,
    "newsvendor_by_share": lambda d: inventory.newsvendor(
        d.results.join(metrics.mean_demand(d.train), "series_id"),
        F.when(F.col("model") == "drift", F.lit(8.0)).otherwise(F.lit(3.0)),
        F.lit(2.0),
    ).select("series_id", "model", "critical_ratio", "order_quantity", "expected_cost"),
    "cost_spread": lambda d: inventory.cost_spread(d.costs),
    "cheapest_and_dearest": lambda d: inventory.cheapest_and_dearest(d.costs),
    # registry and jobs
    "candidate_runs": lambda d: d.runs.select("seq", "series_id", "model_type", "run_id", "val_mase", "stage"),
    "run_decisions": lambda d: d.decided.select("seq", "series_id", "model_type", "val_mase", "promoted", "champion_mase"),
    "run_stages": lambda d: d.staged.select("seq", "series_id", "model_type", "stage"),
    "champion_runs": lambda d: registry.list_production(d.staged),
    "champion_of_series": lambda d: registry.production_run(d.staged, ONE_SERIES, "seasonal_naive"),
    "promotion_step": promotion_step,
    "unscored_decisions": unscored_decisions,
    "model_coverage": model_coverage,
    "rollback_alerts": lambda d: registry.rollback_alerts(d.decided).select(
        "seq", "series_id", "alert_type", "metric_value", "kept_run"
    ),
    "retrain_summary": lambda d: jobs.retrain_summary(d.decided),
    "retrain_runs": retrain_runs,
    "score_next_weeks": score_next_weeks,
    "stored_scoring": stored_scoring,
    "unfitted_series": lambda d: store.missing_params(d.weekly, d.sar_params.where(~F.col("series_id").isin(*SERIES_LIST))),
    "stored_models": stored_models,
    "weekly_scoring": weekly_scoring,
    "drift_job_alerts": drift_job_alerts,
    "eda_tables": eda_tables,
    "full_run": full_run,
    # streaming
    "weekly_stream": weekly_stream,
    "drift_stream": drift_stream,
}


def _query(build: Callable[[Inputs], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: rounded(build(Inputs(spark, sf_dir)))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _query(build) for name, build in _BUILDERS.items()}
