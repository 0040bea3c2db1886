"""Forecast frames: future dates, alignment with actuals, bounds, horizon cuts, baselines.

A forecast frame has series_id, model_type, horizon, forecast_date, predicted_value, lower_bound,
upper_bound. Horizon 1 is the week after the last history row of the series.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weeklens.config import SEASON
from weeklens.functions.dates import add_weeks
from weeklens.functions.numeric import clip_zero
from weeklens.operators.weekly import series_window, last_rows

FORECAST_COLUMNS = (
    "series_id", "model_type", "horizon", "forecast_date", "predicted_value", "lower_bound", "upper_bound",
)


def forecast_frame(
    df: DataFrame, model_type: str, predicted: Column, lower: Column | None = None, upper: Column | None = None
) -> DataFrame:
    """Standard columns from a frame with series_id, horizon, forecast_date; values clipped at zero."""
    none = F.lit(None).cast("double")
    return df.select(
        "series_id",
        F.lit(model_type).alias("model_type"),
        F.col("horizon").cast("int").alias("horizon"),
        "forecast_date",
        clip_zero(predicted).alias("predicted_value"),
        (none if lower is None else clip_zero(lower)).alias("lower_bound"),
        (none if upper is None else clip_zero(upper)).alias("upper_bound"),
    )


def future_weeks(history: DataFrame, steps: int) -> DataFrame:
    """(series_id, horizon, forecast_date) for the ``steps`` weeks after each series' last row."""
    last = history.groupBy("series_id").agg(F.max("week_start").alias("last_week"))
    return last.select(
        "series_id", "last_week", F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("horizon")
    ).select("series_id", "horizon", add_weeks(F.col("last_week"), F.col("horizon")).alias("forecast_date"))


def heuristic_bounds(forecasts: DataFrame, share: float = 0.12) -> DataFrame:
    """Bounds at a fixed share around the prediction, for models without intervals."""
    return forecasts.withColumn("lower_bound", F.col("predicted_value") * F.lit(1 - share)).withColumn(
        "upper_bound", F.col("predicted_value") * F.lit(1 + share)
    )


def assemble_rows(predictions: DataFrame, test: DataFrame, version: str) -> DataFrame:
    """Store rows: one per test week, predictions matched by position, NULL where the model gave fewer."""
    models = predictions.select("series_id", "model_type").distinct()
    dated = test.select(
        "series_id",
        F.col("week_start").alias("forecast_date"),
        F.row_number().over(series_window()).alias("horizon"),
    ).join(models, "series_id")
    values = predictions.select(
        "series_id", "model_type", "horizon", "predicted_value", "lower_bound", "upper_bound"
    )
    return dated.join(values, ["series_id", "model_type", "horizon"], "left").select(
        *FORECAST_COLUMNS, F.lit(version).alias("model_version")
    )


def with_actuals(forecasts: DataFrame, weekly: DataFrame, how: str = "inner", value: str = "total_sales") -> DataFrame:
    """Adds ``actual`` by series and week."""
    actuals = weekly.select(
        "series_id", F.col("week_start").alias("forecast_date"), F.col(value).cast("double").alias("actual")
    )
    return forecasts.join(actuals, ["series_id", "forecast_date"], how)


def union_forecasts(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def first_horizon(forecasts: DataFrame, horizon: int) -> DataFrame:
    """First ``horizon`` rows per series and model in date order."""
    order = Window.partitionBy("series_id", "model_type").orderBy("forecast_date")
    return (
        forecasts.withColumn("_rank", F.row_number().over(order)).where(F.col("_rank") <= horizon).drop("_rank")
    )


def value_range(pairs: DataFrame) -> DataFrame:
    """Joint minimum and maximum of actual and predicted values per series and model."""
    return pairs.groupBy("series_id", "model_type").agg(
        F.min(F.least("actual", "predicted_value")).alias("low"),
        F.max(F.greatest("actual", "predicted_value")).alias("high"),
    )


def seasonal_naive(history: DataFrame, steps: int, season: int = SEASON) -> DataFrame:
    """Repeats the last season: horizon h takes the value at position (h - 1) mod season."""
    recent = last_rows(history, season)
    whole = Window.partitionBy("series_id")
    placed = recent.select(
        "series_id",
        F.row_number().over(series_window()).alias("position"),
        F.count(F.lit(1)).over(whole).cast("int").alias("cycle"),
        F.max("week_start").over(whole).alias("last_week"),
        F.col("total_sales").cast("double").alias("value"),
    ).where(F.col("position") <= steps)
    horizons = placed.select(
        "series_id", "value", "last_week", F.explode(F.sequence("position", F.lit(steps), "cycle")).alias("horizon")
    )
    dated = horizons.withColumn("forecast_date", add_weeks(F.col("last_week"), F.col("horizon")))
    return forecast_frame(dated, "seasonal_naive", F.col("value"))


def drift_line(history: DataFrame, steps: int, span: int = 8) -> DataFrame:
    """Last value plus h times the average change between it and the ``span``-th last value; flat when shorter."""
    recent = last_rows(history, span)
    rank = F.row_number().over(Window.partitionBy("series_id").orderBy(F.col("week_start").desc()))
    ranked = recent.select("series_id", "week_start", F.col("total_sales").cast("double").alias("value"), rank.alias("r"))
    ends = ranked.groupBy("series_id").agg(
        F.max("week_start").alias("last_week"),
        F.max(F.when(F.col("r") == 1, F.col("value"))).alias("last_value"),
        F.max(F.when(F.col("r") == span, F.col("value"))).alias("early_value"),
    )
    slope = F.coalesce((F.col("last_value") - F.col("early_value")) / float(span), F.lit(0.0))
    dated = ends.select("*", F.explode(F.sequence(F.lit(1), F.lit(steps))).alias("horizon")).withColumn(
        "forecast_date", add_weeks(F.col("last_week"), F.col("horizon"))
    )
    return forecast_frame(dated, "drift", F.col("last_value") + F.col("horizon") * slope)


def one_step_seasonal(weekly: DataFrame, season: int = SEASON) -> DataFrame:
    """Last year's value as the forecast of every week that has one: a long error history for monitoring."""
    lagged = F.lag("total_sales", season).over(series_window()).cast("double")
    dated = weekly.select(
        "series_id", F.lit(1).alias("horizon"), F.col("week_start").alias("forecast_date"), lagged.alias("lagged")
    ).where(F.col("lagged").isNotNull())
    return forecast_frame(dated, "seasonal_naive", F.col("lagged"))
