"""Forecast accuracy: MAE, RMSE, ME, MASE, rolling and per-horizon variants, results table."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weeklens.config import HORIZONS, SEASON
from weeklens.functions.checks import require_columns
from weeklens.functions.numeric import ratio
from weeklens.operators.weekly import series_window

MODEL_KEY = ("series_id", "model_type")
RESULT_COLUMNS = ("series_id", "model", "MASE", "RMSE", "MAE")


def errors(pairs: DataFrame) -> DataFrame:
    """Adds the signed error, positive for over-forecasting."""
    return pairs.withColumn("error", F.col("predicted_value") - F.col("actual"))


def accuracy(pairs: DataFrame, keys: Iterable[str] = MODEL_KEY) -> DataFrame:
    """MAE, RMSE and ME per key."""
    error = F.col("predicted_value") - F.col("actual")
    return pairs.groupBy(*keys).agg(
        F.avg(F.abs(error)).alias("MAE"), F.sqrt(F.avg(error * error)).alias("RMSE"), F.avg(error).alias("ME")
    )


def naive_scale(train: DataFrame, season: int = SEASON, value: str = "total_sales") -> DataFrame:
    """MASE denominator per series: mean absolute seasonal change, or lag-1 change of a short history."""
    y = F.col(value).cast("double")
    steps = train.select(
        "series_id",
        F.abs(y - F.lag(y, season).over(series_window())).alias("seasonal_step"),
        F.abs(y - F.lag(y, 1).over(series_window())).alias("single_step"),
    )
    chosen = F.when(F.count(F.lit(1)) > season, F.avg("seasonal_step")).otherwise(F.avg("single_step"))
    return steps.groupBy("series_id").agg(chosen.alias("naive_mae"))


def evaluate_models(pairs: DataFrame, train: DataFrame, season: int = SEASON) -> DataFrame:
    """series_id, model, MASE, RMSE, MAE, ME for every model at once; MASE is NULL on a zero denominator."""
    scored = accuracy(pairs).join(naive_scale(train, season), "series_id", "left")
    return scored.select(
        "series_id",
        F.col("model_type").alias("model"),
        ratio(F.col("MAE"), F.col("naive_mae")).alias("MASE"),
        "RMSE",
        "MAE",
        "ME",
    )


def results_table(results: DataFrame, digits: int = 4) -> DataFrame:
    """Rounded half to even and ordered by series, then MASE with missing values last."""
    require_columns(results, RESULT_COLUMNS, "results")
    rounded = {c: F.bround(c, digits) for c in ("MASE", "RMSE", "MAE", "ME") if c in results.columns}
    return results.orderBy("series_id", F.col("MASE").asc_nulls_last(), "model").withColumns(rounded)


def best_model(results: DataFrame) -> DataFrame:
    """Model with the lowest MASE per series; equal scores resolve by name."""
    best = F.min(F.when(F.col("MASE").isNotNull(), F.struct("MASE", "model")))
    return results.groupBy("series_id").agg(best.alias("b")).select(
        "series_id", F.col("b.model").alias("model"), F.col("b.MASE").alias("MASE")
    )


def model_means(results: DataFrame) -> DataFrame:
    return results.groupBy("model").agg(*[F.avg(c).alias(c) for c in ("MASE", "RMSE", "MAE")])


def mean_demand(weekly: DataFrame, value: str = "total_sales") -> DataFrame:
    return weekly.groupBy("series_id").agg(F.avg(value).alias("mean_demand"))


def rolling_mase(pairs: DataFrame, train: DataFrame, window: int = 4, season: int = SEASON) -> DataFrame:
    """Mean absolute error of the last ``window`` weeks over the naive scale (1 where that is zero or unknown)."""
    order = Window.partitionBy(*MODEL_KEY).orderBy("forecast_date")
    frame = order.rowsBetween(-(window - 1), 0)
    absolute = F.abs(F.col("predicted_value") - F.col("actual"))
    full = F.count(absolute).over(frame) == window
    rolled = pairs.select(
        *MODEL_KEY, "forecast_date", F.when(full, F.avg(absolute).over(frame)).alias("rolling_mae")
    )
    scale = naive_scale(train, season)
    divisor = F.when(F.col("naive_mae") > 0, F.col("naive_mae")).otherwise(F.lit(1.0))
    return rolled.join(scale, "series_id", "left").select(
        *MODEL_KEY, "forecast_date", (F.col("rolling_mae") / divisor).alias("rolling_mase")
    )


def metrics_by_horizon(
    pairs: DataFrame, train: DataFrame, horizons: Iterable[int] = HORIZONS, season: int = SEASON
) -> DataFrame:
    """Cumulative MAE, RMSE and MASE of the first h weeks for each h a forecast reaches."""
    frame = (
        Window.partitionBy(*MODEL_KEY).orderBy("horizon").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    error = F.col("predicted_value") - F.col("actual")
    cumulative = pairs.select(
        *MODEL_KEY,
        "horizon",
        F.avg(F.abs(error)).over(frame).alias("MAE"),
        F.sqrt(F.avg(error * error).over(frame)).alias("RMSE"),
    ).where(F.col("horizon").isin(list(horizons)))
    return cumulative.join(naive_scale(train, season), "series_id", "left").select(
        *MODEL_KEY, "horizon", "MAE", "RMSE", ratio(F.col("MAE"), F.col("naive_mae")).alias("MASE")
    )


def accuracy_band(results: DataFrame) -> DataFrame:
    """Verbal band of each MASE."""
    # Upper limits of the bands.
    band = (
        F.when(F.col("MASE") < 0.8, F.lit("Excellent"))
        .when(F.col("MASE") < 1.0, F.lit("Good"))
        .when(F.col("MASE") < 1.15, F.lit("Marginal"))
        .when(F.col("MASE").isNotNull(), F.lit("Poor"))
    )
    return results.withColumn("band", band)


def series_results(results: DataFrame, series_id: str) -> DataFrame:
    return accuracy_band(results.where(F.col("series_id") == series_id).select("model", "MASE", "RMSE", "MAE"))
