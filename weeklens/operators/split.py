"""Temporal split, train-only scaling and sliding windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weeklens.config import SEASON, TEST_WEEKS, VAL_FRACTION
from weeklens.operators.weekly import series_window


def temporal_split(
    weekly: DataFrame, test_weeks: int = TEST_WEEKS, val_fraction: float = VAL_FRACTION
) -> DataFrame:
    """Adds ``split`` (train, val, test) in time order per series.

    The last ``test_weeks`` rows are test, the max(1, floor(n * val_fraction)) rows before them val.
    Series no longer than the test window have only test rows and are marked ``too_short``.
    """
    n = F.count(F.lit(1)).over(Window.partitionBy("series_id"))
    position = F.row_number().over(series_window())
    val_weeks = F.greatest(F.lit(1), F.floor(n.cast("double") * F.lit(val_fraction)))
    label = (
        F.when(position > n - test_weeks, F.lit("test"))
        .when(position > n - test_weeks - val_weeks, F.lit("val"))
        .otherwise(F.lit("train"))
    )
    return weekly.select("*", label.alias("split"), (n <= test_weeks).alias("too_short"))


def split_sizes(labelled: DataFrame) -> DataFrame:
    rows = [F.count_if(F.col("split") == s).alias(f"n_{s}") for s in ("train", "val", "test")]
    return labelled.groupBy("series_id").agg(*rows)


def train_rows(labelled: DataFrame) -> DataFrame:
    return labelled.where(F.col("split") == "train")


def scaler_params(labelled: DataFrame, value: str = "total_sales") -> DataFrame:
    """Minimum and maximum per series over its training rows only."""
    return train_rows(labelled).groupBy("series_id").agg(
        F.min(value).cast("double").alias("data_min"), F.max(value).cast("double").alias("data_max")
    )


def _fitted(parameter: str) -> Column:
    message = F.concat(F.lit("no scaler fitted for series "), F.col("series_id"))
    return F.when(F.col(parameter).isNotNull(), F.col(parameter)).otherwise(F.raise_error(message).cast("double"))


def _span() -> Column:
    spread = _fitted("data_max") - _fitted("data_min")
    return F.when(spread == 0, F.lit(1.0)).otherwise(spread)


def scale(
    df: DataFrame,
    params: DataFrame,
    value: str = "total_sales",
    feature_range: tuple[float, float] = (0.0, 1.0),
    out: str = "scaled",
) -> DataFrame:
    """Min-max scaling with stored parameters; values beyond the training range leave the interval."""
    lo, hi = feature_range
    unit = (F.col(value).cast("double") - _fitted("data_min")) / _span()
    scaled = (unit * F.lit(hi - lo) + F.lit(lo)).alias(out)
    return df.join(params, "series_id", "left").select(*[df[c] for c in df.columns], scaled)


def unscale(
    df: DataFrame,
    params: DataFrame,
    value: str = "scaled",
    feature_range: tuple[float, float] = (0.0, 1.0),
    out: str = "restored",
) -> DataFrame:
    lo, hi = feature_range
    restored = (F.col(value) - F.lit(lo)) / F.lit(hi - lo) * _span() + _fitted("data_min")
    return df.join(params, "series_id", "left").select(*[df[c] for c in df.columns], restored.alias(out))


def scale_in_place(labelled: DataFrame, value: str = "total_sales", out: str = "scaled") -> DataFrame:
    """Same values as ``scale(df, scaler_params(df))`` for rows still carrying their split: a window, no join."""
    whole = Window.partitionBy("series_id")
    train_value = F.when(F.col("split") == "train", F.col(value).cast("double"))
    lo, hi = F.min(train_value).over(whole), F.max(train_value).over(whole)
    span = F.when(hi == lo, F.lit(1.0)).otherwise(hi - lo)
    return labelled.select(
        "*", ((F.col(value).cast("double") - lo) / span).alias(out), lo.alias("data_min"), hi.alias("data_max")
    )


def sliding_windows(df: DataFrame, value: str, window: int = SEASON, extra: tuple[str, ...] = ()) -> DataFrame:
    """(series_id, week_start, inputs, target): the ``window`` values before each week and the week's own value."""
    before = series_window().rowsBetween(-window, -1)
    return df.select(
        "series_id",
        "week_start",
        *extra,
        F.collect_list(F.col(value)).over(before).alias("inputs"),
        F.col(value).alias("target"),
    ).where(F.size("inputs") == window)


def training_windows(labelled: DataFrame, value: str = "total_sales", window: int = SEASON) -> DataFrame:
    return sliding_windows(train_rows(labelled), value, window)


def validation_windows(labelled: DataFrame, value: str = "total_sales", window: int = SEASON) -> DataFrame:
    """Windows whose target is a validation week; the first ones reach back into the training rows."""
    seen = labelled.where(F.col("split") != "test")
    return sliding_windows(seen, value, window, ("split",)).where(F.col("split") == "val").drop("split")
