"""Calendar, lag and rolling features per series."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weeklens.config import RETAIL_STATES, SEASON
from weeklens.functions.dates import cyclic
from weeklens.operators.weekly import series_window, snap_flag
from weeklens.sources.files import as_date


def features(weekly: DataFrame, states: dict[str, str] = RETAIL_STATES) -> DataFrame:
    """Weekly sales plus eleven features. All windows share one ordering, so Spark sorts once per series."""
    weekly = as_date(weekly, "week_start")
    week = F.weekofyear("week_start")
    week_sin, week_cos = cyclic(week, 52)
    month_sin, month_cos = cyclic(F.month("week_start"), 12)
    previous_four = series_window().rowsBetween(-4, -1)
    return weekly.select(
        *weekly.columns,
        week_sin.alias("week_sin"),
        week_cos.alias("week_cos"),
        month_sin.alias("month_sin"),
        month_cos.alias("month_cos"),
        snap_flag(states).alias("is_snap_week"),
        F.year("week_start").alias("year"),
        F.quarter("week_start").alias("quarter"),
        week.alias("week_of_year"),
        F.lag("total_sales", SEASON).over(series_window()).cast("double").alias("sales_lag_52"),
        F.avg("total_sales").over(previous_four).alias("rolling_4w_mean"),
        F.stddev_samp("total_sales").over(previous_four).alias("rolling_4w_std"),
    )


def rolling_stats(weekly: DataFrame, window: int = 4, value: str = "total_sales") -> DataFrame:
    """Rolling mean and sample deviation that include the current week; a single value deviates by 0."""
    frame = series_window().rowsBetween(-(window - 1), 0)
    return weekly.select(
        "series_id",
        "week_start",
        F.col(value).cast("double").alias("value"),
        F.avg(value).over(frame).alias("rolling_mean"),
        F.coalesce(F.stddev_samp(value).over(frame), F.lit(0.0)).alias("rolling_std"),
    )


def lag_difference(weekly: DataFrame, lag: int = 1, value: str = "total_sales") -> DataFrame:
    change = F.col(value) - F.lag(value, lag).over(series_window())
    return weekly.select("series_id", "week_start", change.alias("difference")).where(F.col("difference").isNotNull())
