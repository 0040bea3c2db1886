"""Trend, seasonal and residual parts of every series; anomalies in the residuals."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weeklens.config import SEASON
from weeklens.functions.dates import add_weeks
from weeklens.operators.weekly import series_window

STL_INNER, STL_OUTER = 2, 15
STL_SEASONAL = 7


def decompose_ma(weekly: DataFrame, period: int = SEASON, value: str = "total_sales") -> DataFrame:
    """Classical decomposition: centred moving average trend, mean per cycle position, remainder.

    For an even period the average spans period + 1 weeks with half weight on both ends. The first and
    last half period have no trend, hence no residual. Everything partitions by series: one exchange.
    """
    y = F.col(value).cast("double")
    half = period // 2
    whole_window = series_window().rowsBetween(-half, half)
    window_sum = F.sum(y).over(whole_window)
    if period % 2 == 0:
        edges = F.lag(y, half).over(series_window()) + F.lead(y, half).over(series_window())
        window_sum = window_sum - edges / 2.0
    complete = F.count(y).over(whole_window) == 2 * half + 1
    base = weekly.select(
        "series_id",
        "week_start",
        y.alias("observed"),
        F.pmod(F.row_number().over(series_window()) - 1, F.lit(period)).alias("position"),
        F.when(complete, window_sum / float(period)).alias("trend"),
    )
    position = Window.partitionBy("series_id", "position")
    detrended = base.withColumn("raw_seasonal", F.avg(F.col("observed") - F.col("trend")).over(position))
    # Centre over the cycle: each position counts once, whatever its number of weeks.
    share = F.lit(1.0) / F.count(F.lit(1)).over(position)
    weighted = detrended.withColumn("share", F.when(F.col("raw_seasonal").isNotNull(), share))
    series = Window.partitionBy("series_id")
    level = F.sum(F.col("raw_seasonal") * F.col("share")).over(series) / F.sum("share").over(series)
    seasonal = F.col("raw_seasonal") - level
    return weighted.select(
        "series_id",
        "week_start",
        "observed",
        "trend",
        seasonal.alias("seasonal"),
        (F.col("observed") - F.col("trend") - seasonal).alias("residual"),
    )


def _local_line(length: int, span: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Neighbourhood indexes, tricube weights and centred offsets of a loess fit at positions ``at``."""
    width = min(span, length)
    left = np.clip(np.round(at).astype(int) - width // 2, 0, length - width)
    index = left[:, None] + np.arange(width)
    offset = index - at[:, None]
    reach = np.abs(offset).max(axis=1)
    if span > length:
        reach = reach + (span - length) // 2
    distance = np.abs(offset) / np.maximum(reach, 1e-12)[:, None]
    weight = np.where(distance <= 0.001, 1.0, np.where(distance <= 0.999, (1 - distance**3) ** 3, 0.0))
    return index, weight, offset


def _loess(y: np.ndarray, span: int, at: np.ndarray, robust: np.ndarray) -> np.ndarray:
    """Degree-1 loess of the rows of ``y`` (series x time), evaluated at ``at``."""
    index, weight, offset = _local_line(y.shape[1], span, at)
    w = weight[None] * robust[:, index]
    total = w.sum(axis=2)
    safe = np.where(total > 0, total, 1.0)
    w = w / safe[:, :, None]
    local = y[:, index]
    mean_x = (w * offset).sum(axis=2)
    centred = offset[None] - mean_x[:, :, None]
    variance = (w * centred**2).sum(axis=2)
    mean_y = (w * local).sum(axis=2)
    slope = (w * centred * local).sum(axis=2) / np.where(variance > 0, variance, 1.0)
    steep_enough = np.sqrt(variance) > 0.001 * (y.shape[1] - 1)
    fitted = mean_y + np.where(steep_enough, slope * -mean_x, 0.0)
    nearest = y[:, np.clip(np.round(at).astype(int), 0, y.shape[1] - 1)]
    return np.where(total > 0, fitted, nearest)


def _moving_mean(y: np.ndarray, width: int) -> np.ndarray:
    running = np.cumsum(np.pad(y, ((0, 0), (1, 0))), axis=1)
    return (running[:, width:] - running[:, :-width]) / width


def _next_odd(x: float) -> int:
    n = int(np.ceil(x))
    return n + 1 - n % 2


def stl_arrays(y: np.ndarray, period: int = SEASON, robust: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Trend and seasonal parts of equally long series (rows of ``y``) after Cleveland et al. (1990)."""
    rows, n = y.shape
    trend_span = _next_odd(1.5 * period / (1 - 1.5 / STL_SEASONAL))
    low_span = _next_odd(period + 1)
    inner, outer = (STL_INNER, STL_OUTER) if robust else (5, 0)
    trend, seasonal, weight = np.zeros_like(y), np.zeros_like(y), np.ones_like(y)
    everywhere = np.arange(n, dtype=float)
    for step in range(outer + 1):
        for _ in range(inner):
            detrended = y - trend
            # Smooth each cycle position and extend it by one cycle at both ends.
            cycle = np.empty((rows, n + 2 * period))
            for position in range(min(period, n)):
                sub = detrended[:, position::period]
                at = np.arange(-1, sub.shape[1] + 1, dtype=float)
                cycle[:, position::period][:, : len(at)] = _loess(sub, STL_SEASONAL, at, weight[:, position::period])
            passed = _moving_mean(_moving_mean(_moving_mean(cycle, period), period), 3)
            low = _loess(passed, low_span, everywhere, np.ones_like(passed))
            seasonal = cycle[:, period : period + n] - low
            trend = _loess(y - seasonal, trend_span, everywhere, weight)
        if step < outer:
            miss = np.abs(y - trend - seasonal)
            limit = 6 * np.median(miss, axis=1, keepdims=True)
            share = miss / np.where(limit > 0, limit, 1.0)
            weight = np.where(share <= 0.001, 1.0, np.where(share <= 0.999, (1 - share**2) ** 2, 0.0))
            weight = np.where(limit > 0, weight, 1.0)
    return trend, seasonal


def _series_arrays(weekly: DataFrame, value: str) -> DataFrame:
    """One row per series with its weeks and values in order; a group holds at most the calendar's weeks."""
    points = F.array_sort(F.collect_list(F.struct("week_start", F.col(value).cast("double").alias("y"))))
    return weekly.where(F.col(value).isNotNull()).groupBy("series_id").agg(points.alias("points")).select(
        "series_id",
        F.transform("points", lambda p: p["week_start"]).alias("weeks"),
        F.transform("points", lambda p: p["y"]).alias("values"),
    )


def decompose_stl(
    weekly: DataFrame, period: int = SEASON, robust: bool = True, value: str = "total_sales"
) -> DataFrame:
    """STL of every series. Arrow batches carry many series; those of one length are smoothed together.

    A series shorter than two periods keeps its rows with NULL parts and an ``error``, and does not stop the others.
    """

    def smooth(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            lengths = batch["values"].map(len)
            for length, group in batch.groupby(lengths):
                for start in range(0, len(group), 32):
                    part = group.iloc[start : start + 32]
                    y = np.array([np.asarray(v, dtype=float) for v in part["values"]])
                    if length >= 2 * period:
                        trend, seasonal = stl_arrays(y, period, robust)
                        trend, seasonal = list(trend), list(seasonal)
                    else:
                        trend = seasonal = [None] * len(part)
                    yield part.assign(trend=trend, seasonal=seasonal)

    schema = "series_id string, weeks array<date>, values array<double>, trend array<double>, seasonal array<double>"
    parts = _series_arrays(weekly, value).mapInPandas(smooth, schema)
    rows = parts.select("series_id", F.posexplode("weeks").alias("i", "week_start"), "values", "trend", "seasonal")
    at = F.col("i") + 1
    return rows.select(
        "series_id",
        "week_start",
        F.element_at("values", at).alias("observed"),
        F.element_at("trend", at).alias("trend"),
        F.element_at("seasonal", at).alias("seasonal"),
        (F.element_at("values", at) - F.element_at("trend", at) - F.element_at("seasonal", at)).alias("residual"),
        F.when(F.size("values") < 2 * period, F.format_string("%d values are less than two periods of %d", F.size("values"), F.lit(period))).alias("error"),
    )


def residual_stats(parts: DataFrame) -> DataFrame:
    return parts.groupBy("series_id").agg(
        F.avg("residual").alias("residual_mean"),
        F.stddev_samp("residual").alias("residual_std"),
        F.stddev_pop("residual").alias("residual_std_pop"),
    )


def control_limits(parts: DataFrame, sigmas: float = 3.0, demand_share: float = 0.10) -> DataFrame:
    """Residual band of +-3 population deviations and error band of +-10 % of mean demand, per week."""
    whole = Window.partitionBy("series_id")
    return parts.select(
        "series_id",
        "week_start",
        "residual",
        (F.lit(sigmas) * F.stddev_pop("residual").over(whole)).alias("residual_limit"),
        (F.lit(demand_share) * F.avg("observed").over(whole)).alias("bias_limit"),
    )


def detect_anomalies(
    parts: DataFrame, events: DataFrame | None = None, sigmas: float = 3.0, event_reach: int = 1
) -> DataFrame:
    """Flags residuals beyond ``sigmas`` sample deviations and explains them by a nearby event week.

    ``parts`` has observed and residual per week, ``events`` (week_start, event_name). Each event week is
    spread over the weeks within reach before an equi-join; where two events are near, the nearer one and
    then the earlier one names the anomaly.
    """
    whole = Window.partitionBy("series_id")
    distance = F.abs(F.col("residual") - F.avg("residual").over(whole))
    flagged = F.coalesce(distance > F.lit(float(sigmas)) * F.stddev_samp("residual").over(whole), F.lit(False))
    base = parts.select(
        "series_id", "week_start", F.col("observed").alias("sales"), "residual", flagged.alias("is_anomaly")
    )
    if events is None:
        label = F.lit(None).cast("string")
    else:
        offsets = F.explode(F.sequence(F.lit(-event_reach), F.lit(event_reach))).alias("offset")
        nearest = F.struct(F.abs("offset"), F.col("week_start"))
        near = (
            events.select("week_start", "event_name", offsets)
            .groupBy(add_weeks(F.col("week_start"), F.col("offset")).alias("near_week"))
            .agg(F.min_by("event_name", nearest).alias("near_event"))
        )
        base = base.join(near, base.week_start == near.near_week, "left")
        label = F.col("near_event")
    kind = (
        F.when(~F.col("is_anomaly"), F.lit("normal"))
        .when(label.isNotNull(), F.lit("explainable"))
        .otherwise(F.lit("unexplained"))
    )
    event_label = F.when(F.col("is_anomaly"), F.coalesce(label, F.lit(""))).otherwise(F.lit(""))
    return base.select(
        "series_id",
        "week_start",
        "sales",
        "residual",
        "is_anomaly",
        kind.alias("anomaly_class"),
        event_label.alias("event_label"),
    )


def anomaly_counts(anomalies: DataFrame) -> DataFrame:
    return anomalies.groupBy("series_id").agg(F.count_if("is_anomaly").alias("n_anomalies"))


def anomaly_summary(anomalies: DataFrame) -> DataFrame:
    """Only the flagged weeks."""
    return anomalies.where("is_anomaly").select(
        "series_id", "week_start", "sales", "residual", "anomaly_class", "event_label"
    )
