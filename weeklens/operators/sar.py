"""Seasonal autoregression on the doubly differenced series, for all series at once.

w = (1 - B)(1 - B^s) y follows w[t] = a w[t-1] + b w[t-s] + e. The two coefficients come from closed-form
least squares on grouped sums; forecasts and their variance from a fold over a bounded state.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weeklens.config import SeasonalArConfig
from weeklens.functions.arrays import let, ordered_values
from weeklens.functions.dates import add_weeks
from weeklens.functions.numeric import ratio, z_value
from weeklens.operators.forecasts import forecast_frame
from weeklens.operators.weekly import series_window, last_rows

MODEL = "sar"
_FREE_PARAMETERS = 3


def differenced(history: DataFrame, season: int, value: str = "total_sales") -> DataFrame:
    """(series_id, week_start, y, w)."""
    y = F.col(value).cast("double")

    def back(k: int) -> Column:
        return F.lag(y, k).over(series_window())

    change = y - back(1) - back(season) + back(season + 1)
    return history.select("series_id", "week_start", y.alias("y"), change.alias("w"))


def _lagged_rows(history: DataFrame, season: int) -> DataFrame:
    w = F.col("w")
    return differenced(history, season).select(
        "series_id",
        "week_start",
        "w",
        F.lag(w, 1).over(series_window()).alias("w1"),
        F.lag(w, season).over(series_window()).alias("ws"),
    )


def _regression_rows(history: DataFrame, season: int) -> DataFrame:
    return _lagged_rows(history, season).where(F.col("ws").isNotNull() & F.col("w1").isNotNull())


def sar_fit(train: DataFrame, config: SeasonalArConfig = SeasonalArConfig()) -> DataFrame:
    """phi1, phi_s, sigma2, n_used, aic, bic for every series of ``train``.

    Coefficients are NULL where the system is singular, and for a series too short for a single regression row.
    """
    used = F.col("ws").isNotNull() & F.col("w1").isNotNull()
    sums = (
        _lagged_rows(train, config.season)
        .withColumns({c: F.when(used, F.col(c)) for c in ("w", "w1", "ws")})
        .groupBy("series_id")
        .agg(
            F.count("ws").alias("n_used"),
            F.sum(F.col("w1") * F.col("w1")).alias("s11"),
            F.sum(F.col("ws") * F.col("ws")).alias("sss"),
            F.sum(F.col("w1") * F.col("ws")).alias("s1s"),
            F.sum(F.col("w1") * F.col("w")).alias("s1w"),
            F.sum(F.col("ws") * F.col("w")).alias("ssw"),
            F.sum(F.col("w") * F.col("w")).alias("sww"),
        )
    )
    det = F.col("s11") * F.col("sss") - F.col("s1s") * F.col("s1s")
    solved = sums.select(
        "*",
        ratio(F.col("s1w") * F.col("sss") - F.col("ssw") * F.col("s1s"), det).alias("phi1"),
        ratio(F.col("ssw") * F.col("s11") - F.col("s1w") * F.col("s1s"), det).alias("phi_s"),
    )
    rss = F.col("sww") - F.col("phi1") * F.col("s1w") - F.col("phi_s") * F.col("ssw")
    n = F.col("n_used").cast("double")
    variance = solved.withColumn("sigma2", F.when(rss.isNotNull(), F.greatest(F.lit(0.0), rss) / n))
    deviance = n * (F.ln(F.lit(2 * math.pi) * F.col("sigma2")) + 1.0)
    return variance.select(
        "series_id",
        "phi1",
        "phi_s",
        "sigma2",
        "n_used",
        (deviance + 2.0 * _FREE_PARAMETERS).alias("aic"),
        (deviance + _FREE_PARAMETERS * F.ln(n)).alias("bic"),
    )


def sar_residuals(train: DataFrame, params: DataFrame, season: int = SeasonalArConfig.season) -> DataFrame:
    rows = _regression_rows(train, season).join(params.select("series_id", "phi1", "phi_s"), "series_id")
    residual = F.col("w") - F.col("phi1") * F.col("w1") - F.col("phi_s") * F.col("ws")
    return rows.select("series_id", "week_start", residual.alias("residual"))


def _extend(levels: Column, changes: Column, steps: int, season: int) -> Column:
    """Appends ``steps`` values to the level array by the recursion with coefficients phi1 and phi_s."""
    zero = F.struct(levels.alias("y"), changes.alias("w"))

    def step(state: Column, _: Column) -> Column:
        def back(name: str, k: int) -> Column:
            return F.element_at(state[name], -k)

        def grow(w: Column) -> Column:
            y = back("y", 1) + back("y", season) - back("y", season + 1) + w
            return F.struct(F.concat(state["y"], F.array(y)).alias("y"), F.concat(state["w"], F.array(w)).alias("w"))

        return let(F.col("phi1") * back("w", 1) + F.col("phi_s") * back("w", season), grow)

    if steps == 0:
        return levels
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), zero, step, lambda s: s["y"])


def _impulse(length: int) -> Column:
    return F.concat(F.array_repeat(F.lit(0.0), length - 1), F.array(F.lit(1.0)))


def sar_forecast(
    history: DataFrame, params: DataFrame, steps: int, config: SeasonalArConfig = SeasonalArConfig()
) -> DataFrame:
    """Forecast frame with (1 - alpha) intervals from the last history row of each series.

    The state is the last season + 1 levels and differences, so nothing longer is ever gathered. Every series of
    ``history`` gets its ``steps`` rows; their values are NULL where it is shorter than that or has no coefficients.
    """
    season = config.season
    recent = last_rows(differenced(history, season), season + 1)
    state = recent.groupBy("series_id").agg(
        F.max("week_start").alias("last_week"),
        ordered_values("week_start", "y").alias("levels"),
        F.transform(ordered_values("week_start", "w"), lambda v: F.coalesce(v, F.lit(0.0))).alias("changes"),
    )
    fitted = state.join(params.select("series_id", "phi1", "phi_s", "sigma2"), "series_id", "left")
    extended = F.slice(_extend(F.col("levels"), F.col("changes"), steps, season), season + 2, steps)
    unknown = F.array_repeat(F.lit(None).cast("double"), steps)
    points = F.when((F.size("levels") == season + 1) & F.col("phi1").isNotNull(), extended).otherwise(unknown)
    weights = F.slice(_extend(_impulse(season + 1), _impulse(season), steps - 1, season), season + 1, steps)
    folded = fitted.select("series_id", "last_week", "sigma2", points.alias("points"), weights.alias("weights"))
    rows = folded.select("series_id", "last_week", "sigma2", "weights", F.posexplode("points").alias("i", "point"))
    spread = F.aggregate(F.slice("weights", F.lit(1), F.col("i") + 1), F.lit(0.0), lambda s, v: s + v * v)
    dated = rows.select(
        "series_id",
        (F.col("i") + 1).alias("horizon"),
        add_weeks(F.col("last_week"), F.col("i") + 1).alias("forecast_date"),
        "point",
        (F.lit(z_value(1 - config.alpha / 2)) * F.sqrt(F.col("sigma2") * spread)).alias("half"),
    )
    point, half = F.col("point"), F.col("half")
    return forecast_frame(dated, MODEL, point, point - half, point + half)
