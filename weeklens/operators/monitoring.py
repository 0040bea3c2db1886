"""Drift checks over stored forecasts: rolling MASE, bias, distribution shift, health and alerts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weeklens.config import (
    BIAS_SHARE, BIAS_WEEKS, MASE_ALERT, MASE_AMBER, PSI_ALERT, PSI_BINS, PSI_FLOOR,
)
from weeklens.functions.numeric import null_if_nan
from weeklens.operators.forecasts import with_actuals
from weeklens.operators.metrics import naive_scale

KEY = ("series_id", "model_type")
ROLLING_WEEKS = 4
_TINY = 1e-6


def recent(history: DataFrame, weeks: int) -> DataFrame:
    """Adds ``rank`` (1 = newest) and keeps the last ``weeks`` rows per series and model."""
    newest = Window.partitionBy(*KEY).orderBy(F.col("forecast_date").desc())
    return history.withColumn("rank", F.row_number().over(newest)).where(F.col("rank") <= weeks)


def error_history(forecasts: DataFrame, weekly: DataFrame, train: DataFrame, weeks: int = 12) -> DataFrame:
    """Signed errors and per-week MASE of the last ``weeks`` forecasts that have an actual value."""
    known = with_actuals(forecasts, weekly, "left").where(F.col("actual").isNotNull())
    scaled = known.join(naive_scale(train), "series_id", "left")
    whole = Window.partitionBy(*KEY)
    error = F.col("predicted_value") - F.col("actual")
    divisor = F.when(F.col("naive_mae") > 0, F.col("naive_mae")).otherwise(F.lit(1.0))
    rows = scaled.select(
        *KEY,
        "forecast_date",
        error.alias("error"),
        (F.abs(error) / divisor).alias("mase"),
        F.avg("predicted_value").over(whole).alias("mean_demand"),
    )
    return recent(rows, weeks)


def proxy_history(forecasts: DataFrame, weeks: int = 12) -> DataFrame:
    """The same frame without actuals: predicted minus lower bound stands in for the error."""
    whole = Window.partitionBy(*KEY)
    error = F.coalesce(null_if_nan(F.col("predicted_value") - F.col("lower_bound")), F.lit(0.0))
    mean = F.avg("predicted_value").over(whole)
    rows = forecasts.select(
        *KEY,
        "forecast_date",
        error.alias("error"),
        (F.abs(error) / (mean + F.lit(_TINY))).alias("mase"),
        mean.alias("mean_demand"),
    )
    return recent(rows, weeks)


def _within(weeks: int) -> Column:
    return F.col("rank") <= weeks


def _tail_mean(value: str, weeks: int) -> Column:
    return F.avg(F.when(_within(weeks), F.col(value)))


def _mase_alert(window: int) -> Column:
    return (F.count(F.lit(1)) >= window) & (_tail_mean("mase", window) > MASE_ALERT)


def _bias_alert(weeks: int) -> Column:
    beyond = F.abs("error") > F.lit(BIAS_SHARE) * F.col("mean_demand")
    return (F.count(F.lit(1)) >= weeks) & F.coalesce(F.bool_and(F.when(_within(weeks), beyond)), F.lit(False))


def mase_check(history: DataFrame, window: int = ROLLING_WEEKS) -> DataFrame:
    """Rolling MASE of the last ``window`` weeks; fewer weeks never alert."""
    return history.groupBy(*KEY).agg(
        _tail_mean("mase", window).alias("rolling_mase"), _mase_alert(window).alias("mase_alert")
    )


def bias_check(history: DataFrame, weeks: int = BIAS_WEEKS) -> DataFrame:
    """Alert when every one of the last ``weeks`` errors exceeds 10 % of mean demand."""
    mean_error = _tail_mean("error", weeks)
    direction = F.when(mean_error > 0, F.lit("over-forecasting")).otherwise(F.lit("under-forecasting"))
    return history.groupBy(*KEY).agg(
        mean_error.alias("recent_error"),
        F.max("mean_demand").alias("mean_demand"),
        direction.alias("direction"),
        _bias_alert(weeks).alias("bias_alert"),
    )


def histogram_counts(
    reference: DataFrame, current: DataFrame, value: str = "total_sales", n_bins: int = PSI_BINS, key: str = "series_id"
) -> DataFrame:
    """(key, reference_counts, current_counts) over equal-width bins of the reference range.

    Outer bins are open, a value on an inner edge belongs to the bin on its right. The bins are columns of
    one aggregate, so samples of any size shrink map-side and empty bins need no grid.
    """
    bounds = reference.groupBy(key).agg(F.min(value).cast("double").alias("lo"), F.max(value).cast("double").alias("hi"))
    flat = F.col("lo") == F.col("hi")
    widened = bounds.select(
        key,
        F.when(flat, F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(flat, F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )
    both = reference.select(key, F.col(value).cast("double").alias("v"), F.lit(True).alias("is_reference")).unionByName(
        current.select(key, F.col(value).cast("double").alias("v"), F.lit(False).alias("is_reference"))
    )
    edges = [F.col("lo") + F.lit(float(i)) * ((F.col("hi") - F.col("lo")) / float(n_bins)) for i in range(1, n_bins)]
    bin_index = reduce(lambda a, b: a + b, [(F.col("v") >= edge).cast("int") for edge in edges], F.lit(0))
    binned = both.join(widened, key).select(key, "is_reference", bin_index.alias("bin"))
    reference_row = F.col("is_reference")
    return binned.groupBy(key).agg(
        F.array(*[F.count_if(reference_row & (F.col("bin") == i)) for i in range(n_bins)]).alias("reference_counts"),
        F.array(*[F.count_if(~reference_row & (F.col("bin") == i)) for i in range(n_bins)]).alias("current_counts"),
    )


def _shares(counts: str) -> Column:
    total = F.aggregate(counts, F.lit(0.0), lambda s, c: s + c) + F.lit(_TINY)
    return F.transform(counts, lambda c: F.when(c == 0, F.lit(PSI_FLOOR)).otherwise(c / total))


def psi(
    reference: DataFrame, current: DataFrame, value: str = "total_sales", n_bins: int = PSI_BINS, key: str = "series_id"
) -> DataFrame:
    """Population stability index per key that occurs in both samples, with its alert and band."""
    counts = histogram_counts(reference, current, value, n_bins, key)
    present = counts.where(F.aggregate("current_counts", F.lit(0).cast("bigint"), lambda s, c: s + c) > 0)
    shares = present.select(key, _shares("reference_counts").alias("r"), _shares("current_counts").alias("c"))
    terms = F.zip_with("r", "c", lambda r, c: (c - r) * F.ln(c / r))
    scored = shares.select(key, F.bround(F.aggregate(terms, F.lit(0.0), lambda s, t: s + t), 6).alias("psi_score"))
    # 0.10 and the retrain limit bound the bands.
    band = (
        F.when(F.col("psi_score") > PSI_ALERT, F.lit("significant"))
        .when(F.col("psi_score") >= 0.10, F.lit("minor"))
        .otherwise(F.lit("stable"))
    )
    return scored.select(key, "psi_score", (F.col("psi_score") > PSI_ALERT).alias("psi_alert"), band.alias("band"))


def drift_checks(history: DataFrame, psi_scores: DataFrame | None = None) -> DataFrame:
    """All checks in one row per series and model; without a PSI its score is 0 and its flag false."""
    checks = history.groupBy(*KEY).agg(
        _tail_mean("mase", ROLLING_WEEKS).alias("rolling_mase"),
        _tail_mean("error", BIAS_WEEKS).alias("recent_error"),
        F.max("mean_demand").alias("mean_demand"),
        _mase_alert(ROLLING_WEEKS).alias("mase_alert"),
        _bias_alert(BIAS_WEEKS).alias("bias_alert"),
    )
    if psi_scores is None:
        return checks.select("*", F.lit(False).alias("psi_alert"), F.lit(0.0).alias("psi_score"))
    return checks.join(psi_scores.select("series_id", "psi_alert", "psi_score"), "series_id", "left").select(
        *checks.columns,
        F.coalesce("psi_alert", F.lit(False)).alias("psi_alert"),
        F.coalesce("psi_score", F.lit(0.0)).alias("psi_score"),
    )


def active(checks: DataFrame) -> DataFrame:
    return checks.where("mase_alert or bias_alert or psi_alert")


def alert_rows(checks: DataFrame) -> DataFrame:
    """One row per raised alert: series_id, model_type, alert_type, metric_value, action, message."""
    name = F.concat_ws("/", "series_id", "model_type")
    direction = F.when(F.col("recent_error") > 0, F.lit("over-forecasting")).otherwise(F.lit("under-forecasting"))

    def alert(flag: str, value: str, action: str, message: Column) -> Column:
        fields = F.struct(
            F.lit(flag).alias("alert_type"),
            F.col(value).alias("metric_value"),
            F.lit(action).alias("action"),
            message.alias("message"),
        )
        return F.when(F.col(flag), fields)

    mase = F.format_string("%s: rolling 4-week MASE %.3f above 1.15", name, F.col("rolling_mase"))
    bias = F.format_string(
        "%s: %s for 3 weeks, mean error %.1f against a limit of %.1f",
        name,
        direction,
        F.col("recent_error"),
        F.lit(BIAS_SHARE) * F.col("mean_demand"),
    )
    shift = F.format_string("%s: PSI %.4f above 0.20", name, F.col("psi_score"))
    raised = F.array(
        alert("mase_alert", "rolling_mase", "review", mase),
        alert("bias_alert", "recent_error", "review", bias),
        alert("psi_alert", "psi_score", "retrain", shift),
    )
    return checks.select(*KEY, F.explode(F.array_compact(raised)).alias("a")).select(*KEY, "a.*")


def mase_warnings(history: DataFrame) -> DataFrame:
    """Text lines of the rolling-MASE alerts only."""
    raised = mase_check(history).where("mase_alert")
    line = F.format_string(
        "%s: MASE of the last 4 weeks is %.3f, above 1.15", F.concat_ws("/", "series_id", "model_type"), F.col("rolling_mase")
    )
    return raised.select(*KEY, line.alias("message"))


def health_table(history: DataFrame) -> DataFrame:
    """Mean of the last four MASE values (of all when fewer), bias (0 when fewer) and a traffic light."""
    enough = F.count(F.lit(1)) >= ROLLING_WEEKS
    last_month = history.groupBy(*KEY).agg(
        _tail_mean("mase", ROLLING_WEEKS).alias("mase_4w"),
        F.when(enough, _tail_mean("error", ROLLING_WEEKS)).otherwise(F.lit(0.0)).alias("bias"),
    )
    status = (
        F.when(F.col("mase_4w") > MASE_ALERT, F.lit("RED"))
        .when(F.col("mase_4w") > MASE_AMBER, F.lit("AMBER"))
        .otherwise(F.lit("GREEN"))
    )
    return last_month.withColumn("status", status)


def health_counts(health: DataFrame) -> DataFrame:
    return health.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
