"""Additive model: piecewise-linear trend + yearly Fourier terms + holiday effects.

The design depends on the calendar, the state and the time span of a series, not on its sales, so the equations are
prepared once per (state, span). Changes of the trend have a Laplace prior: with all other terms solved for, they are
the only unknowns, and coordinate descent finds the few that aren't zero from one small matrix of the span.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weeklens.config import AdditiveConfig
from weeklens.functions.arrays import dot, let, ordered_values
from weeklens.functions.dates import add_weeks
from weeklens.functions.numeric import ratio, z_value
from weeklens.operators.forecasts import forecast_frame
from weeklens.operators.weekly import state_of
from weeklens.sources.calendar import holiday_table

MODEL = "additive"
SPAN = ("state", "first_week", "n")
_TREND_PENALTY = 1 / 25.0
#: Coordinate descent ends when no coefficient moves its gradient by this share of the largest one, or after SWEEPS.
SWEEPS, SETTLED = 2000, 1e-12


def design_input(train: DataFrame) -> DataFrame:
    """(series_id, ds, y)."""
    return train.select("series_id", F.col("week_start").alias("ds"), F.col("total_sales").cast("double").alias("y"))


def week_holidays(calendar: DataFrame, states: dict[str, str]) -> DataFrame:
    """(state, week_start, holidays): names of the holidays in each week."""
    return (
        holiday_table(calendar, states)
        .groupBy("state", F.trunc("ds", "week").alias("week_start"))
        .agg(F.array_sort(F.collect_set("holiday")).alias("holidays"))
    )


def _trend_terms(config: AdditiveConfig) -> Column:
    """1, t and one hinge per change point; t runs from 0 to 1 over the training span."""
    t = F.datediff("week_start", "first_week") / 7.0 / F.greatest(F.col("n") - 1, F.lit(1)).cast("double")
    knots = [config.changepoint_range * (j + 1) / config.changepoints for j in range(config.changepoints)]
    hinges = [F.greatest(F.lit(0.0), t - F.lit(knot)) for knot in knots]
    return F.array(F.lit(1.0), t, *hinges)


def _yearly_terms(config: AdditiveConfig) -> Column:
    day = F.datediff("week_start", F.lit("1970-01-01").cast("date")) / 365.25
    angles = [F.lit(2 * math.pi * k) * day for k in range(1, config.fourier_order + 1)]
    return F.array(*[f(a) for a in angles for f in (F.sin, F.cos)])


def _holiday_terms() -> Column:
    present = F.coalesce("holidays", F.array().cast("array<string>"))
    return F.transform("names", lambda name: F.array_contains(present, name).cast("double"))


def _penalties(config: AdditiveConfig, n_holidays: int) -> np.ndarray:
    """Weights of the squared coefficients; those of the trend's changes count with a normal prior only."""
    return np.concatenate(
        [
            [_TREND_PENALTY, _TREND_PENALTY],
            np.full(config.changepoints, config.changepoint_prior_scale**-2.0),
            np.full(2 * config.fourier_order, config.seasonality_prior_scale**-2.0),
            np.full(n_holidays, config.holidays_prior_scale**-2.0),
        ]
    )


def _sparse_terms(config: AdditiveConfig) -> int:
    if config.changepoint_prior not in ("laplace", "normal"):
        raise ValueError(f"unknown changepoint_prior {config.changepoint_prior!r}")
    return config.changepoints if config.changepoint_prior == "laplace" else 0


def span_systems(spans: DataFrame, holidays: DataFrame, config: AdditiveConfig = AdditiveConfig()) -> DataFrame:
    """(state, first_week, n, names, columns, inverse, weights, gram): what the fit of a span's series needs.

    ``columns`` holds a term's values in week order, in the order of the coefficients. Of the terms with squared
    penalties ``inverse`` is the inverted system; ``gram`` is that of the sparse terms after the others have explained
    what they can, and ``weights`` @ the others' products with a series is what they explain of the sparse terms' ones.
    """
    sparse = _sparse_terms(config)
    weeks = spans.select(
        *SPAN, F.explode(F.sequence(F.lit(0), (F.col("n") - 1).cast("int"))).alias("i")
    ).withColumn("week_start", add_weeks(F.col("first_week"), F.col("i")))
    flagged = weeks.join(holidays, ["state", "week_start"], "left")
    names = flagged.groupBy(*SPAN).agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("holidays")))).alias("names"))
    design = flagged.join(names, list(SPAN)).select(
        *SPAN, "names", "i", F.concat(_trend_terms(config), _yearly_terms(config), _holiday_terms()).alias("x")
    )

    def prepare(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("i")
        x = np.array([np.asarray(row, dtype=float) for row in group["x"]])
        names = group["names"].iloc[0]
        few, rest = x[:, 2 : 2 + sparse], np.delete(x, np.s_[2 : 2 + sparse], axis=1)
        penalty = np.delete(_penalties(config, len(names)), np.s_[2 : 2 + sparse])
        inverse = np.linalg.inv(rest.T @ rest + np.diag(penalty))
        weights = few.T @ rest @ inverse
        gram = few.T @ few - weights @ rest.T @ few
        row = {k: group[k].iloc[0] for k in SPAN}
        lists = {"columns": x.T, "inverse": inverse, "weights": weights, "gram": gram}
        return pd.DataFrame([{**row, "names": names, **{k: v.tolist() for k, v in lists.items()}}])

    schema = "state string, first_week date, n bigint, names array<string>, " + ", ".join(
        f"{c} array<array<double>>" for c in ("columns", "inverse", "weights", "gram")
    )
    return design.groupBy(*SPAN).applyInPandas(prepare, schema)


def _times(matrix: str | Column, vector: Column) -> Column:
    return F.transform(matrix, lambda row: dot(row, vector))


def _sparse_solution(products: Column, penalty: Column, sparse: int) -> Column:
    """The x that minimises x'gram x / 2 - x'products + penalty * sum |x|, by coordinate descent from zero."""
    gram = F.col("gram")
    none = F.array_repeat(F.lit(0.0), sparse)
    largest = F.array_max(F.transform(products, F.abs))

    def turn(x: Column, j: Column) -> Column:
        def put(slope: Column) -> Column:
            kept = F.greatest(F.lit(0.0), F.abs(slope) - penalty) * F.signum(slope)
            new = F.coalesce(ratio(kept, gram[j][j]), F.lit(0.0))
            return F.transform(x, lambda v, i: F.when(i == j, new).otherwise(v))

        return let(products[j] - dot(gram[j], x) + gram[j][j] * x[j], put)

    def sweep(state: Column, _: Column) -> Column:
        def moved(x: Column) -> Column:
            steps = F.transform(F.zip_with(x, state["x"], lambda a, b: F.abs(a - b)), lambda v, j: v * gram[j][j])
            return F.struct(x.alias("x"), (F.array_max(steps) <= SETTLED * largest).alias("done"))

        onward = let(F.aggregate(F.sequence(F.lit(0), F.lit(sparse - 1)), state["x"], turn), moved)
        return F.when(state["done"], state).otherwise(onward)

    zero = F.struct(none.alias("x"), F.lit(False).alias("done"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(SWEEPS)), zero, sweep, lambda s: s["x"])


def additive_fit(
    train: DataFrame, calendar: DataFrame, states: dict[str, str], config: AdditiveConfig = AdditiveConfig()
) -> DataFrame:
    """(series_id, state, first_week, n, names, coef, sigma2) for dense training series.

    Without a change of trend the other terms leave errors with some variance; the Laplace prior of scale
    ``changepoint_prior_scale`` on changes relative to the largest value then costs a change that variance over
    scale and largest value, times its size. Series meet the system of their span in one join, whatever the number of
    spans. A common span may belong to most series: adaptive execution measures both sides, then sends small systems to
    the series or splits the large span.
    """
    sparse = _sparse_terms(config)
    series = train.groupBy("series_id").agg(
        F.min("week_start").alias("first_week"),
        F.count(F.lit(1)).alias("n"),
        ordered_values("week_start", "total_sales").alias("y"),
    )
    placed = series.withColumn("state", state_of("series_id"))
    spans = (
        train.groupBy("series_id")
        .agg(F.min("week_start").alias("first_week"), F.count(F.lit(1)).alias("n"))
        .select(state_of("series_id").alias("state"), "first_week", "n")
        .distinct()
    )
    systems = span_systems(spans, week_holidays(calendar, states), config)
    joined = placed.join(systems, list(SPAN)).withColumn("c", _times("columns", F.col("y")))
    # The others' own solution, and the errors that it leaves.
    others = F.concat(F.slice("c", 1, 2), F.slice("c", 3 + sparse, F.size("c") - 2 - sparse))
    alone = joined.withColumn("r", others).withColumn("plain", _times("inverse", F.col("r")))
    if sparse:
        beside = F.concat(F.slice("plain", 1, 2), F.array_repeat(F.lit(0.0), sparse), F.slice("plain", 3, F.size("plain") - 2))
        alone = alone.withColumn("spread", _error(beside))
        cost = ratio(F.col("spread"), config.changepoint_prior_scale * F.array_max(F.transform("y", F.abs)))
        left = F.zip_with(F.slice("c", 3, sparse), _times("weights", F.col("r")), lambda a, b: a - b)
        solved = alone.withColumns({"left": left, "cost": F.coalesce(cost, F.lit(0.0))})
        solved = solved.withColumn("few", _sparse_solution(F.col("left"), F.col("cost"), sparse))
        given = F.transform("plain", lambda v, i: v - F.aggregate(F.sequence(F.lit(0), F.lit(sparse - 1)), F.lit(0.0), lambda s, j: s + F.col("few")[j] * F.col("weights")[j][i]))
        solved = solved.withColumn("given", given)
        coef = F.concat(F.slice("given", 1, 2), "few", F.slice("given", 3, F.size("given") - 2))
    else:
        solved, coef = alone, F.col("plain")
    fitted = solved.select("series_id", *SPAN, "names", "y", "columns", coef.alias("coef"))
    return fitted.select("series_id", *SPAN, "names", "coef", _error(F.col("coef")).alias("sigma2"))


def _error(coef: Column) -> Column:
    """Mean squared difference of ``y`` from the columns' sum with these coefficients."""
    terms = F.zip_with("columns", coef, lambda column, c: F.transform(column, lambda v: v * c))
    missed = F.aggregate(terms, F.col("y"), lambda left, term: F.zip_with(left, term, lambda a, b: a - b))
    return dot(missed, missed) / F.col("n")


def _components(weeks: DataFrame, params: DataFrame, holidays: DataFrame, config: AdditiveConfig) -> DataFrame:
    """Partial products of design and coefficients per (series_id, week_start); NULL without parameters.

    ``ahead`` is the time behind the training span, in units of that span.
    """
    rows = weeks.join(params, "series_id", "left").join(holidays, ["state", "week_start"], "left")
    n_trend, n_yearly = 2 + config.changepoints, 2 * config.fourier_order
    coef = F.col("coef")
    holiday_coef = F.slice(coef, F.lit(n_trend + n_yearly + 1), F.size("names"))
    return rows.select(
        *weeks.columns,
        "sigma2",
        dot(_trend_terms(config), F.slice(coef, 1, n_trend)).alias("trend"),
        dot(_yearly_terms(config), F.slice(coef, n_trend + 1, n_yearly)).alias("yearly"),
        dot(_holiday_terms(), holiday_coef).alias("holidays"),
        F.greatest(F.lit(0.0), F.element_at(_trend_terms(config), 2) - 1.0).alias("ahead"),
        F.slice(coef, 3, config.changepoints).alias("changes"),
    )


def _trend_spread(config: AdditiveConfig) -> Column:
    """Variance that changes of the trend to come add: they are as frequent and as large as those of the training span.

    Changes arrive evenly, ``changepoints`` a span, with a Laplace distribution around zero whose scale is the mean size
    of the fitted ones. One that happens u before the end moves it by u times its size, so the variance is the integral
    of changepoints * 2 scale^2 u^2 over the time ahead.
    """
    sizes = F.transform("changes", F.abs)
    scale = F.aggregate(sizes, F.lit(0.0), lambda s, v: s + v) / float(max(config.changepoints, 1))
    return 2.0 * config.changepoints / 3.0 * scale * scale * F.pow("ahead", F.lit(3.0))


def additive_components(
    weeks: DataFrame, params: DataFrame, calendar: DataFrame, states: dict[str, str],
    config: AdditiveConfig = AdditiveConfig(),
) -> DataFrame:
    """(series_id, week_start, trend, yearly, holidays, fitted) for any weeks, past or future.

    Series without parameters keep their weeks, with NULL values.
    """
    parts = _components(weeks.select("series_id", "week_start"), params, week_holidays(calendar, states), config)
    fitted = F.col("trend") + F.col("yearly") + F.col("holidays")
    return parts.select("series_id", "week_start", "trend", "yearly", "holidays", fitted.alias("fitted"))


def additive_forecast(
    weeks: DataFrame, params: DataFrame, calendar: DataFrame, states: dict[str, str],
    config: AdditiveConfig = AdditiveConfig(),
) -> DataFrame:
    """Forecast frame for (series_id, horizon, forecast_date) rows, with the configured interval.

    Behind the training span the interval widens by what changes of the trend may do. Series without parameters keep
    their rows, with NULL values.
    """
    dated = weeks.select("series_id", "horizon", "forecast_date", F.col("forecast_date").alias("week_start"))
    parts = _components(dated, params, week_holidays(calendar, states), config)
    point = F.col("trend") + F.col("yearly") + F.col("holidays")
    half = F.lit(z_value(0.5 + config.interval_width / 2)) * F.sqrt(F.col("sigma2") + _trend_spread(config))
    return forecast_frame(parts, MODEL, point, point - half, point + half)


def additive_in_sample(
    train: DataFrame, params: DataFrame, calendar: DataFrame, states: dict[str, str],
    config: AdditiveConfig = AdditiveConfig(),
) -> DataFrame:
    """Fitted values with bounds over the training weeks."""
    weeks = train.select("series_id", F.lit(0).alias("horizon"), F.col("week_start").alias("forecast_date"))
    return additive_forecast(weeks, params, calendar, states, config)
