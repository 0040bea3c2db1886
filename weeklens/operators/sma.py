"""Seasonal autoregression with moving-average terms, (1,1,1)(1,1,1)[s], for all series at once.

(1 - phi B)(1 - Phi B^s) w = (1 + theta B)(1 + Theta B^s) e with w = (1 - B)(1 - B^s) y. A long autoregression gives the
shocks e; the four coefficients then minimise the squared errors of w on its own lags and those of the shocks, the
cross terms at s + 1 included. Both stages work on grouped sums: a series moves once, and what is solved is the sums.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weeklens.config import SeasonalArConfig
from weeklens.functions.arrays import let, ordered_values, solve
from weeklens.functions.dates import add_weeks
from weeklens.functions.numeric import ratio, z_value
from weeklens.operators.forecasts import forecast_frame
from weeklens.operators.sar import differenced
from weeklens.operators.weekly import last_rows, series_window

MODEL = "sma"
COEFFICIENTS = ("phi1", "phi_s", "theta1", "theta_s")
#: Lags of the long autoregression besides the season and the one after it.
SHORT_LAGS = (1, 2, 3, 4)
#: The two pairs of coefficients are solved in turn; the error falls with every turn.
TURNS = 40
_FREE_PARAMETERS = 5
#: Regressors of the second stage and, last, what they explain.
_TERMS = ("w1", "ws", "wx", "e1", "es", "ex", "w")


def _lags(season: int) -> tuple[int, ...]:
    return (*[k for k in SHORT_LAGS if k < season], season, season + 1)


def _back(column: str, k: int) -> Column:
    return F.lag(column, k).over(series_window())


def _sum(terms: list[Column]) -> Column:
    total = terms[0]
    for term in terms[1:]:
        total = total + term
    return total


def long_autoregression(history: DataFrame, season: int) -> DataFrame:
    """(series_id, ar): coefficients at the lags of ``_lags``; NULL elements where the sums don't determine them."""
    lags = _lags(season)
    rows = differenced(history, season).select("series_id", "w", *[_back("w", k).alias(f"l{k}") for k in lags])
    names = [f"l{k}" for k in lags]
    whole = rows.where(F.col(names[-1]).isNotNull())
    products = [F.sum(F.col(a) * F.col(b)).alias(f"{a}_{b}") for i, a in enumerate(names) for b in [*names[i:], "w"]]
    sums = whole.groupBy("series_id").agg(*products)
    of = lambda a, b: F.col(f"{a}_{b}" if b == "w" or names.index(a) <= names.index(b) else f"{b}_{a}")
    matrix = F.array(*[F.array(*[of(a, b) for b in [*names, "w"]]) for a in names])
    return sums.select("series_id", solve(matrix).alias("ar"))


def _with_shocks(history: DataFrame, ar: DataFrame, season: int) -> DataFrame:
    """(series_id, week_start, y, w, e); series without coefficients keep their rows, with NULL shocks."""
    lags = _lags(season)
    rows = differenced(history, season).select("series_id", "week_start", "y", "w", *[_back("w", k).alias(f"l{k}") for k in lags])
    fitted = rows.join(ar, "series_id", "left")
    shock = F.col("w")
    for i, k in enumerate(lags):
        shock = shock - F.col("ar")[i] * F.col(f"l{k}")
    return fitted.select("series_id", "week_start", "y", "w", shock.alias("e"))


def _terms(history: DataFrame, ar: DataFrame, season: int) -> DataFrame:
    """(series_id, week_start, w and the six regressors), NULL where one of them reaches before the series."""
    w, e = (1, season, season + 1), ("w", "e")
    lagged = [_back(column, k).alias(column + tag) for column in e for k, tag in zip(w, "1sx")]
    return _with_shocks(history, ar, season).select("series_id", "week_start", "w", *lagged)


def _form(left: dict[str, Column | None], right: dict[str, Column | None]) -> Column:
    """The product of two weighted sums of terms, from the sums of the terms' products; a weight of None is one."""
    parts = []
    for a, p in left.items():
        for b, q in right.items():
            i, j = sorted((a, b), key=_TERMS.index)
            part = F.col(f"{i}_{j}")
            for weight in (p, q):
                part = part if weight is None else weight * part
            parts.append(part)
    return _sum(parts)


def _pair(target: dict, first: dict, second: dict) -> tuple[Column, Column]:
    """Least-squares coefficients of two weighted sums of terms for a third."""
    aa, ab, bb = _form(first, first), _form(first, second), _form(second, second)
    at, bt = _form(first, target), _form(second, target)
    det = aa * bb - ab * ab
    return ratio(at * bb - bt * ab, det), ratio(bt * aa - at * ab, det)


def _turn(c: Column) -> Column:
    """One solution of (phi1, theta1) for given seasonal coefficients, then of those for what was found."""

    def seasonal(near: Column) -> Column:
        phi, theta = near["a"], near["b"]
        far = _pair({"w": None, "w1": -phi, "e1": -theta}, {"ws": None, "wx": -phi}, {"es": None, "ex": theta})
        return F.struct(phi.alias("phi1"), far[0].alias("phi_s"), theta.alias("theta1"), far[1].alias("theta_s"))

    phi, theta = c["phi_s"], c["theta_s"]
    near = _pair({"w": None, "ws": -phi, "es": -theta}, {"w1": None, "wx": -phi}, {"e1": None, "ex": theta})
    return let(F.struct(near[0].alias("a"), near[1].alias("b")), seasonal)


def sma_fit(train: DataFrame, config: SeasonalArConfig = SeasonalArConfig()) -> DataFrame:
    """phi1, phi_s, theta1, theta_s, sigma2, n_used, aic, bic, ar and error for every series of ``train``.

    Coefficients are NULL, and ``error`` tells why, where a series has no more complete regression rows than parameters
    or its sums don't determine them.
    """
    ar = long_autoregression(train, config.season)
    rows = _terms(train, ar, config.season)
    complete = F.col("ex").isNotNull()
    products = [F.sum(F.when(complete, F.col(a) * F.col(b))).alias(f"{a}_{b}") for i, a in enumerate(_TERMS) for b in _TERMS[i:]]
    sums = rows.groupBy("series_id").agg(F.count("ex").alias("n_used"), *products)
    zero = F.struct(*[F.lit(0.0).alias(c) for c in COEFFICIENTS])
    solved = sums.withColumn("c", F.aggregate(F.sequence(F.lit(1), F.lit(TURNS)), zero, lambda c, _: _turn(c)))
    enough = (F.col("n_used") > _FREE_PARAMETERS) & _sum([F.col(f"c.{c}") for c in COEFFICIENTS]).isNotNull()
    flat = solved.select("*", *[F.when(enough, F.col(f"c.{c}")).alias(c) for c in COEFFICIENTS])
    phi, far, theta, far_theta = (F.col(c) for c in COEFFICIENTS)
    rest = {"w": None, "w1": -phi, "ws": -far, "wx": phi * far, "e1": -theta, "es": -far_theta, "ex": -theta * far_theta}
    rss, n = _form(rest, rest), F.col("n_used").cast("double")
    variance = flat.withColumn("sigma2", F.when(rss.isNotNull(), F.greatest(F.lit(0.0), rss) / n))
    deviance = n * (F.ln(F.lit(2 * math.pi) * F.col("sigma2")) + 1.0)
    error = F.when(F.col("phi1").isNull(), F.format_string("%d regression rows don't determine %d parameters", "n_used", F.lit(_FREE_PARAMETERS)))
    return variance.join(ar, "series_id", "left").select(
        "series_id", *COEFFICIENTS, "sigma2", "n_used",
        (deviance + 2.0 * _FREE_PARAMETERS).alias("aic"), (deviance + _FREE_PARAMETERS * F.ln(n)).alias("bic"),
        "ar", error.alias("error"),
    )


def sma_residuals(train: DataFrame, params: DataFrame, season: int = SeasonalArConfig.season) -> DataFrame:
    """(series_id, week_start, residual) of the weeks whose regressors are all known."""
    rows = _terms(train, params.select("series_id", "ar"), season).where(F.col("ex").isNotNull())
    phi, far, theta, far_theta = (F.col(c) for c in COEFFICIENTS)
    explained = _sum([phi * F.col("w1"), far * F.col("ws"), -phi * far * F.col("wx"), theta * F.col("e1"), far_theta * F.col("es"), theta * far_theta * F.col("ex")])
    return rows.join(params.select("series_id", *COEFFICIENTS), "series_id").select(
        "series_id", "week_start", (F.col("w") - explained).alias("residual")
    )


def _extend(levels: Column, changes: Column, shocks: Column, steps: int, season: int) -> Column:
    """Appends ``steps`` values to the level array; shocks to come are zero."""
    zero = F.struct(levels.alias("y"), changes.alias("w"), shocks.alias("e"))
    phi, far, theta, far_theta = (F.col(c) for c in COEFFICIENTS)

    def step(state: Column, _: Column) -> Column:
        back = lambda name, k: F.element_at(state[name], -k)

        def grow(w: Column) -> Column:
            y = back("y", 1) + back("y", season) - back("y", season + 1) + w
            return F.struct(
                F.concat(state["y"], F.array(y)).alias("y"), F.concat(state["w"], F.array(w)).alias("w"),
                F.concat(state["e"], F.array(F.lit(0.0))).alias("e"),
            )

        own = phi * back("w", 1) + far * back("w", season) - phi * far * back("w", season + 1)
        moved = theta * back("e", 1) + far_theta * back("e", season) + theta * far_theta * back("e", season + 1)
        return let(own + moved, grow)

    if steps == 0:
        return levels
    return F.aggregate(F.sequence(F.lit(1), F.lit(steps)), zero, step, lambda s: s["y"])


def _impulse(length: int) -> Column:
    return F.concat(F.array_repeat(F.lit(0.0), length - 1), F.array(F.lit(1.0)))


def sma_forecast(
    history: DataFrame, params: DataFrame, steps: int, config: SeasonalArConfig = SeasonalArConfig()
) -> DataFrame:
    """Forecast frame with (1 - alpha) intervals from the last history row of each series.

    The state is the last season + 1 levels, changes and shocks. Every series of ``history`` gets its ``steps`` rows;
    their values are NULL where it has no coefficients or is shorter than the state.
    """
    season = config.season
    rows = _with_shocks(history, params.select("series_id", "ar"), season)
    known = lambda column: F.transform(ordered_values("week_start", column), lambda v: F.coalesce(v, F.lit(0.0)))
    state = last_rows(rows, season + 1).groupBy("series_id").agg(
        F.max("week_start").alias("last_week"), ordered_values("week_start", "y").alias("levels"),
        known("w").alias("changes"), known("e").alias("shocks"),
    )
    fitted = state.join(params.select("series_id", *COEFFICIENTS, "sigma2"), "series_id", "left")
    extended = F.slice(_extend(F.col("levels"), F.col("changes"), F.col("shocks"), steps, season), season + 2, steps)
    unknown = F.array_repeat(F.lit(None).cast("double"), steps)
    points = F.when((F.size("levels") == season + 1) & F.col("phi1").isNotNull(), extended).otherwise(unknown)
    one = _impulse(season + 1)
    weights = F.slice(_extend(one, one, one, steps - 1, season), season + 1, steps)
    folded = fitted.select("series_id", "last_week", "sigma2", points.alias("points"), weights.alias("weights"))
    rows = folded.select("series_id", "last_week", "sigma2", "weights", F.posexplode("points").alias("i", "point"))
    spread = F.aggregate(F.slice("weights", F.lit(1), F.col("i") + 1), F.lit(0.0), lambda s, v: s + v * v)
    dated = rows.select(
        "series_id", (F.col("i") + 1).alias("horizon"), add_weeks(F.col("last_week"), F.col("i") + 1).alias("forecast_date"),
        "point", (F.lit(z_value(1 - config.alpha / 2)) * F.sqrt(F.col("sigma2") * spread)).alias("half"),
    )
    point, half = F.col("point"), F.col("half")
    return forecast_frame(dated, MODEL, point, point - half, point + half)
