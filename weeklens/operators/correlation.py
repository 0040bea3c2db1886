"""Autocorrelation, partial autocorrelation, Ljung-Box and unit-root tests for every series."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weeklens.functions.arrays import dot, lag_products, let, ordered_values, total
from weeklens.functions.numeric import chi_square_tail, ratio, z_value
from weeklens.operators.weekly import series_window


def autocorrelations(df: DataFrame, nlags: int, value: str = "total_sales") -> DataFrame:
    """(series_id, n, r): r[k] is the biased autocorrelation at lag k, k = 0..nlags.

    Lag products come from window lags and one aggregate on the same key, so a series moves once and no
    pair rows are made.
    """
    y = F.col(value).cast("double")
    centred = df.where(F.col(value).isNotNull()).select(
        "series_id", "week_start", (y - F.avg(y).over(Window.partitionBy("series_id"))).alias("c")
    )
    lags = range(nlags + 1)
    products = centred.selectExpr(
        "series_id",
        *[f"c * lag(c, {k}) OVER (PARTITION BY series_id ORDER BY week_start) AS p{k}" for k in lags],
    )
    totals = ", ".join(f"coalesce(sum(p{k}), 0D)" for k in lags)
    sums = products.groupBy("series_id").agg(F.count(F.lit(1)).alias("n"), F.expr(f"array({totals})").alias("s"))
    return sums.select("series_id", "n", F.transform("s", lambda v: ratio(v, F.col("s")[0])).alias("r"))


def acf(df: DataFrame, nlags: int = 60, alpha: float = 0.05, value: str = "total_sales") -> DataFrame:
    """Autocorrelation at lags 0..nlags with Bartlett's band; lag 0 has a band of no width."""
    return acf_rows(autocorrelations(df, nlags, value), alpha)


def acf_rows(correlations: DataFrame, alpha: float = 0.05) -> DataFrame:
    """``acf`` from a frame of ``autocorrelations``."""
    z = z_value(1 - alpha / 2)
    rows = correlations.select("series_id", "n", F.posexplode("r").alias("lag", "acf"))
    earlier = Window.partitionBy("series_id").orderBy("lag").rowsBetween(Window.unboundedPreceding, -1)
    squares = F.coalesce(F.sum(F.when(F.col("lag") > 0, F.col("acf") * F.col("acf"))).over(earlier), F.lit(0.0))
    variance = F.when(F.col("lag") == 0, F.lit(0.0)).otherwise((1.0 + 2.0 * squares) / F.col("n"))
    half = F.lit(z) * F.sqrt(variance)
    return rows.select(
        "series_id", "lag", "acf", (F.col("acf") - half).alias("acf_lower"), (F.col("acf") + half).alias("acf_upper")
    )


def _levinson(r: Column, nlags: int) -> Column:
    """Partial autocorrelations 1..nlags from autocorrelations 0..nlags (Durbin-Levinson as a fold)."""
    empty = F.array().cast("array<double>")
    zero = F.struct(empty.alias("phi"), F.lit(1.0).alias("v"), empty.alias("out"))

    def step(state: Column, k: Column) -> Column:
        past = F.reverse(F.slice(r, 2, k - 1))

        def update(partial: Column) -> Column:
            phi = F.zip_with(state["phi"], F.reverse(state["phi"]), lambda a, b: a - partial * b)
            return F.struct(
                F.concat(phi, F.array(partial)).alias("phi"),
                (state["v"] * (1.0 - partial * partial)).alias("v"),
                F.concat(state["out"], F.array(partial)).alias("out"),
            )

        return let(ratio(r[k] - dot(state["phi"], past), state["v"]), update)

    return F.aggregate(F.sequence(F.lit(1), F.lit(nlags)), zero, step, lambda s: s["out"])


def pacf(df: DataFrame, nlags: int = 60, alpha: float = 0.05, value: str = "total_sales") -> DataFrame:
    """Partial autocorrelation (Yule-Walker, biased) with the +-z/sqrt(n) band.

    A series of at most twice as many values as lags keeps its rows, with NULL values and an ``error``.
    """
    return pacf_rows(autocorrelations(df, nlags, value), nlags, alpha)


def pacf_rows(correlations: DataFrame, nlags: int = 60, alpha: float = 0.05) -> DataFrame:
    """``pacf`` from a frame of ``autocorrelations`` with at least ``nlags`` lags."""
    z = z_value(1 - alpha / 2)
    long_enough = F.col("n") > 2 * nlags
    values = F.concat(F.array(F.lit(1.0)), _levinson(F.col("r"), nlags))
    unknown = F.array_repeat(F.lit(None).cast("double"), nlags + 1)
    error = F.when(~long_enough, F.format_string("%d values do not exceed twice %d lags", F.col("n"), F.lit(nlags)))
    rows = correlations.select(
        "series_id", "n", error.alias("error"), F.when(long_enough, values).otherwise(unknown).alias("p")
    ).select("series_id", "n", "error", F.posexplode("p").alias("lag", "pacf"))
    half = F.when(F.col("lag") == 0, F.lit(0.0)).otherwise(F.lit(z) / F.sqrt(F.col("n").cast("double")))
    return rows.select(
        "series_id",
        "lag",
        "pacf",
        (F.col("pacf") - half).alias("pacf_lower"),
        (F.col("pacf") + half).alias("pacf_upper"),
        "error",
    )


def ljung_box(residuals: DataFrame, lags: int = 10, value: str = "residual") -> DataFrame:
    """Ljung-Box statistic, p-value and whether the residuals pass as white noise at 5 %."""
    r = autocorrelations(residuals, lags, value)
    n = F.col("n").cast("double")
    terms = [F.col("r")[k] * F.col("r")[k] / (n - k) for k in range(1, lags + 1)]
    stat = r.select("series_id", (n * (n + 2.0) * reduce(lambda a, b: a + b, terms)).alias("lb_stat"))
    tested = stat.withColumn("lb_pvalue", chi_square_tail(F.col("lb_stat"), lags))
    return tested.withColumn("passed", F.col("lb_pvalue") > 0.05)


# MacKinnon (1994, 2010) response surfaces, regression with constant, one series.
_ADF_MAX, _ADF_MIN, _ADF_SPLIT = 2.74, -18.83, -1.61
_ADF_SMALL_P = (2.1659, 1.4412, 0.038269)
_ADF_LARGE_P = (1.7339, 0.93202, -0.12745, -0.010368)
_ADF_CRITICAL = {
    "1%": (-3.43035, -6.5393, -16.786, -79.433),
    "5%": (-2.86154, -2.8903, -4.234, -40.040),
    "10%": (-2.56677, -1.5384, -2.809, 0.0),
}


def normal_share(z: Column) -> Column:
    """Standard normal distribution function."""
    half_tail = chi_square_tail(z * z, 1) / 2.0
    return F.when(z < 0, half_tail).otherwise(1.0 - half_tail)


def unit_root_p(statistic: Column) -> Column:
    """P-value of a Dickey-Fuller statistic by the response surface."""
    surface = lambda coefficients: reduce(lambda acc, c: acc * statistic + F.lit(c), reversed(coefficients[:-1]), F.lit(coefficients[-1]))
    z = F.when(statistic <= _ADF_SPLIT, surface(_ADF_SMALL_P)).otherwise(surface(_ADF_LARGE_P))
    return F.when(statistic > _ADF_MAX, F.lit(1.0)).when(statistic < _ADF_MIN, F.lit(0.0)).otherwise(normal_share(z))


#: A pivot below this share of its own sum of squares is a column that the ones before it explain.
_PIVOT = 1e-12


def _normal_sums(df: DataFrame, trim: Column, lags: Column) -> DataFrame:
    """Adds the sums of products that regressions of ``d`` on the level ``y`` and ``lags`` earlier changes are made of.

    ``d`` is the array of changes, ``y`` that of levels before them; rows start behind ``trim`` changes.
    """
    n, t = F.size("d"), F.col("trim")
    every = F.sequence(F.lit(0), F.col("lags"))
    framed = df.withColumns({"trim": trim.cast("int"), "lags": lags.cast("int")}).withColumn("rows", n - t)
    at_lag = lambda k: F.slice("d", t - k + 1, F.col("rows"))
    level = F.slice("y", t + 1, F.col("rows"))
    return framed.withColumns(
        {
            "s": lag_products(F.col("d"), t, F.col("rows"), F.col("lags")),
            "level_d": F.transform(every, lambda k: dot(level, at_lag(k))),
            "one_d": F.transform(every, lambda k: total(at_lag(k))),
            "level_1": total(level),
            "level_2": dot(level, level),
        }
    )


def _swept(matrix: str, pivots: Column) -> Column:
    """(m, left): the matrix with the columns of the first ``pivots`` rows removed, and its last element at each step.

    A column that earlier ones explain is passed over, so the last element, the squares left to explain, stays.
    """
    zero = F.struct(F.col(matrix).alias("m"), F.array().cast("array<double>").alias("left"))

    def step(state: Column, j: Column) -> Column:
        m = state["m"]

        def reduced(row: Column, i: Column) -> Column:
            free = (i > j) & (m[j][j] > _PIVOT * F.col(matrix)[j][j])
            return F.when(free, F.zip_with(row, m[j], lambda a, p: a - row[j] / m[j][j] * p)).otherwise(row)

        def collect(rows: Column) -> Column:
            last = F.element_at(F.element_at(rows, -1), -1)
            return F.struct(rows.alias("m"), F.concat(state["left"], F.array(last)).alias("left"))

        return let(F.transform(m, reduced), collect)

    return F.aggregate(F.sequence(F.lit(0), pivots - 1), zero, step)


def _matrix(level_last: bool) -> Column:
    """Rows for the constant, the level and the lags, and last for the changes that they explain."""
    lagged = lambda c: F.slice(c, F.lit(2), F.col("lags"))
    own = lambda c: F.slice(c, F.lit(1), F.lit(1))
    ordered = lambda one, level, lags: F.concat(one, lags, level) if level_last else F.concat(one, level, lags)
    single = lambda c: F.array(c)
    count = F.col("rows").cast("double")
    row = lambda one, level, products: F.concat(ordered(single(one), single(level), lagged(products)), own(products))
    constant = row(count, F.col("level_1"), F.col("one_d"))
    level = row(F.col("level_1"), F.col("level_2"), F.col("level_d"))
    rows = F.transform("s", lambda products, k: row(F.col("one_d")[k], F.col("level_d")[k], products))
    return F.concat(ordered(single(constant), single(level), F.slice(rows, F.lit(2), F.col("lags"))), F.slice(rows, F.lit(1), F.lit(1)))


def adf_test(weekly: DataFrame, significance: float = 0.05, value: str = "total_sales") -> DataFrame:
    """Augmented Dickey-Fuller test with a constant and AIC lag choice, on one bounded array per series.

    All lag orders share one set of normal equations: removing the columns of the constant, the level and then one lag
    after another leaves the squared errors of every order. The statistic is that of the chosen order on all its rows.
    A series that is constant or too short keeps its row, with NULL values and an ``error``.
    """
    known = weekly.where(F.col(value).isNotNull()).groupBy("series_id").agg(ordered_values("week_start", value).alias("v"))
    n = F.size("v")
    most = F.least(F.floor(n / 2) - 2, F.ceil(12 * F.pow(n / 100, F.lit(0.25)))).cast("int")
    told = known.withColumn("most", F.when(F.array_max("v") > F.array_min("v"), most).otherwise(-1))
    # Centred levels leave the statistic as it is and the sums well conditioned.
    centred = let(total(F.col("v")) / n, lambda mean: F.transform("v", lambda x: x - mean))
    tested = told.where("most >= 0").select("series_id", "most", centred.alias("y"))
    tested = tested.withColumn("d", F.zip_with(F.slice("y", F.lit(2), F.size("y") - 1), F.slice("y", F.lit(1), F.size("y") - 1), lambda a, b: a - b))
    orders = _normal_sums(tested, F.col("most"), F.col("most")).withColumn("x", _matrix(level_last=False))
    left = F.slice(_swept("x", F.col("most") + 2)["left"], F.lit(2), F.col("most") + 1)
    rows, squares = F.col("rows").cast("double"), F.col("s")[0][0]
    none_left = lambda rss: rss <= _PIVOT * squares
    aic = F.transform(left, lambda rss, k: F.when(none_left(rss), F.lit(-math.inf)).otherwise(rows * (F.lit(math.log(2 * math.pi)) + F.ln(rss / rows) + 1) + 2 * (k + 2)))
    chosen = orders.select("series_id", "y", "d", aic.alias("aic")).select(
        "series_id", "y", "d", (F.array_position("aic", F.array_min("aic")) - 1).cast("int").alias("chosen")
    )
    final = _normal_sums(chosen, F.col("chosen"), F.col("chosen")).withColumn("x", _matrix(level_last=True))
    m = _swept("x", F.col("lags") + 1)["m"]
    size = F.col("lags") + 2
    final = final.select(
        "series_id", "lags", "rows", F.col("s")[0][0].alias("squares"),
        m[size - 1][size - 1].alias("a"), m[size - 1][size].alias("b"), m[size][size].alias("c"),
    )
    rss = F.col("c") - F.col("b") * F.col("b") / F.col("a")
    spread = rss / (F.col("rows") - F.col("lags") - 2) / F.col("a")
    stat = F.when(rss <= _PIVOT * F.col("squares"), F.lit(-math.inf)).otherwise(F.col("b") / F.col("a") / F.sqrt(spread))
    scored = final.select("series_id", stat.alias("test_stat"), F.col("lags").alias("lags_used"), F.col("rows").alias("n_used"))
    scored = scored.withColumn("p_value", unit_root_p(F.col("test_stat")))
    over = lambda surface: reduce(lambda acc, c: acc / F.col("n_used") + F.lit(c), reversed(surface[:-1]), F.lit(surface[-1]))
    critical = F.create_map(*[x for level, surface in _ADF_CRITICAL.items() for x in (F.lit(level), over(surface))])
    status = F.when(F.col("p_value") < significance, "STATIONARY").otherwise("NON-STATIONARY")
    scored = scored.withColumns({"critical_values": critical, "status": status})
    error = F.when(F.col("most") < 0, F.lit("series too short or constant"))
    return told.select("series_id", error.alias("error")).join(scored, "series_id", "left").select(
        "series_id", "test_stat", "p_value", "lags_used", "n_used", "critical_values", "status", "error"
    )
