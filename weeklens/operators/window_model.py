"""Window learner: a linear model on the last ``window`` scaled values, trained on all series together.

Its penalty is chosen on the validation weeks: one pass sums the products of lagged values for each split, and a path of
penalties is solved and judged on these sums alone.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressionModel, GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weeklens.config import WindowConfig, checkpointed
from weeklens.functions.arrays import dot, lag_products, ordered_values, solve, total
from weeklens.functions.dates import add_weeks
from weeklens.operators.forecasts import forecast_frame
from weeklens.operators.split import scale_in_place, training_windows, validation_windows
from weeklens.operators.weekly import last_rows

MODEL = "window"
TREE_MODEL = "window_trees"
_ROUNDS_PER_CUT = 4


#: Penalties of a path, strongest last.
PENALTIES = (1e-6, 1e-5, 1e-4, 1e-3, 1e-2, 1e-1)


@dataclass(frozen=True)
class WindowModel:
    """Fitted weights, oldest week first, the training objective per iteration, and the penalty."""

    weights: tuple[float, ...]
    intercept: float
    losses: tuple[float, ...]
    penalty: float = WindowConfig.reg_param

    @property
    def window(self) -> int:
        return len(self.weights)

    def weight_array(self) -> Column:
        return F.array(*[F.lit(w) for w in self.weights])


def _samples(scaled: DataFrame, config: WindowConfig) -> DataFrame:
    return training_windows(scaled, "scaled", config.window).select(
        array_to_vector("inputs").alias("features"), F.col("target").alias("label")
    )


def split_sums(labelled: DataFrame, window: int) -> DataFrame:
    """(split, n, m): the number of windows of all series, and the sums of products that least squares needs of them.

    Row and column 0 of ``m`` are the constant, 1 the week itself, 1 + k the week k weeks before. Validation windows
    reach back into the training weeks. Each series is one array, bounded by the calendar; what leaves it are the sums.
    """
    scaled = scale_in_place(labelled.where(F.col("split") != "test"))
    arrays = scaled.groupBy("series_id").agg(
        ordered_values("week_start", "scaled").alias("x"), F.count_if(F.col("split") == "train").cast("int").alias("n_train")
    )
    spans = F.array(
        F.struct(F.lit("train").alias("split"), F.lit(window).alias("start"), F.col("n_train").alias("stop")),
        F.struct(F.lit("val").alias("split"), F.greatest(F.lit(window), "n_train").alias("start"), F.size("x").alias("stop")),
    )
    rows = arrays.select("x", F.explode(spans).alias("s")).select("x", "s.split", "s.start", (F.col("s.stop") - F.col("s.start")).alias("rows"))
    rows = rows.where("rows > 0").withColumn(
        "p", F.when(F.col("rows") > 0, lag_products(F.col("x"), F.col("start"), F.col("rows"), F.lit(window)))
    )
    ones = F.transform(F.sequence(F.lit(0), F.lit(window)), lambda k: total(F.slice("x", F.col("start") - k + 1, F.greatest(F.lit(0), "rows"))))
    # One flat array a series: the constant's row, then the others.
    flat = rows.select("split", F.concat(F.array(F.col("rows").cast("double")), ones, F.flatten("p")).alias("v"))
    sums = flat.select("split", F.posexplode("v").alias("at", "v")).groupBy("split", "at").agg(F.sum("v").alias("v"))
    whole = sums.groupBy("split").agg(F.transform(F.array_sort(F.collect_list(F.struct("at", "v"))), lambda e: e["v"]).alias("v"))
    size = window + 1
    body = F.transform(F.sequence(F.lit(0), F.lit(window)), lambda i: F.concat(F.array(F.col("v")[i + 1]), F.slice("v", i * size + size + 2, F.lit(size))))
    return whole.select("split", F.col("v")[0].alias("n"), F.concat(F.array(F.slice("v", F.lit(1), F.lit(size + 1))), body).alias("m"))


def window_path(
    labelled: DataFrame, config: WindowConfig = WindowConfig(), penalties: tuple[float, ...] = PENALTIES
) -> DataFrame:
    """(penalty, train_loss, val_loss, intercept, weights): the ridge solution of each penalty and its mean squared errors.

    Weights run from the oldest week to the last; the intercept isn't penalised. Without any window of a split its loss
    is NULL, and without training windows so are intercept and weights.
    """
    w = config.window
    both = split_sums(labelled, w).groupBy().agg(
        *[F.max(F.when(F.col("split") == s, F.col(c))).alias(f"{c}_{s}") for s in ("train", "val") for c in ("n", "m")]
    )
    n = F.col("n_train")
    means = both.withColumns({"means": F.transform(F.col("m_train")[0], lambda v: v / n)})
    covered = F.transform(
        F.sequence(F.lit(1), F.lit(w + 1)),
        lambda i: F.transform(F.sequence(F.lit(1), F.lit(w + 1)), lambda j: F.col("m_train")[i][j] / n - F.col("means")[i] * F.col("means")[j]),
    )
    path = means.withColumn("c", covered).select("*", F.explode(F.array(*[F.lit(float(x)) for x in penalties])).alias("penalty"))

    def line(row: Column, i: Column) -> Column:
        left = F.transform(F.slice(row, F.lit(2), F.lit(w)), lambda v, j: v + F.when(i == j, F.col("penalty")).otherwise(0.0))
        return F.concat(left, F.array(row[0]))

    solved = path.withColumn("back", solve(F.transform(F.slice("c", F.lit(2), F.lit(w)), line)))
    explained = dot(F.col("back"), F.slice("means", F.lit(3), F.lit(w)))
    solved = solved.withColumn("intercept", F.col("means")[1] - explained)
    missed = F.concat(F.array(-F.col("intercept"), F.lit(1.0)), F.transform("back", lambda v: -v))
    judged = solved.withColumn("v", missed)

    def loss(split: str) -> Column:
        return dot(F.col("v"), F.transform(f"m_{split}", lambda row: dot(row, F.col("v")))) / F.col(f"n_{split}")

    return judged.select("penalty", loss("train").alias("train_loss"), loss("val").alias("val_loss"), "intercept", F.reverse("back").alias("weights"))


def window_choose(
    labelled: DataFrame, config: WindowConfig = WindowConfig(), penalties: tuple[float, ...] = PENALTIES
) -> WindowModel:
    """The model of the path with the smallest validation loss, the stronger penalty on a tie.

    Without validation windows the configured penalty stands.
    """
    rows = window_path(labelled, config, tuple(dict.fromkeys((*penalties, config.reg_param)))).collect()
    if rows[0]["train_loss"] is None:
        raise ValueError(f"no series has a training window of {config.window} weeks and the week after it")
    if rows[0]["val_loss"] is None:
        best = next(r for r in rows if r["penalty"] == config.reg_param)
    else:
        best = min(rows, key=lambda r: (r["val_loss"], -r["penalty"]))
    return WindowModel(tuple(best["weights"]), best["intercept"], (), best["penalty"])


def window_fit(labelled: DataFrame, config: WindowConfig = WindowConfig(), solver: str = "normal") -> WindowModel:
    """Fits on the training rows of a split frame, scaled per series by training minimum and maximum.

    The normal solver takes the configured penalty from a path of one; ``l-bfgs`` iterates over the windows and yields a
    loss history.
    """
    if solver == "normal":
        return window_choose(labelled, config, ())
    scaled = scale_in_place(labelled.where(F.col("split") != "test"))
    samples = _samples(scaled, config)
    learner = LinearRegression(regParam=config.reg_param, maxIter=config.max_iter, solver=solver, standardization=False)
    model = learner.fit(samples)
    return WindowModel(
        tuple(float(w) for w in model.coefficients), float(model.intercept), tuple(model.summary.objectiveHistory), config.reg_param
    )


def window_losses(labelled: DataFrame, model: WindowModel) -> DataFrame:
    """Mean squared error of one-step predictions on training and validation windows."""
    scaled = scale_in_place(labelled.where(F.col("split") != "test"))

    def loss(windows: DataFrame, name: str) -> DataFrame:
        predicted = dot(F.col("inputs"), model.weight_array()) + F.lit(model.intercept)
        missed = predicted - F.col("target")
        return windows.agg(F.avg(missed * missed).alias("loss"), F.count(F.lit(1)).alias("n_windows")).select(
            F.lit(name).alias("split"), "loss", "n_windows"
        )

    train = loss(training_windows(scaled, "scaled", model.window), "train")
    return train.unionByName(loss(validation_windows(scaled, "scaled", model.window), "val"))


def window_fit_trees(
    labelled: DataFrame, config: WindowConfig = WindowConfig(), rounds: int = 20, seed: int = 42, tolerance: float = 0.01
) -> GBTRegressionModel:
    """Boosted trees on the same windows, for shapes a line cannot follow.

    Rounds stop when the error on the validation windows no longer falls by the share ``tolerance``, at ``rounds`` at
    the latest; without validation windows all rounds are taken.
    """
    scaled = scale_in_place(labelled.where(F.col("split") != "test"))
    learner = GBTRegressor(maxIter=rounds, maxDepth=4, seed=seed)
    held = validation_windows(scaled, "scaled", config.window).select(array_to_vector("inputs").alias("features"), F.col("target").alias("label"))
    samples = _samples(scaled, config)
    if held.isEmpty():
        return learner.fit(samples)
    marked = samples.withColumn("held", F.lit(False)).unionByName(held.withColumn("held", F.lit(True)))
    return learner.setValidationIndicatorCol("held").setParams(validationTol=tolerance).fit(marked)


def _seeds(history: DataFrame, scaler: DataFrame, size: int) -> DataFrame:
    """(series_id, last_week, data_min, span, values): the last ``size`` values of each series.

    A series that has fewer, or no scaler, keeps its row; all its values, and so its forecasts, are NULL.
    """
    seed = last_rows(history, size).groupBy("series_id").agg(
        F.max("week_start").alias("last_week"), ordered_values("week_start", "total_sales").alias("values")
    )
    span = F.when(F.col("data_max") == F.col("data_min"), F.lit(1.0)).otherwise(F.col("data_max") - F.col("data_min"))
    unknown = F.array_repeat(F.lit(None).cast("double"), size)
    return seed.join(scaler, "series_id", "left").select(
        "series_id",
        "last_week",
        "data_min",
        span.alias("span"),
        F.when(F.size("values") == size, F.col("values").cast("array<double>")).otherwise(unknown).alias("values"),
    )


def _dated(rows: DataFrame, model_type: str) -> DataFrame:
    """Forecast frame from rows with a scaled ``point`` and its zero-based step ``i``."""
    dated = rows.select(
        "series_id",
        (F.col("i") + 1).alias("horizon"),
        add_weeks(F.col("last_week"), F.col("i") + 1).alias("forecast_date"),
        (F.col("point") * F.col("span") + F.col("data_min")).alias("value"),
    )
    return forecast_frame(dated, model_type, F.col("value"))


def window_rows(model: WindowModel, scaler: DataFrame) -> DataFrame:
    """(series_id, coef, penalty, data_min, data_max): the model as a table, ``coef`` with the intercept first."""
    coef = F.concat(F.array(F.lit(model.intercept)), model.weight_array())
    return scaler.select("series_id", coef.alias("coef"), F.lit(model.penalty).alias("penalty"), "data_min", "data_max")


def _folded(ready: DataFrame, weights: Column, intercept: Column, size: int, steps: int) -> DataFrame:
    """Forecast frame of seeds (and whatever columns the weights need): predictions are fed back into the window."""
    scaled = F.transform("values", lambda v: (v - F.col("data_min")) / F.col("span"))

    def step(state: Column, _: Column) -> Column:
        latest = F.slice(state, F.size(state) - (size - 1), F.lit(size))
        return F.concat(state, F.array(dot(latest, weights) + intercept))

    folded = F.aggregate(F.sequence(F.lit(1), F.lit(steps)), scaled, step)
    rows = ready.select(
        "series_id", "last_week", "data_min", "span", F.slice(folded, size + 1, steps).alias("points")
    ).select("series_id", "last_week", "data_min", "span", F.posexplode("points").alias("i", "point"))
    return _dated(rows, MODEL)


def window_forecast(history: DataFrame, scaler: DataFrame, model: WindowModel, steps: int) -> DataFrame:
    """Feeds predictions back into the window. A series shorter than the window gets NULL forecasts."""
    ready = _seeds(history, scaler, model.window)
    return _folded(ready, model.weight_array(), F.lit(model.intercept), model.window, steps)


def window_forecast_rows(history: DataFrame, rows: DataFrame, steps: int, size: int = WindowConfig.window) -> DataFrame:
    """The same from a table of ``window_rows``, where each series may have weights of its own version.

    A series without a row, or with weights for another window, gets NULL forecasts.
    """
    ready = _seeds(history, rows.select("series_id", "data_min", "data_max"), size)
    fitting = rows.where(F.size("coef") == size + 1).select("series_id", "coef")
    joined = ready.join(fitting, "series_id", "left")
    return _folded(joined, F.slice("coef", 2, size), F.col("coef")[0], size, steps)


def window_forecast_trees(
    history: DataFrame, scaler: DataFrame, model: GBTRegressionModel, steps: int, size: int = WindowConfig.window
) -> DataFrame:
    """The same recursion with a tree ensemble: one scoring round per step over one row per series.

    Every few rounds a checkpoint cuts the plan.
    """
    scaled = F.transform("values", lambda v: (v - F.col("data_min")) / F.col("span"))
    seeds = _seeds(history, scaler, size).select("series_id", "last_week", "data_min", "span", scaled.alias("path"))
    known = F.col("path")[0].isNotNull()
    unknown = F.array_repeat(F.lit(None).cast("double"), size + steps)
    short = seeds.where(~known).withColumn("path", unknown)
    state = seeds.where(known)
    for step in range(steps):
        latest = F.slice("path", F.size("path") - (size - 1), F.lit(size))
        scored = model.transform(state.withColumn("features", array_to_vector(latest)))
        grown = F.concat("path", F.array("prediction")).alias("path")
        state = scored.select("series_id", "last_week", "data_min", "span", grown)
        if (step + 1) % _ROUNDS_PER_CUT == 0:
            state = checkpointed(state)
    rows = state.unionByName(short).select(
        "series_id", "last_week", "data_min", "span", F.posexplode(F.slice("path", size + 1, steps)).alias("i", "point")
    )
    return _dated(rows, TREE_MODEL)
