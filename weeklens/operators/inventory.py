"""Order quantities and inventory cost from forecast error (newsvendor model)."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weeklens.functions.numeric import clip_zero, normal_density, normal_quantile, z_value


def newsvendor(
    metrics: DataFrame, stockout_cost: float | Column = 8.0, holding_cost: float | Column = 2.0
) -> DataFrame:
    """Adds critical ratio, sigma, order quantity and expected weekly cost to rows with MAE and mean_demand.

    Costs may be numbers, then the quantile is taken at plan time, or columns. ``expected_cost`` weighs
    the stock-out part by 1 - critical ratio; ``expected_cost_textbook`` is (h + b) sigma phi(z).
    """
    if isinstance(stockout_cost, Column) or isinstance(holding_cost, Column):
        b = stockout_cost if isinstance(stockout_cost, Column) else F.lit(float(stockout_cost))
        h = holding_cost if isinstance(holding_cost, Column) else F.lit(float(holding_cost))
        share = b / (b + h)
        quantile = normal_quantile(F.col("critical_ratio"))
    else:
        ratio = stockout_cost / (stockout_cost + holding_cost)
        b, h, share = F.lit(float(stockout_cost)), F.lit(float(holding_cost)), F.lit(ratio)
        quantile = F.lit(z_value(ratio))
    sigma = F.col("MAE") * F.lit(math.sqrt(math.pi / 2))
    # One projection per step: each expensive value is computed once and then only referenced.
    prepared = metrics.select("*", share.alias("critical_ratio"), sigma.alias("sigma"))
    scored = prepared.select("*", quantile.alias("z")).select("*", normal_density(F.col("z")).alias("density"))
    z, s, density = F.col("z"), F.col("sigma"), F.col("density")
    return scored.select(
        *prepared.columns,
        clip_zero(F.col("mean_demand") + z * s).alias("order_quantity"),
        (h * s * density + b * s * (1.0 - F.col("critical_ratio")) * density).alias("expected_cost"),
        ((h + b) * s * density).alias("expected_cost_textbook"),
    )


def cost_spread(costs: DataFrame, cost: str = "expected_cost") -> DataFrame:
    """Saving of each model against the dearest one of its series."""
    worst = F.max(cost).over(Window.partitionBy("series_id"))
    return costs.select("series_id", "model", cost, (worst - F.col(cost)).alias("savings_vs_worst"))


def cheapest_and_dearest(costs: DataFrame, cost: str = "expected_cost") -> DataFrame:
    """Best and worst model per series and the difference; equal costs resolve by name."""
    by_cost = F.struct(F.col(cost), F.col("model"))
    return costs.groupBy("series_id").agg(
        F.min(by_cost)["model"].alias("best_model"),
        F.max(by_cost)["model"].alias("worst_model"),
        (F.max(cost) - F.min(cost)).alias("savings"),
    )
