"""Array expressions used as fold state."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(left: Column, right: Column) -> Column:
    """Sum of the elementwise product of two arrays."""
    return F.aggregate(F.zip_with(left, right, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once, also inside a lambda where it is used repeatedly."""
    return F.transform(F.array(value), body)[0]


def ordered_values(order: str, value: str) -> Column:
    """Aggregate: values of a group as an array in ``order``. Use only on groups bounded by the calendar."""
    pairs = F.array_sort(F.collect_list(F.struct(F.col(order).alias("k"), F.col(value).cast("double").alias("v"))))
    return F.transform(pairs, lambda p: p["v"])


def solve(system: Column) -> Column:
    """Solution of a positive definite system, given as rows of coefficients that end in their right-hand side.

    Gauss-Jordan elimination as a fold over the pivots. The result is NULL for a NULL system, and has NULL elements
    where a pivot is zero.
    """

    def eliminate(rows: Column, j: Column) -> Column:
        def spread(pivot: Column) -> Column:
            def reduced(row: Column, i: Column) -> Column:
                return F.when(i == j, pivot).otherwise(F.zip_with(row, pivot, lambda a, p: a - row[j] * p))

            return F.transform(rows, reduced)

        return let(F.transform(rows[j], lambda v: v / F.nullif(rows[j][j], F.lit(0.0))), spread)

    pivots = F.sequence(F.lit(0), F.size(system) - 1)
    return F.transform(F.aggregate(pivots, system, eliminate), lambda row: F.element_at(row, -1))


def lag_products(x: Column, start: Column, rows: Column, lags: Column) -> Column:
    """Array of arrays: element [i][j] sums x[t - i] x[t - j] over ``rows`` positions t from ``start``, for i, j up to ``lags``.

    The first row is summed; each further one follows from the one before by what its two ends add and drop.
    """
    at_lag = lambda k: F.slice(x, start - k + 1, rows)
    steps = F.when(lags > 0, F.sequence(F.lit(1), lags)).otherwise(F.array().cast("array<int>"))

    def rest(first: Column) -> Column:
        def below(done: Column, i: Column) -> Column:
            back, last = start - i, start + rows - i
            ends = lambda v, j: v + x[back] * x[start - 1 - j] - x[last] * x[start + rows - 1 - j]
            moved = F.transform(F.slice(F.element_at(done, -1), F.lit(1), lags), ends)
            return F.concat(done, F.array(F.concat(F.array(first[i]), moved)))

        return F.aggregate(steps, F.array(first), below)

    return let(F.transform(F.sequence(F.lit(0), lags), lambda k: dot(at_lag(F.lit(0)), at_lag(k))), rest)


def total(values: Column) -> Column:
    """Sum of an array of doubles."""
    return F.aggregate(values, F.lit(0.0), lambda s, v: s + v)
