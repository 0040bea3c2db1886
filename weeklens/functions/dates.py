"""Week arithmetic. Weeks start on Monday and carry ISO labels."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def week_start(day: Column) -> Column:
    return F.trunc(day, "week")


def iso_week_id(day: Column) -> Column:
    """ISO label such as ``2011-W01``; the year is the ISO year."""
    iso_year = F.extract(F.lit("YEAROFWEEK"), day).cast("string")
    return F.concat(iso_year, F.lit("-W"), F.lpad(F.weekofyear(day).cast("string"), 2, "0"))


def add_weeks(day: Column, weeks: Column | int) -> Column:
    weeks = F.lit(weeks) if isinstance(weeks, int) else weeks
    return F.date_add(day, (weeks * 7).cast("int"))


def week_sequence(first: Column, last: Column) -> Column:
    return F.sequence(first, last, F.expr("interval 7 days"))


def cyclic(value: Column, period: float) -> tuple[Column, Column]:
    """Sine and cosine of a position on a cycle."""
    angle = F.lit(2 * math.pi) * value.cast("double") / F.lit(float(period))
    return F.sin(angle), F.cos(angle)
