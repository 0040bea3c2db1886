"""Calendar preparation: event flags and week columns from one row per day."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weeklens.config import EVENT_FLAGS
from weeklens.functions.dates import iso_week_id, week_start


def _event_contains(text: str) -> Column:
    hit = F.lower("event_name_1").contains(text)
    return F.coalesce(hit, F.lit(False)).cast("tinyint")


def calendar_from_days(days: DataFrame, snap_columns: Iterable[str]) -> DataFrame:
    """Adds is_holiday, is_thanksgiving, is_black_friday, week_id, week_start; flags become tinyint."""
    day = F.to_date("date")
    return days.select(
        "d",
        day.alias("date"),
        "event_name_1",
        *([F.col("event_type_1")] if "event_type_1" in days.columns else []),
        *[F.col(c).cast("tinyint").alias(c) for c in snap_columns],
        F.col("event_name_1").isNotNull().cast("tinyint").alias("is_holiday"),
        _event_contains("thanksgiving").alias("is_thanksgiving"),
        _event_contains("blackfriday").alias("is_black_friday"),
        iso_week_id(day).alias("week_id"),
        week_start(day).alias("week_start"),
    )


def flag_columns(calendar: DataFrame) -> list[str]:
    """Benefit-day columns of a prepared calendar, then the event flags."""
    return [c for c in calendar.columns if c.startswith("snap_")] + list(EVENT_FLAGS)


def week_flags(calendar: DataFrame) -> DataFrame:
    """One row per week: label and the maximum of every daily flag."""
    flags = flag_columns(calendar)
    return calendar.groupBy("week_start", "week_id").agg(*[F.max(c).alias(c) for c in flags])


def event_weeks(calendar: DataFrame) -> DataFrame:
    """First named event of every week that has one, in calendar order."""
    return (
        calendar.where((F.col("is_holiday") == 1) & F.col("event_name_1").isNotNull())
        .groupBy("week_start")
        .agg(F.min_by("event_name_1", "date").alias("event_name"))
    )


def holiday_table(calendar: DataFrame, states: dict[str, str]) -> DataFrame:
    """Holiday rows (state, ds, holiday): every named event for every state plus the state's benefit days."""
    state_list = F.array(*[F.lit(s) for s in sorted(states)])
    events = calendar.where(F.col("event_name_1").isNotNull()).select(
        F.explode(state_list).alias("state"), F.col("date").alias("ds"), F.col("event_name_1").alias("holiday")
    )
    flagged = [
        F.when(F.col(column) == 1, F.struct(F.lit(state).alias("state"), F.lit(f"SNAP_{state}").alias("holiday")))
        for state, column in states.items()
    ]
    snap = calendar.select(F.col("date").alias("ds"), F.explode(F.array_compact(F.array(*flagged))).alias("s")).select(
        "s.state", "ds", "s.holiday"
    )
    return events.unionByName(snap).dropDuplicates(["state", "ds", "holiday"])
