"""Daily sales to weekly series: melt, calendar join, aggregation, densifying, series selection."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from weeklens.functions.dates import week_sequence
from weeklens.sources.calendar import flag_columns, week_flags
from weeklens.sources.files import DAY_PREFIX, WIDE_ID_COLUMNS


def series_window() -> WindowSpec:
    """Rows of one series in week order."""
    return Window.partitionBy("series_id").orderBy("week_start")


def series_key(store: str = "store_id", category: str = "cat_id") -> Column:
    return F.concat_ws("__", store, category)


def state_of(store_or_series: str) -> Column:
    """Text before the first underscore."""
    return F.split_part(F.col(store_or_series), F.lit("_"), F.lit(1))


def melt_wide(wide: DataFrame, id_columns: Iterable[str] = WIDE_ID_COLUMNS) -> DataFrame:
    """One row per id and day column. The names travel as one literal array, so gaps in the numbering are fine."""
    days = [c for c in wide.columns if c.startswith(DAY_PREFIX)]
    names = F.split(F.lit(",".join(days)), ",")
    cells = F.expr("array(" + ", ".join(f"CAST({c} AS INT)" for c in days) + ")")
    ids = list(id_columns)
    return wide.select(*ids, F.posexplode(cells).alias("pos", "sales")).select(
        *ids, F.element_at(names, F.col("pos") + 1).alias("d"), "sales"
    )


def join_calendar(sales: DataFrame, calendar: DataFrame, day_key: str = "d") -> DataFrame:
    """Left join of daily sales to the calendar columns the weekly step needs."""
    picked = dict.fromkeys([day_key, "date", "week_id", "week_start", *flag_columns(calendar)])
    return sales.join(calendar.select(*picked), day_key, "left")


def weekly_sales(sales: DataFrame, calendar: DataFrame, day_key: str = "d") -> DataFrame:
    """Weekly units per store and category, with the maximum of each calendar flag over the days sold.

    Sales are summed per day before the calendar join: the flags depend on the day alone, so the
    result is the same and only (store, category, day) totals, combined map-side, reach an exchange
    - a key with most of the rows costs one partial row per task and day.
    """
    daily = (
        sales.where(F.col("store_id").isNotNull() & F.col("cat_id").isNotNull())
        .groupBy("store_id", "cat_id", day_key)
        .agg(F.sum("sales").alias("sales"))
    )
    flags = flag_columns(calendar)
    joined = join_calendar(daily, calendar, day_key)
    return (
        joined.where(F.col("week_id").isNotNull())
        .groupBy("store_id", "cat_id", "week_id", "week_start")
        .agg(F.sum("sales").alias("total_sales"), *[F.max(c).alias(c) for c in flags])
        .select(series_key().alias("series_id"), "store_id", "cat_id", "week_id", "week_start", "total_sales", *flags)
    )


def partial_weeks_dropped(weekly: DataFrame, calendar: DataFrame) -> DataFrame:
    """Without the weeks of which the calendar holds fewer than seven days."""
    whole = calendar.groupBy("week_start").agg(F.count(F.lit(1)).alias("days")).where("days = 7")
    return weekly.join(whole.select("week_start"), "week_start", "left_semi")


def fill_gaps(weekly: DataFrame, first_week: Column, last_week: Column) -> DataFrame:
    """Every series gets every week from first to last; absent weeks have zero sales.

    Each observed row emits itself and the empty weeks up to its successor (the first row also those
    before it). That needs one exchange by series, which later per-series windows reuse, and no join
    against a series x weeks grid.
    """
    before_next = F.date_sub(F.lead("week_start").over(series_window()), 7)
    is_first = F.lag("week_start").over(series_window()).isNull()
    bounded = weekly.select(
        "series_id",
        "store_id",
        "cat_id",
        F.col("week_start").alias("observed"),
        "total_sales",
        F.when(is_first, F.least(first_week, F.col("week_start"))).otherwise(F.col("week_start")).alias("from_week"),
        F.coalesce(before_next, F.greatest(last_week, F.col("week_start"))).alias("to_week"),
    )
    return bounded.select(
        "series_id",
        "store_id",
        "cat_id",
        F.explode(week_sequence(F.col("from_week"), F.col("to_week"))).alias("week_start"),
        "observed",
        "total_sales",
    ).select(
        "series_id",
        "store_id",
        "cat_id",
        "week_start",
        F.when(F.col("week_start") == F.col("observed"), F.col("total_sales")).otherwise(F.lit(0)).alias("total_sales"),
    )


def week_bounds(calendar: DataFrame) -> tuple[Column, Column]:
    """First and last calendar week, both from one scalar subquery."""
    bounds = calendar.select(
        F.struct(F.min("week_start").alias("first_week"), F.max("week_start").alias("last_week")).alias("bounds")
    ).scalar()
    return bounds["first_week"], bounds["last_week"]


def dense_series(weekly: DataFrame, calendar: DataFrame) -> DataFrame:
    """Dense (series_id, store_id, cat_id, week_start, total_sales) over the calendar's span."""
    return fill_gaps(weekly, *week_bounds(calendar))


def dense_weekly(weekly: DataFrame, calendar: DataFrame) -> DataFrame:
    """Dense weekly sales with every flag of the week, as if each series had a row for every day."""
    weeks = week_flags(calendar)
    return (
        dense_series(weekly, calendar)
        .join(weeks, "week_start")
        .select(
            "series_id", "store_id", "cat_id", "week_id", "week_start", "total_sales", *flag_columns(calendar)
        )
    )


def snap_flag(states: dict[str, str], store: str = "store_id") -> Column:
    """The benefit flag of the store's own state; 0 for a state without one."""
    state = state_of(store)
    chosen = F.lit(0)
    for code, column in states.items():
        chosen = F.when(state == code, F.col(column)).otherwise(chosen)
    return chosen.cast("tinyint")


def _in_series(df: DataFrame, wanted: Iterable[str]) -> Column:
    """Rows of the wanted series. Where store and category are columns they are compared too: unlike the joined key,
    these filters move below joins and aggregates and down to the scans."""
    wanted = list(wanted)
    keep = F.col("series_id").isin(wanted)
    if {"store_id", "cat_id"} <= set(df.columns):
        stores, categories = ({w.split("__", 1)[i] for w in wanted if "__" in w} for i in (0, 1))
        keep = keep & F.col("store_id").isin(sorted(stores)) & F.col("cat_id").isin(sorted(categories))
    return keep


def restrict_series(weekly: DataFrame, wanted: Iterable[str] | None = None, first_n: int | None = None) -> DataFrame:
    """Keeps the requested series, then the first ``first_n`` ids in order."""
    if wanted:
        weekly = weekly.where(_in_series(weekly, wanted))
    if first_n:
        ids = weekly.select("series_id").distinct().orderBy("series_id").limit(first_n)
        weekly = weekly.join(ids, "series_id", "left_semi")
    return weekly


def one_series(df: DataFrame, series_id: str, order: str = "week_start") -> DataFrame:
    return df.where(_in_series(df, [series_id])).orderBy(order)


def series_ids(df: DataFrame) -> DataFrame:
    return df.select("series_id").distinct()


def series_count(df: DataFrame) -> DataFrame:
    return df.agg(F.countDistinct("series_id").alias("n_series"))


def last_rows(df: DataFrame, k: int, keys: Iterable[str] = ("series_id",), order: str = "week_start") -> DataFrame:
    """Last ``k`` rows per key."""
    newest_first = Window.partitionBy(*keys).orderBy(F.col(order).desc())
    return df.withColumn("_rank", F.row_number().over(newest_first)).where(F.col("_rank") <= k).drop("_rank")
