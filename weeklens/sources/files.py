"""CSV inputs: wide daily sales, calendar, sell prices; Parquet read-through cache; CSV results sink."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weeklens.functions.checks import require_columns
from weeklens.sources.calendar import calendar_from_days

WIDE_ID_COLUMNS = ("id", "item_id", "dept_id", "cat_id", "store_id", "state_id")
DAY_PREFIX = "d_"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists: one call to its file system, whatever lies below."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def require_sources(spark: SparkSession, paths: Iterable[str]) -> None:
    """One error that names every missing path."""
    missing = [p for p in paths if not path_exists(spark, p)]
    if missing:
        raise FileNotFoundError("no such input: " + ", ".join(missing))


def csv_header(spark: SparkSession, path: str) -> list[str]:
    return spark.read.option("header", True).csv(path).columns


def read_wide_sales(spark: SparkSession, path: str) -> DataFrame:
    """Wide daily sales: id columns as strings, every ``d_`` column as int; types come from the header, not a scan."""
    header = csv_header(spark, path)
    fields = [T.StructField(c, T.IntegerType() if c.startswith(DAY_PREFIX) else T.StringType()) for c in header]
    return require_columns(
        spark.read.option("header", True).schema(T.StructType(fields)).csv(path), WIDE_ID_COLUMNS, "wide sales"
    )


def read_calendar(spark: SparkSession, path: str, snap_columns: Iterable[str]) -> DataFrame:
    snap_columns = list(snap_columns)
    header = csv_header(spark, path)
    types = {c: T.IntegerType() for c in snap_columns} | {"date": T.DateType()}
    fields = [T.StructField(c, types.get(c, T.StringType())) for c in header]
    raw = spark.read.option("header", True).schema(T.StructType(fields)).csv(path)
    require_columns(raw, ["d", "date", "event_name_1", *snap_columns], "calendar")
    return calendar_from_days(raw, snap_columns)


def read_sell_prices(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Sell prices, passed through as they are."""
    reader = spark.read.option("header", True)
    return (reader.schema(schema) if schema else reader.option("inferSchema", True)).csv(path)


def read_through(
    spark: SparkSession, path: str, compute: Callable[[], DataFrame], force_reload: bool = False
) -> DataFrame:
    """Parquet cache: read ``path`` when it holds a finished write, else compute, write and read back."""
    if force_reload or not path_exists(spark, f"{path}/_SUCCESS"):
        compute().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def read_dashboard_tables(spark: SparkSession, weekly_path: str, calendar_path: str) -> tuple[DataFrame, DataFrame]:
    """Cached weekly sales and calendar with their date columns as dates."""
    require_sources(spark, [weekly_path, calendar_path])
    weekly = as_date(spark.read.parquet(weekly_path), "week_start")
    calendar = as_date(as_date(spark.read.parquet(calendar_path), "date"), "week_start")
    return weekly, calendar


def as_date(df: DataFrame, column: str) -> DataFrame:
    """Turns a column into a date unless it already is one."""
    if isinstance(df.schema[column].dataType, T.DateType):
        return df
    return df.withColumn(column, F.to_date(column))


def write_results_csv(results: DataFrame, path: str) -> None:
    results.write.mode("overwrite").option("header", True).csv(path)
