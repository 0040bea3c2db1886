"""Parquet tables for forecasts, model coefficients and scaler parameters."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weeklens.functions.checks import require_columns
from weeklens.sources.batches import Batches
from weeklens.sources.files import path_exists

FORECAST_SCHEMA = T.StructType(
    [
        T.StructField("series_id", T.StringType()),
        T.StructField("forecast_date", T.DateType()),
        T.StructField("horizon", T.IntegerType()),
        T.StructField("predicted_value", T.DoubleType()),
        T.StructField("lower_bound", T.DoubleType()),
        T.StructField("upper_bound", T.DoubleType()),
        T.StructField("model_type", T.StringType()),
        T.StructField("model_version", T.StringType()),
        T.StructField("generated_at", T.TimestampType()),
    ]
)
REQUIRED_ON_WRITE = ("series_id", "forecast_date", "horizon", "predicted_value", "model_type", "model_version")

PARAMS_SCHEMA = T.StructType(
    [
        T.StructField("series_id", T.StringType()),
        T.StructField("model_type", T.StringType()),
        T.StructField("version", T.StringType()),
        T.StructField("generated_at", T.TimestampType()),
        T.StructField("coef", T.ArrayType(T.DoubleType())),
        T.StructField("sigma2", T.DoubleType()),
        # What else a model needs to be rebuilt; NULL where it needs nothing.
        T.StructField("numbers", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("texts", T.MapType(T.StringType(), T.StringType())),
        T.StructField("names", T.ArrayType(T.StringType())),
    ]
)
PARAMS_PAYLOAD = ("numbers", "texts", "names")


def to_forecast_rows(df: DataFrame, generated_at: Column | None = None) -> DataFrame:
    """Projects onto the store schema; optional columns that are absent are filled."""
    require_columns(df, REQUIRED_ON_WRITE, "forecast store")
    defaults = {
        "lower_bound": F.lit(None),
        "upper_bound": F.lit(None),
        "generated_at": F.current_timestamp() if generated_at is None else generated_at,
    }
    picked = []
    for f in FORECAST_SCHEMA.fields:
        source = F.col(f.name) if f.name in df.columns else defaults[f.name]
        picked.append(source.cast(f.dataType).alias(f.name))
    return df.select(*picked)


#: Most files that one append adds for a model.
FILES_A_MODEL = 16


_KEY = ("series_id", "model_type", "forecast_date")
_REST = ("horizon", "predicted_value", "lower_bound", "upper_bound")
_NEWEST = ("generated_at", "model_version", *_REST)


class ForecastTable:
    """Append-only forecast table, one folder per model type so a model filter reads only its files.

    Beside it stands the newest forecast of every series, model and week, renewed by each append: reading it costs what
    is forecast, not what was ever appended, and weeks of it are folders of their own.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path
        self.newest = Batches(f"{path}_newest", _KEY, order=_NEWEST, partition="week")

    def append(self, df: DataFrame, generated_at: Column | None = None) -> int:
        """Appends without deduplication and returns the number of rows, counted while they are written.

        The rows are written once, to the newest forecasts, and copied from there. An append that is cut off between the
        two is repeated as a whole; the newest forecasts are the same then.
        """
        counter = F.count(F.lit(1)).alias("rows")
        observation = Observation()
        rows = to_forecast_rows(df, generated_at).observe(observation, counter)
        # A few tasks hold all rows of a model, spread by series, so an append adds few files whatever its input had.
        spread = F.pmod(F.xxhash64("series_id"), F.lit(FILES_A_MODEL))
        number = self.newest.next_id(self.spark)
        week = F.trunc("forecast_date", "week").alias("week")
        self.newest.write(rows.repartition("model_type", spread).select("*", week), number)
        written = self.spark.read.schema(FORECAST_SCHEMA).parquet(f"{self.newest.path}/batch={number}")
        written.repartition("model_type", spread).write.mode("append").partitionBy("model_type").parquet(self.path)
        return int(observation.get["rows"])

    def latest(self, start_date: date | str | None = None, end_date: date | str | None = None) -> DataFrame:
        """``latest_forecasts`` of the table, both dates inclusive."""
        wanted = F.lit(True)
        for bound, after in ((start_date, True), (end_date, False)):
            if bound:
                day = F.lit(bound).cast("date")
                week = F.trunc(day, "week")
                inside = (F.col("week") >= week) & (F.col("forecast_date") >= day) if after else (F.col("week") <= week) & (F.col("forecast_date") <= day)
                wanted = wanted & inside
        if not path_exists(self.spark, self.path):
            return latest_forecasts(self.scan())
        return self.newest.read(self.spark, wanted).select(*_KEY, *_REST, "model_version", "generated_at")

    def scan(self) -> DataFrame:
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], FORECAST_SCHEMA)
        return self.spark.read.schema(FORECAST_SCHEMA).parquet(self.path).select(*FORECAST_SCHEMA.fieldNames())

    def read(
        self,
        series_id: str | None = None,
        model_type: str | None = None,
        model_version: str | None = None,
        start_date: date | str | None = None,
        end_date: date | str | None = None,
    ) -> DataFrame:
        """Rows matching every given filter, both dates inclusive; an empty filter means no filter."""
        df = self.scan()
        for column, wanted in (("series_id", series_id), ("model_type", model_type), ("model_version", model_version)):
            if wanted:
                df = df.where(F.col(column) == wanted)
        if start_date:
            df = df.where(F.col("forecast_date") >= F.lit(start_date).cast("date"))
        if end_date:
            df = df.where(F.col("forecast_date") <= F.lit(end_date).cast("date"))
        return df.orderBy("series_id", "model_type", "forecast_date")

    def export(self, path: str) -> None:
        self.scan().write.mode("overwrite").parquet(path)

    def import_from(self, path: str) -> int:
        return self.append(self.spark.read.parquet(path))

    def all_series(self) -> DataFrame:
        return self.scan().select("series_id").distinct()

    def latest_version(self) -> DataFrame:
        return latest_version(self.scan())


def latest_version(forecasts: DataFrame) -> DataFrame:
    """Newest model version per series and model; equal times resolve to the greater version."""
    newest = F.max(F.struct("generated_at", "model_version"))
    return (
        forecasts.groupBy("series_id", "model_type")
        .agg(newest.alias("newest"))
        .select("series_id", "model_type", F.col("newest.model_version").alias("model_version"))
    )


def latest_forecasts(forecasts: DataFrame) -> DataFrame:
    """One row per series, model and date: the one generated last (appends may repeat a forecast)."""
    newest = F.max(F.struct(*_NEWEST))
    return (
        forecasts.groupBy(*_KEY)
        .agg(newest.alias("newest"))
        .select(*_KEY, *[F.col(f"newest.{c}").alias(c) for c in [*_REST, "model_version", "generated_at"]])
    )


def write_params(params: DataFrame, path: str) -> None:
    """Appends fitted coefficients; payload columns that are absent are filled with NULL."""
    require_columns(params, [c for c in PARAMS_SCHEMA.fieldNames() if c not in PARAMS_PAYLOAD], "model parameters")
    there = lambda name: F.col(name) if name in params.columns else F.lit(None)
    picked = [there(f.name).cast(f.dataType).alias(f.name) for f in PARAMS_SCHEMA.fields]
    params.select(*picked).write.mode("append").partitionBy("model_type").parquet(path)


def read_params(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PARAMS_SCHEMA).parquet(path).select(*PARAMS_SCHEMA.fieldNames())


def read_params_or_none(spark: SparkSession, path: str, version: str) -> DataFrame | None:
    """The parameters of a version, or nothing where the table hasn't got it."""
    if not path_exists(spark, path):
        return None
    rows = read_params(spark, path).where(F.col("version") == version)
    return None if rows.isEmpty() else rows


def latest_params(params: DataFrame) -> DataFrame:
    """Parameters of the newest version per series and model, chosen by time and not by name."""
    rest = [c for c in PARAMS_SCHEMA.fieldNames() if c not in ("series_id", "model_type")]
    newest = F.max_by(F.struct(*rest), F.struct("generated_at", "version"))
    return params.groupBy("series_id", "model_type").agg(newest.alias("p")).select("series_id", "model_type", *[f"p.{c}" for c in rest])


def require_params(
    wanted: DataFrame, params: DataFrame, keys: tuple[str, ...] = ("series_id",), what: str = ""
) -> None:
    """Forecasting a series that was never fitted is an error that tells how many there are and names the first."""
    missing = missing_params(wanted, params, keys)
    found = missing.agg(F.count(F.lit(1)).alias("n"), F.min(F.concat_ws("/", *keys)).alias("first")).first()
    if found["n"]:
        raise RuntimeError(f"{what} not fitted: {found['first']}".lstrip() + (f" and {found['n'] - 1} more" if found["n"] > 1 else ""))


def missing_params(wanted: DataFrame, params: DataFrame, keys: tuple[str, ...] = ("series_id",)) -> DataFrame:
    """All keys of ``wanted`` without parameters."""
    return wanted.select(*keys).distinct().join(params.select(*keys), list(keys), "left_anti")
