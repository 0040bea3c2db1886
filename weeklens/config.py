"""Thresholds, model defaults and session settings."""

from __future__ import annotations

import os
import tempfile
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

# The alert limits, split sizes and periods every result depends on.
SEASON = 52
TEST_WEEKS = 13
VAL_FRACTION = 0.10
MASE_ALERT = 1.15
MASE_AMBER = 0.95
BIAS_SHARE = 0.10
BIAS_WEEKS = 3
PSI_ALERT = 0.20
PSI_BINS = 10
PSI_FLOOR = 1e-6
ROLLBACK_DEGRADATION = 0.05
HORIZONS = (4, 8, 13, 26)
EVENT_FLAGS = ("is_holiday", "is_thanksgiving", "is_black_friday")
# State code -> calendar column that carries its benefit days.
RETAIL_STATES = {"CA": "snap_CA", "TX": "snap_TX", "WI": "snap_WI"}


# Fixed values, like those above: the defaults of the three model configurations.
@dataclass(frozen=True)
class SeasonalArConfig:
    """Differenced seasonal autoregression: lags 1 and ``season`` of (1-B)(1-B^season)y."""

    season: int = SEASON
    alpha: float = 0.05


@dataclass(frozen=True)
class AdditiveConfig:
    """Piecewise-linear trend + yearly Fourier terms + holiday effects.

    Changes of the trend have a Laplace prior, so most of them are zero, or a normal one; all other terms a normal one.
    """

    changepoint_prior: str = "laplace"
    changepoints: int = 25
    changepoint_range: float = 0.8
    fourier_order: int = 10
    changepoint_prior_scale: float = 0.05
    seasonality_prior_scale: float = 10.0
    holidays_prior_scale: float = 10.0
    interval_width: float = 0.80


@dataclass(frozen=True)
class WindowConfig:
    """Linear learner on the last ``window`` scaled values, shared by all series."""

    window: int = SEASON
    reg_param: float = 1e-4
    max_iter: int = 50


@dataclass(frozen=True)
class ModelDefaults:
    sar: SeasonalArConfig = field(default_factory=SeasonalArConfig)
    additive: AdditiveConfig = field(default_factory=AdditiveConfig)
    window: WindowConfig = field(default_factory=WindowConfig)


def spark_session(app: str = "weeklens", master: str | None = None, **conf: str) -> SparkSession:
    """Session with adaptive execution and skew handling on; the cluster's own settings win elsewhere."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def _shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder, as the session names it.

    Where the session names none, a local master gets one of its own; elsewhere that is an error, since executors could
    not read one another's files.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None and context.getCheckpointDir() is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="weeklens-"))
    elif context.getCheckpointDir() is None:
        context.setCheckpointDir(configured)
    return configured or context.getCheckpointDir()


def work_path(spark: SparkSession, name: str) -> str:
    """Fresh path for a table in the shared folder."""
    return os.path.join(_shared_folder(spark), "weeklens", f"{name}-{uuid.uuid4().hex}")


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder."""
    _shared_folder(df.sparkSession)
    return df.checkpoint()
