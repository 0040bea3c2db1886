import datetime as dt
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from weeklens.config import spark_session  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"
MONDAY = dt.date(2010, 1, 4)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = spark_session(
        "tests",
        master="local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "6g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.python.sql.dataFrameDebugging.enabled": "false",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session


def week(i: int) -> dt.date:
    return MONDAY + dt.timedelta(weeks=i)


@pytest.fixture(scope="session")
def make_weekly(spark):
    """Weekly frame from {series_id: values}; None skips the week."""

    def build(series: dict):
        rows = [
            (sid, sid.split("__")[0], sid.split("__")[-1], week(i), float(v))
            for sid, values in series.items()
            for i, v in enumerate(values)
            if v is not None
        ]
        return spark.createDataFrame(
            rows, "series_id string, store_id string, cat_id string, week_start date, total_sales double"
        )

    return build


def values(df, *columns, order=("series_id", "week_start")):
    rows = df.orderBy(*[c for c in order if c in df.columns]).collect()
    return [tuple(r[c] for c in columns) if len(columns) > 1 else r[columns[0]] for r in rows]
