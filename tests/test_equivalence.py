"""Every registered query that SQL can express, against DuckDB on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest
from conftest import SF_DIR

import __spark_entry__ as entry_point

ORACLES = entry_point.oracle_sql()
NAMES = sorted(n for n in ORACLES if not n.startswith(("op", "pipeline")))


def canonical(df: pd.DataFrame) -> list:
    def cell(v):
        if v is None or v is pd.NaT or (isinstance(v, float) and v != v):
            return ""
        return str(v)[:10] if hasattr(v, "year") else repr(float(v)) if isinstance(v, float) else str(v)

    return sorted(map(tuple, df[sorted(df.columns)].map(cell).values.tolist()))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for file in os.listdir(SF_DIR):
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM '{SF_DIR}/{file}'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_same_rows(spark, duck, name):
    got = entry_point.queries()[name](spark, SF_DIR).toPandas()
    want = duck.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(entry_point.queries())


def test_entry(spark):
    assert entry_point.entry(spark).count() > 0
