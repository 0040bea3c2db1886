import math
from statistics import NormalDist

import pytest
from pyspark.sql import functions as F

from weeklens.functions import dates, numeric
from weeklens.functions.arrays import dot, let


def test_normal_quantile_matches_library(spark):
    ps = [1e-12, 1e-6, 0.01, 0.05, 0.3, 0.5, 0.6, 0.8, 0.95, 0.999, 1 - 1e-9]
    rows = spark.createDataFrame([(p,) for p in ps], "p double").select("p", numeric.normal_quantile(F.col("p")).alias("z"))
    for p, z in rows.collect():
        assert z == pytest.approx(NormalDist().inv_cdf(p), rel=1e-12, abs=1e-12)


def test_normal_quantile_outside_is_null(spark):
    rows = spark.createDataFrame([(0.0,), (1.0,), (1.5,)], "p double").select(numeric.normal_quantile(F.col("p")).alias("z"))
    assert [r.z for r in rows.collect()] == [None, None, None]


@pytest.mark.parametrize("x,df,tail", [(18.307, 10, 0.05), (3.841459, 1, 0.05), (7.814728, 3, 0.05), (2.705543, 1, 0.1), (200.0, 10, 0.0)])
def test_chi_square_tail(spark, x, df, tail):
    got = spark.range(1).select(numeric.chi_square_tail(F.lit(x), df).alias("p")).first().p
    assert got == pytest.approx(tail, abs=2e-5)


def test_chi_square_odd_agrees_with_normal(spark):
    for z in (0.1, 1.0, 2.5, 5.0):
        got = spark.range(1).select(numeric.chi_square_tail(F.lit(z * z), 1).alias("p")).first().p
        assert got == pytest.approx(math.erfc(z / math.sqrt(2)), abs=1e-12)


def test_clip_keeps_null_and_ratio_guards_zero(spark):
    df = spark.createDataFrame([(-1.0, 0.0), (2.0, 4.0), (None, 1.0)], "a double, b double")
    rows = df.select(numeric.clip_zero(F.col("a")).alias("c"), numeric.ratio(F.col("a"), F.col("b")).alias("r")).collect()
    assert [(r.c, r.r) for r in rows] == [(0.0, None), (2.0, 0.5), (None, None)]


def test_week_functions(spark):
    df = spark.createDataFrame([("2011-01-02",), ("2011-01-03",), ("2020-12-31",), ("2021-01-03",)], "d string")
    day = F.to_date("d")
    rows = df.select(dates.iso_week_id(day).alias("id"), dates.week_start(day).cast("string").alias("w")).collect()
    assert [tuple(r) for r in rows] == [
        ("2010-W52", "2010-12-27"), ("2011-W01", "2011-01-03"), ("2020-W53", "2020-12-28"), ("2020-W53", "2020-12-28"),
    ]


def test_dot_and_let(spark):
    a = F.array(F.lit(1.0), F.lit(2.0))
    row = spark.range(1).select(dot(a, a).alias("d"), let(F.lit(3.0), lambda v: v * v).alias("l")).first()
    assert (row.d, row.l) == (5.0, 9.0)
