import pytest
from conftest import values
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from weeklens.operators import split


def counts(df):
    return {r.split: r["count"] for r in df.groupBy("split").count().collect()}


def test_split_of_100_weeks(make_weekly):
    labelled = split.temporal_split(make_weekly({"A__x": range(100)}))
    assert counts(labelled) == {"train": 77, "val": 10, "test": 13}
    bounds = {r.split: (r.a, r.b) for r in labelled.groupBy("split").agg(F.min("week_start").alias("a"), F.max("week_start").alias("b")).collect()}
    assert bounds["train"][1] < bounds["val"][0] and bounds["val"][1] < bounds["test"][0]


def test_series_split_independently(make_weekly):
    labelled = split.temporal_split(make_weekly({"A__x": range(100), "B__y": range(40)}))
    rows = {r.series_id: (r.n_train, r.n_val, r.n_test) for r in split.split_sizes(labelled).collect()}
    assert rows == {"A__x": (77, 10, 13), "B__y": (23, 4, 13)}


def test_short_series_do_not_overlap(make_weekly):
    labelled = split.temporal_split(make_weekly({"A__x": range(10), "B__y": range(14)}))
    assert counts(labelled.where("series_id = 'A__x'")) == {"test": 10}
    assert labelled.where("too_short").select("series_id").distinct().first()[0] == "A__x"
    assert counts(labelled.where("series_id = 'B__y'")) == {"val": 1, "test": 13}


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [("A", i, float(v), "train" if i < 4 else "val") for i, v in enumerate([10.0, 20, 30, 40, 5, 50])]
    return spark.createDataFrame(rows, "series_id string, i int, total_sales double, split string").selectExpr(
        "series_id", "date_add(date'2010-01-04', i * 7) AS week_start", "total_sales", "split"
    )


def test_scaler_uses_train_only(labelled):
    params = split.scaler_params(labelled)
    scaled = split.scale(labelled, params)
    got = values(scaled, "scaled")
    assert got[0] == 0 and got[3] == 1 and got[4] < 0 and got[5] > 1
    assert values(split.scale_in_place(labelled), "scaled") == got
    assert values(split.unscale(scaled, params), "restored") == pytest.approx([10, 20, 30, 40, 5, 50])


def test_scaler_range_and_constant_series(spark, labelled):
    params = split.scaler_params(labelled)
    scaled = split.scale(labelled, params, feature_range=(-1.0, 1.0))
    assert values(scaled, "scaled")[0] == -1
    assert values(split.unscale(scaled, params, feature_range=(-1.0, 1.0)), "restored") == pytest.approx([10, 20, 30, 40, 5, 50])
    flat = labelled.withColumn("total_sales", F.lit(3.0))
    assert set(values(split.scale(flat, split.scaler_params(flat)), "scaled")) == {0.0}


def test_unfitted_series_is_an_error(labelled):
    params = split.scaler_params(labelled)
    with pytest.raises(PySparkException, match="no scaler fitted for series Z"):
        split.scale(labelled.withColumn("series_id", F.lit("Z")), params).collect()


def test_windows(make_weekly):
    df = make_weekly({"A__x": range(100)})
    rows = values(split.sliding_windows(df, "total_sales"), "inputs", "target")
    assert len(rows) == 48
    assert rows[0][0] == [float(i) for i in range(52)] and rows[0][1] == 52.0


def test_validation_windows_reach_into_train(make_weekly):
    labelled = split.temporal_split(make_weekly({"A__x": range(100)}))
    rows = values(split.validation_windows(labelled), "inputs", "target")
    assert [t for _, t in rows] == [float(i) for i in range(77, 87)]
    assert rows[0][0] == [float(i) for i in range(25, 77)]
