import os

import pytest
from conftest import week
from pyspark.sql import functions as F

from weeklens.sources.batches import Batches
from weeklens.sources.store import ForecastTable, latest_forecasts


def batch(spark, i):
    """Batch i renews key i % 7 and adds a key of its own every fifth time."""
    keys = [f"k{i % 7}"] + ([f"own{i}"] if i % 5 == 0 else [])
    return spark.createDataFrame([(k, i, float(i) / 2) for k in keys], "key string, n int, total double")


def expected(upto):
    out = {}
    for i in range(upto):
        out[f"k{i % 7}"] = i
        if i % 5 == 0:
            out[f"own{i}"] = i
    return out


def got(frame):
    return {r["key"]: r["n"] for r in frame.collect()}


def test_a_read_after_50_batches_opens_few_files(spark, tmp_path):
    path = str(tmp_path / "sink")
    table = Batches(path, ["key"])
    with pytest.raises(FileNotFoundError):
        table.read(spark)
    for i in range(53):
        table.write(batch(spark, i).coalesce(1), i)
        if i in (0, 8, 9, 10, 30, 52):
            assert got(table.read(spark)) == expected(i + 1), i
    read = table.read(spark)
    assert read.columns == ["key", "n", "total"]
    assert len(set(read.inputFiles())) <= 2 * 4 + 3
    folders = sorted(f for f in os.listdir(path) if "=" in f)
    assert [f for f in folders if f.startswith("base")] == ["base=39", "base=49"]
    assert all(int(f.split("=")[1]) > 39 for f in folders if f.startswith("batch"))


def test_repeated_batches_and_unfinished_bases(spark, tmp_path):
    path = str(tmp_path / "sink")
    table = Batches(path, ["key"], every=3)
    for i in (0, 1, 2, 2, 3, 3, 4):
        table.write(batch(spark, i), i)
    assert got(table.read(spark)) == expected(5)
    # A base whose write was cut off doesn't count; the batch is run again.
    table.write(batch(spark, 5), 5)
    os.remove(f"{path}/base=5/_SUCCESS")
    assert got(table.read(spark)) == expected(6)
    table.write(batch(spark, 5), 5)
    assert got(table.read(spark)) == expected(6)
    assert spark.read.parquet(f"{path}/base=5").agg(F.max("batch")).first()[0] == 5


def test_newest_forecasts_follow_the_appends(spark, tmp_path):
    """The kept view equals the newest rows of all appends, whatever their order in time, and reads the weeks asked for."""
    table = ForecastTable(spark, str(tmp_path / "forecasts"))
    table.newest.every = 3
    assert table.latest().count() == 0
    for i in range(8):
        stamp = F.lit(f"2020-01-{20 - i if i % 3 == 2 else 2 + i:02d}").cast("timestamp")
        rows = [(f"s{k}", "sar" if k % 2 else "additive", f"v{i}", week(i + h), h, float(10 * i + h)) for k in range(4) for h in range(1, 5) if (k + i) % 3]
        df = spark.createDataFrame(rows, "series_id string, model_type string, model_version string, forecast_date date, horizon int, predicted_value double")
        assert table.append(df, stamp) == len(rows)
        want = latest_forecasts(table.scan())
        assert sorted(map(str, table.latest().select(*want.columns).collect())) == sorted(map(str, want.collect())), i
    some = table.latest(week(3), week(5))
    inside = latest_forecasts(table.scan()).where(F.col("forecast_date").between(F.lit(week(3)), F.lit(week(5))))
    assert sorted(map(str, some.select(*inside.columns).collect())) == sorted(map(str, inside.collect()))
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(week" in plan
