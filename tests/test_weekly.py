import datetime as dt

import pytest
from conftest import values, week
from pyspark.sql import functions as F

from weeklens.config import RETAIL_STATES
from weeklens.operators import features, weekly
from weeklens.sources import files
from weeklens.sources.calendar import calendar_from_days, event_weeks, holiday_table, week_flags

SNAPS = list(RETAIL_STATES.values())


def raw_calendar(spark, days=21, events=None):
    events = events or {}
    start = dt.date(2011, 11, 21)
    rows = []
    for i in range(days):
        day = start + dt.timedelta(days=i)
        rows.append((f"d_{i + 1}", day, events.get(i), int(i == 0), int(i == 8), 0))
    return spark.createDataFrame(rows, "d string, date date, event_name_1 string, snap_CA int, snap_TX int, snap_WI int")


@pytest.fixture(scope="module")
def calendar(spark):
    return calendar_from_days(raw_calendar(spark, events={3: "Thanksgiving", 4: "BlackFriday", 15: "Local"}), SNAPS)


@pytest.fixture(scope="module")
def wide(spark):
    days = ", ".join(f"d_{i} int" for i in range(1, 22))
    ids = "id string, item_id string, dept_id string, cat_id string, store_id string, state_id string"
    rows = [
        (f"x{k}", f"i{k}", "F_1", "FOODS", store, store[:2], *[k + i for i in range(21)])
        for k, store in enumerate(["CA_1", "CA_1", "TX_2"])
    ]
    return spark.createDataFrame(rows, f"{ids}, {days}")


def test_calendar_flags(calendar):
    rows = {r.d: r for r in calendar.collect()}
    assert (rows["d_4"].is_holiday, rows["d_4"].is_thanksgiving, rows["d_4"].is_black_friday) == (1, 1, 0)
    assert (rows["d_5"].is_thanksgiving, rows["d_5"].is_black_friday) == (0, 1)
    assert (rows["d_1"].is_holiday, rows["d_1"].is_thanksgiving) == (0, 0)
    assert rows["d_7"].week_start == dt.date(2011, 11, 21) and rows["d_8"].week_id == "2011-W48"


def test_melt_gives_one_row_per_cell(wide):
    melted = weekly.melt_wide(wide)
    assert melted.count() == 63
    assert dict(melted.dtypes)["sales"] == "int"
    assert melted.where("id = 'x2' and d = 'd_21'").first().sales == 22


def test_melt_with_gap_in_day_numbers(wide):
    melted = weekly.melt_wide(wide.drop("d_2"))
    assert sorted(r.d for r in melted.where("id = 'x0'").collect())[:3] == ["d_1", "d_10", "d_11"]
    assert melted.where("id = 'x0' and d = 'd_3'").first().sales == 2


def test_weekly_sums_and_flags(wide, calendar):
    rows = {(r.series_id, r.week_start): r for r in weekly.weekly_sales(weekly.melt_wide(wide), calendar).collect()}
    first = rows["CA_1__FOODS", dt.date(2011, 11, 21)]
    assert first.total_sales == sum(range(7)) * 2 + 7
    assert (first.snap_CA, first.snap_TX, first.is_holiday, first.is_black_friday) == (1, 0, 1, 1)
    assert rows["TX_2__FOODS", dt.date(2011, 11, 28)].snap_TX == 1
    assert len(rows) == 6


def test_unmatched_days_vanish(spark, wide, calendar):
    shorter = calendar.where("d <> 'd_1'")
    total = weekly.weekly_sales(weekly.melt_wide(wide), shorter).agg(F.sum("total_sales")).first()[0]
    assert total == sum(k + i for k in range(3) for i in range(1, 21))


def test_one_hot_store_gives_same_result(spark, calendar):
    """A single store and day with most of the rows."""
    rows = spark.range(20000).select(
        F.lit("CA_1").alias("store_id"),
        F.when(F.col("id") % 3 == 0, "A").otherwise("B").alias("cat_id"),
        F.when(F.col("id") < 15000, "d_1").otherwise(F.concat(F.lit("d_"), (F.col("id") % 21 + 1).cast("string"))).alias("d"),
        F.lit(1).alias("sales"),
    )
    out = weekly.weekly_sales(rows, calendar)
    assert out.agg(F.sum("total_sales")).first()[0] == 20000


def test_fill_gaps(spark, make_weekly):
    df = make_weekly({"A__x": [None, 5, None, None, 7, None], "B__y": [1, 2, 3, 4, 5, 6]})
    dense = weekly.fill_gaps(df, F.lit(week(0)), F.lit(week(5)))
    assert values(dense.where("series_id = 'A__x'"), "total_sales") == [0, 5, 0, 0, 7, 0]
    assert values(dense.where("series_id = 'B__y'"), "total_sales") == [1, 2, 3, 4, 5, 6]
    assert dense.count() == 12


def test_partial_weeks(spark, make_weekly):
    short = calendar_from_days(raw_calendar(spark, days=17), SNAPS)
    df = make_weekly({"A__x": [1]}).withColumn("week_start", F.explode(F.array(*[
        F.lit(dt.date(2011, 11, 21) + dt.timedelta(weeks=i)) for i in range(3)])))
    assert weekly.partial_weeks_dropped(df, short).count() == 2


def test_series_selection(make_weekly):
    df = make_weekly({f"S{i}__x": [1, 2] for i in range(5)})
    assert weekly.series_count(df).first().n_series == 5
    assert weekly.restrict_series(df, ["S1__x", "S3__x"]).count() == 4
    assert sorted({r.series_id for r in weekly.restrict_series(df, first_n=2).collect()}) == ["S0__x", "S1__x"]
    assert weekly.one_series(df, "S4__x").count() == 2


def test_event_weeks_take_the_first_event(calendar):
    rows = {r.week_start: r.event_name for r in event_weeks(calendar).collect()}
    assert rows == {dt.date(2011, 11, 21): "Thanksgiving", dt.date(2011, 12, 5): "Local"}


def test_holiday_table(calendar):
    table = holiday_table(calendar, RETAIL_STATES)
    assert table.where("holiday = 'SNAP_CA'").count() == 1
    assert table.where("state = 'WI'").count() == 3
    assert table.count() == 3 * 3 + 2


def test_week_flags(calendar):
    assert week_flags(calendar).count() == 3


def test_csv_sources(spark, wide, calendar, tmp_path):
    path = str(tmp_path / "wide")
    wide.write.option("header", True).csv(path)
    back = files.read_wide_sales(spark, path)
    assert dict(back.dtypes)["d_7"] == "int" and back.count() == 3
    cal = str(tmp_path / "cal")
    raw_calendar(spark, events={3: "Thanksgiving"}).write.option("header", True).csv(cal)
    assert files.read_calendar(spark, cal, SNAPS).agg(F.sum("is_thanksgiving")).first()[0] == 1
    prices = str(tmp_path / "prices")
    spark.createDataFrame([("CA_1", "i", 11325, 9.58)], "store_id string, item_id string, wm_yr_wk int, sell_price double").write.option("header", True).csv(prices)
    assert files.read_sell_prices(spark, prices).first().sell_price == 9.58


def test_missing_sources_are_all_named(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="no such input") as error:
        files.require_sources(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")])
    assert "a.csv" in str(error.value) and "b.csv" in str(error.value)


def test_read_through(spark, tmp_path):
    path, calls = str(tmp_path / "cache"), []

    def compute():
        calls.append(1)
        return spark.range(len(calls))

    assert files.read_through(spark, path, compute).count() == 1
    assert files.read_through(spark, path, compute).count() == 1
    assert files.read_through(spark, path, compute, force_reload=True).count() == 2
    assert len(calls) == 2


@pytest.fixture(scope="module")
def featured(spark, make_weekly):
    base = make_weekly({"CA_1__FOODS": range(10, 70), "TX_2__HOBBIES": range(100, 160)})
    flags = {"snap_CA": (F.col("store_id") == "CA_1").cast("int"), "snap_TX": F.lit(0), "snap_WI": F.lit(1)}
    return features.features(base.withColumns(flags).withColumn("week_start", F.col("week_start").cast("string")))


def test_features(featured):
    rows = featured.where("series_id = 'CA_1__FOODS'").orderBy("week_start").collect()
    assert all(-1 <= r.week_sin <= 1 and -1 <= r.month_cos <= 1 for r in rows)
    assert {r.is_snap_week for r in rows} == {1}
    assert rows[0].sales_lag_52 is None and rows[51].sales_lag_52 is None and rows[52].sales_lag_52 == 10.0
    assert rows[4].rolling_4w_mean == 11.5
    assert rows[0].rolling_4w_mean is None and rows[1].rolling_4w_std is None
    assert rows[4].rolling_4w_std == pytest.approx(1.2909944487)
    assert (rows[0].year, rows[0].quarter, rows[0].week_of_year) == (2010, 1, 1)


def test_snap_by_state(featured):
    assert {r.is_snap_week for r in featured.where("store_id = 'TX_2'").collect()} == {0}


def test_unknown_state_has_no_snap(make_weekly):
    df = make_weekly({"NY_1__FOODS": [1]}).withColumns({c: F.lit(1) for c in SNAPS})
    assert features.features(df).first().is_snap_week == 0


def test_rolling_stats(make_weekly):
    rows = values(features.rolling_stats(make_weekly({"A__x": [10, 20, 30, 40]}), window=2), "rolling_mean", "rolling_std")
    assert rows[1][0] == 15 and rows[0] == (10.0, 0.0)


def test_lag_difference(make_weekly):
    assert values(features.lag_difference(make_weekly({"A__x": [1, 4, 9]})), "difference") == [3, 5]
