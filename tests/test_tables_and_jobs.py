import datetime as dt
import shutil

import numpy as np
import pytest
from conftest import SF_DIR, week
from pyspark.sql import functions as F

from weeklens.operators import registry
from weeklens.plans import catalog, jobs
from weeklens.sources.store import ForecastTable, latest_forecasts, latest_version
from weeklens.streaming import weekly as stream


def forecast_rows(spark, model="sar", version="v1", n=3, value=1.0):
    rows = [("A", week(i), i + 1, value + i, model, version) for i in range(n)]
    return spark.createDataFrame(
        rows, "series_id string, forecast_date date, horizon int, predicted_value double, model_type string, model_version string"
    )


def stamp(text):
    return F.lit(text).cast("timestamp")


def test_store_appends_and_filters(spark, tmp_path):
    table = ForecastTable(spark, str(tmp_path / "store"))
    assert table.scan().count() == 0
    assert table.append(forecast_rows(spark), stamp("2020-01-01")) == 3
    assert table.append(forecast_rows(spark), stamp("2020-01-01")) == 3
    assert table.append(forecast_rows(spark, "additive", "v2", 5, 10.0), stamp("2020-02-01")) == 5
    assert table.scan().count() == 11
    assert table.read(model_type="sar").count() == 6
    assert table.read(series_id="", model_type="additive").count() == 5
    got = table.read(model_type="additive", start_date=week(1), end_date=week(3)).collect()
    assert [r.forecast_date for r in got] == [week(1), week(2), week(3)]
    assert got[0].lower_bound is None
    assert table.read(series_id="B").count() == 0
    assert table.all_series().count() == 1
    assert latest_forecasts(table.scan()).count() == 8
    other = ForecastTable(spark, str(tmp_path / "copy"))
    table.export(str(tmp_path / "export"))
    assert other.import_from(str(tmp_path / "export")) == 11
    assert sorted(map(str, other.scan().collect())) == sorted(map(str, table.scan().collect()))


def test_store_requires_columns(spark, tmp_path):
    with pytest.raises(ValueError, match=r"missing columns \['horizon'\]"):
        ForecastTable(spark, str(tmp_path / "store")).append(forecast_rows(spark).drop("horizon"))


def test_store_fills_the_time(spark, tmp_path):
    table = ForecastTable(spark, str(tmp_path / "store"))
    table.append(forecast_rows(spark))
    assert table.scan().first().generated_at.year >= 2024


def test_model_filter_reads_one_folder(spark, tmp_path):
    table = ForecastTable(spark, str(tmp_path / "store"))
    table.append(forecast_rows(spark).unionByName(forecast_rows(spark, "additive")), stamp("2020-01-01"))
    assert len(table.scan().where("model_type = 'sar'").inputFiles()) >= 1
    plan = table.read(model_type="sar")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(model_type" in plan


def test_latest_version_ties(spark):
    a = forecast_rows(spark, version="v1").withColumn("generated_at", stamp("2020-01-01"))
    b = forecast_rows(spark, version="v2").withColumn("generated_at", stamp("2020-01-01"))
    assert latest_version(a.unionByName(b)).first().model_version == "v2"


def test_every_run_is_decided_also_without_a_score(spark):
    rows = [(i, "A", "m", v) for i, v in enumerate([1.0, float("nan"), 5.0, None, 0.9])] + [(0, "B", "m", None), (1, "B", "m", 3.0)]
    scores = spark.createDataFrame(rows, "seq bigint, series_id string, model_type string, val_mase double")
    runs = registry.candidate_runs(scores)
    got = {(r.series_id, r.seq): (r.promoted, r.reason, r.champion_mase) for r in registry.replay(runs).collect()}
    assert got == {
        ("A", 0): (True, "first", None), ("A", 1): (False, "no score", 1.0), ("A", 2): (False, "worse", 1.0),
        ("A", 3): (False, "no score", 1.0), ("A", 4): (True, "not worse", 1.0),
        ("B", 0): (True, "first", None), ("B", 1): (True, "champion without score", None),
    }
    current = runs.limit(0).select("series_id", "model_type", "run_id", "val_mase")
    for seq in range(5):  # the step by step join comes to the same decisions
        decided = registry.promote(current, runs.where(f"seq = {seq}")).persist()
        for r in decided.collect():
            assert (r.promoted, r.reason, r.champion_mase) == got[r.series_id, seq]
        current = spark.createDataFrame(registry.next_champions(current, decided).collect(), current.schema)


def python_promotions(mases):
    kept, out = None, []
    for m in mases:
        wins = kept is None or not (m - kept) / (kept + 1e-9) > 0.05
        out.append((wins, kept))
        kept = m if wins else kept
    return out


def test_replay_equals_a_loop_also_for_a_hot_key(spark):
    rng = np.random.default_rng(2)
    histories = {"hot": rng.uniform(0.5, 1.5, 4000), **{f"k{i}": rng.uniform(0.5, 1.5, 40) for i in range(50)}}
    rows = [(i, k, "m", float(v)) for k, vs in histories.items() for i, v in enumerate(vs)]
    rng.shuffle(rows)
    scores = spark.createDataFrame([tuple(r) for r in [(int(a), str(b), str(c), float(d)) for a, b, c, d in rows]],
                                   "seq bigint, series_id string, model_type string, val_mase double")
    decided = registry.replay(registry.candidate_runs(scores)).collect()
    assert len(decided) == len(rows)
    for key, history in histories.items():
        got = [(r.promoted, r.champion_mase) for r in sorted((r for r in decided if r.series_id == key), key=lambda r: r.seq)]
        want = python_promotions(history)
        assert [g[0] for g in got] == [w[0] for w in want]
        assert all((g[1] is None or np.isnan(g[1])) if w[1] is None else g[1] == w[1] for g, w in zip(got, want))


@pytest.fixture(scope="module")
def decided(spark):
    rows = [(i, "A", "m", v) for i, v in enumerate([1.0, 1.05, 1.2, 0.9])] + [(0, "B", "m", 2.0)]
    scores = spark.createDataFrame(rows, "seq bigint, series_id string, model_type string, val_mase double")
    return registry.replay(registry.candidate_runs(scores)).persist()


def test_stages_champions_and_alerts(decided):
    staged = registry.stages(decided)
    stages = {(r.series_id, r.seq): r.stage for r in staged.collect()}
    assert stages == {("A", 0): "archived", ("A", 1): "archived", ("A", 2): "rolled_back", ("A", 3): "production", ("B", 0): "production"}
    assert [(r.series_id, r.val_mase) for r in registry.list_production(staged).collect()] == [("A", 0.9), ("B", 2.0)]
    assert registry.production_run(staged, "A", "m").first().val_mase == 0.9
    assert registry.production_run(staged, "Z", "m").count() == 0
    alert = registry.rollback_alerts(decided).first()
    assert alert.metric_value == pytest.approx((1.2 - 1.05) / 1.05) and "14.3% worse" in alert.message


def test_promotion_by_join(spark, decided):
    current = registry.champions(registry.stages(decided))
    rows = [(9, "A", "m", 0.945), (9, "B", "m", 2.2), (9, "C", "m", 7.0)]
    candidates = registry.candidate_runs(spark.createDataFrame(rows, "seq bigint, series_id string, model_type string, val_mase double"))
    got = {r.series_id: r.promoted for r in registry.promote(current, candidates).collect()}
    assert got == {"A": True, "B": False, "C": True}


def test_run_table(spark, tmp_path, decided):
    table = registry.RunTable(spark, str(tmp_path / "runs"))
    assert table.scan().count() == 0
    scores = spark.createDataFrame([(1, "A", "m", 0.5)], "seq bigint, series_id string, model_type string, val_mase double")
    table.log(registry.candidate_runs(scores.withColumn("params", F.create_map(F.lit("order"), F.lit("1")))))
    table.log(registry.candidate_runs(scores.withColumn("metrics", F.create_map(F.lit("val_loss"), F.lit(0.25)))))
    rows = table.scan().orderBy(F.map_keys("params").cast("string")).collect()
    assert len(rows) == 2 and {r.stage for r in rows} == {"candidate"}
    assert any("order" in r.params for r in rows) and any("val_loss" in r.metrics for r in rows)


def test_retrain_skips_without_sources(spark, tmp_path):
    assert jobs.load_for_retrain(spark, str(tmp_path / "no"), str(tmp_path / "nothing")) is None


def test_full_run_on_star_tables(spark, tmp_path):
    inputs = catalog.Inputs(spark, SF_DIR)
    out = str(tmp_path / "run")
    results = jobs.run_all(spark, inputs.dense, inputs.calendar, catalog.STATES, out, stamp("2001-11-05"), with_eda=False).collect()
    assert {r.model for r in results} == {"sar", "additive", "window", "seasonal_naive"}
    assert len(results) == 100 and all(r.MAE >= 0 for r in results)
    assert spark.read.parquet(f"{out}/forecasts").count() == 4 * 25 * 13
    assert spark.read.parquet(f"{out}/stages").where("stage = 'production'").count() == 75
    assert spark.read.option("header", True).csv(f"{out}/evaluation_results/v1").count() == 100
    stored = jobs.stored_sar(spark, f"{out}/params")
    assert stored.count() == 25
    # A second run into the same folder takes the new sales and is judged on its own forecasts alone.
    tenfold = inputs.dense.withColumn("total_sales", F.col("total_sales") * 10)
    with pytest.raises(ValueError, match="not above the last run"):
        jobs.run_all(spark, tenfold, inputs.calendar, catalog.STATES, out, stamp("2001-11-12"), with_eda=False)
    again = jobs.run_all(spark, tenfold, inputs.calendar, catalog.STATES, out, stamp("2001-11-12"), with_eda=False, seq=2).collect()
    first = {(r.series_id, r.model): r for r in results}
    assert len(again) == 100
    for r in again:
        if r.model in ("sar", "seasonal_naive"):
            assert r.MAE == pytest.approx(10 * first[r.series_id, r.model].MAE, rel=1e-2)
    assert spark.read.parquet(f"{out}/champions/v2").count() == 75
    assert spark.read.parquet(f"{out}/stages").count() == 150


def test_drift_job_modes(spark, make_weekly):
    weekly = make_weekly({"A": range(100, 200)})
    stored = forecast_rows(spark, n=12, value=300.0).withColumns(
        {"generated_at": stamp("2020-01-01"), "lower_bound": F.lit(0.0), "upper_bound": F.lit(None).cast("double")}
    )
    checks, alerts = jobs.drift_job(stored, weekly, weekly)
    assert checks.count() == 1 and {"mase_alert", "bias_alert"} <= {r.alert_type for r in alerts.collect()}
    proxy, _ = jobs.drift_job(stored, weekly, weekly, error_mode="interval_proxy")
    assert proxy.first().bias_alert
    with pytest.raises(ValueError):
        jobs.drift_job(stored, weekly, weekly, error_mode="other")


def test_stream_equals_batch_over_two_drains(spark, tmp_path):
    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(hours=9 * i), f"t{i % 2}", i) for i in range(100)]
    events = spark.createDataFrame(rows, "event_id int, ts timestamp, kind string, amount bigint")
    inbox, sink, mark = (str(tmp_path / n) for n in ("inbox", "sink", "mark"))
    for part in (events.where("event_id < 60"), events.where("event_id >= 60")):
        part.coalesce(1).write.mode("append").parquet(inbox)
        source = spark.readStream.schema(events.schema).parquet(inbox)
        stream.drain_weekly_totals(source, "kind", "amount", sink, mark)
    got = {(r.week_start, r.kind): (r.n_events, r.total) for r in stream.read_weekly_totals(spark, sink, "kind").collect()}
    batch = events.groupBy(F.to_date(F.date_trunc("week", "ts")).alias("w"), "kind").agg(F.count("*").alias("n"), F.sum("amount").alias("s"))
    assert got == {(r.w, r.kind): (r.n, r.s) for r in batch.collect()}
    assert all(w.weekday() == 0 for w, _ in got)


def test_drift_stream_rechecks_touched_series(spark, tmp_path):
    schema = "series_id string, model_type string, forecast_date date, error double, mase double, mean_demand double"
    inbox, past, checks, mark = (str(tmp_path / n) for n in ("in", "past", "checks", "mark"))
    first = [(s, "m", week(i), 0.0, 0.5, 100.0) for s in "AB" for i in range(4)]
    second = [("A", "m", week(4 + i), 50.0, 3.0, 100.0) for i in range(4)]
    for rows in (first, second):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(inbox)
        stream.drain_drift_monitor(spark.readStream.schema(schema).parquet(inbox), past, checks, mark)
    got = {r.series_id: (r.mase_alert, r.bias_alert) for r in stream.read_checks(spark, checks).collect()}
    assert got == {"A": (True, True), "B": (False, False)}
    assert spark.read.parquet(f"{checks}/batch=1").count() == 1


def test_drift_stream_keeps_a_bounded_state(spark, tmp_path):
    """A repeated date counts once, by its later row, and a batch reads only the state before it."""
    schema = "series_id string, model_type string, forecast_date date, error double, mase double, mean_demand double"
    inbox, state, checks, mark = (str(tmp_path / n) for n in ("in", "state", "checks", "mark"))
    for turn in range(4):
        rows = [("A", "m", week(turn * 2 + i), float(turn), 0.5, 100.0) for i in range(4)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(inbox)
        stream.drain_drift_monitor(spark.readStream.schema(schema).parquet(inbox), state, checks, mark, weeks=6)
        if turn > 1:  # what an older batch left is not needed any more
            shutil.rmtree(f"{state}/batch={turn - 2}")
    left = spark.read.parquet(f"{state}/batch=3").orderBy("forecast_date").collect()
    assert [(r.forecast_date, r.error) for r in left] == [
        (week(4), 2.0), (week(5), 2.0), (week(6), 3.0), (week(7), 3.0), (week(8), 3.0), (week(9), 3.0)
    ]


def test_replay_in_pieces_stays_in_the_jvm(spark):
    rng = np.random.default_rng(3)
    rows = [(i, k, "m", float(v)) for k, n in (("a", 25), ("b", 7), ("c", 1)) for i, v in enumerate(rng.uniform(0.5, 1.5, n))]
    runs = registry.candidate_runs(spark.createDataFrame(rows, "seq bigint, series_id string, model_type string, val_mase double"))
    whole = registry.replay(runs)
    assert "Python" not in whole._jdf.queryExecution().toString()
    assert sorted(map(str, registry.replay(runs, piece=4).collect())) == sorted(map(str, whole.collect()))
    assert registry.replay(runs.limit(0)).count() == 0
