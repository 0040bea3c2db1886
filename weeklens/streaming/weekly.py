"""Incremental weekly aggregation and drift monitoring with Structured Streaming."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weeklens.operators import monitoring
from weeklens.sources.files import path_exists
from weeklens.sources.batches import Batches

WEEK_OFFSET = "4 days"  # the epoch is a Thursday, weeks start on Monday


def weekly_totals(events: DataFrame, key: str, value: str, lateness: str = "7 days") -> DataFrame:
    """Tumbling Monday weeks per key over event time ``ts``; rows later than ``lateness`` are dropped."""
    week = F.window("ts", "7 days", startTime=WEEK_OFFSET)
    return (
        events.withWatermark("ts", lateness)
        .groupBy(week, key)
        .agg(F.count(F.lit(1)).alias("n_events"), F.sum(value).alias("total"))
        .select(F.to_date("window.start").alias("week_start"), key, "n_events", "total")
    )


def _totals(sink: str, key: str) -> Batches:
    return Batches(sink, ("week_start", key))


def drain_weekly_totals(stream: DataFrame, key: str, value: str, sink: str, checkpoint: str) -> None:
    """Processes everything available and stops; run again to take up new files."""
    query = (
        weekly_totals(stream, key, value)
        .writeStream.outputMode("update")
        .foreachBatch(_totals(sink, key).write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_weekly_totals(spark: SparkSession, sink: str, key: str) -> DataFrame:
    """Newest state of each window: from the last base and the batches after it."""
    return _totals(sink, key).read(spark)


def drain_drift_monitor(errors: DataFrame, state_path: str, checks_path: str, checkpoint: str, weeks: int = 12) -> None:
    """Takes in new error rows and checks again the series they touch.

    ``errors`` streams series_id, model_type, forecast_date, error, mase, mean_demand. The state after a batch is the
    last ``weeks`` rows of every key, one for each forecast date (the one that came last). A batch reads the state that
    the batch before it left and its own rows, so its cost follows the number of keys and not the length of the history.
    A batch that is run again starts from the same state.
    """

    def check(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before, after = (f"{state_path}/batch={i}" for i in (batch_id - 1, batch_id))
        rest = [c for c in batch.columns if c not in (*monitoring.KEY, "forecast_date")]
        rows = batch.withColumn("_batch", F.lit(batch_id).cast("bigint"))
        if path_exists(spark, before):
            rows = rows.unionByName(spark.read.parquet(before).drop("rank"))
        latest = F.max(F.struct("_batch", *rest))
        once = rows.groupBy(*monitoring.KEY, "forecast_date").agg(latest.alias("s"))
        kept = monitoring.recent(once.select(*monitoring.KEY, "forecast_date", "s.*"), weeks)
        kept.write.mode("overwrite").parquet(after)
        stored = spark.read.parquet(after)
        touched = F.max("_batch").over(Window.partitionBy(*monitoring.KEY)) == batch_id
        again = stored.withColumn("_touched", touched).where("_touched").drop("_touched", "_batch")
        Batches(checks_path, monitoring.KEY).write(monitoring.drift_checks(again), batch_id)

    query = (
        errors.writeStream.foreachBatch(check)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_checks(spark: SparkSession, checks_path: str) -> DataFrame:
    """Newest check per series and model: from the last base and the batches after it."""
    return Batches(checks_path, monitoring.KEY).read(spark)
