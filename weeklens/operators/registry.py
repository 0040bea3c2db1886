"""Model runs, champion selection and rollbacks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from weeklens.config import ROLLBACK_DEGRADATION, work_path
from weeklens.functions.arrays import let
from weeklens.functions.checks import require_columns
from weeklens.functions.numeric import null_if_nan
from weeklens.sources.files import path_exists

KEY = ("series_id", "model_type")
_TINY = 1e-9

RUN_SCHEMA = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("series_id", T.StringType()),
        T.StructField("model_type", T.StringType()),
        T.StructField("run_id", T.StringType()),
        T.StructField("val_mase", T.DoubleType()),
        T.StructField("params", T.MapType(T.StringType(), T.StringType())),
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType())),
        T.StructField("stage", T.StringType()),
    ]
)


def run_id(*parts: str) -> Column:
    return F.sha2(F.concat_ws("|", *[F.col(p).cast("string") for p in parts]), 256)


def candidate_runs(scores: DataFrame) -> DataFrame:
    """Run rows at stage ``candidate`` from (seq, series_id, model_type, val_mase [, params, metrics]).

    A score that is not a number is no score: NULL.
    """
    require_columns(scores, ("seq", *KEY, "val_mase"), "model run")
    scores = scores.withColumn("val_mase", null_if_nan(F.col("val_mase").cast("double")))
    params = F.create_map(F.lit("series_id"), F.col("series_id"), F.lit("model_type"), F.col("model_type"))
    metrics = F.create_map(F.lit("val_mase"), F.col("val_mase"))
    if "params" in scores.columns:
        params = F.map_concat(params, F.col("params"))
    if "metrics" in scores.columns:
        metrics = F.map_concat(metrics, F.col("metrics"))
    return scores.select(
        F.col("seq").cast("bigint").alias("seq"),
        *KEY,
        run_id("series_id", "model_type", "seq").alias("run_id"),
        "val_mase",
        params.alias("params"),
        metrics.alias("metrics"),
        F.lit("candidate").alias("stage"),
    )


class RunTable:
    """Append-only table of runs, kept by sequence number."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def log(self, runs: DataFrame) -> None:
        picked = [F.col(f.name).cast(f.dataType).alias(f.name) for f in RUN_SCHEMA.fields]
        runs.select(*picked).write.mode("append").parquet(self.path)

    def scan(self) -> DataFrame:
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], RUN_SCHEMA)
        return self.spark.read.schema(RUN_SCHEMA).parquet(self.path)


def _degradation(new: Column, current: Column) -> Column:
    return (new - current) / (current + F.lit(_TINY))


#: Why a run was promoted or rolled back.
FIRST, UNSCORED_CHAMPION, HOLDS, WORSE, UNSCORED = "first", "champion without score", "not worse", "worse", "no score"
PROMOTING = (FIRST, UNSCORED_CHAMPION, HOLDS)


def decision_reason(mase: Column, champion_run: Column, champion_mase: Column) -> Column:
    return (
        F.when(champion_run.isNull(), F.lit(FIRST))
        .when(mase.isNull(), F.lit(UNSCORED))
        .when(champion_mase.isNull(), F.lit(UNSCORED_CHAMPION))
        .when(_degradation(mase, champion_mase) > ROLLBACK_DEGRADATION, F.lit(WORSE))
        .otherwise(F.lit(HOLDS))
    )


def promote(champions: DataFrame, candidates: DataFrame) -> DataFrame:
    """One decision per candidate against the current champion of its key: a join, no history.

    ``champions`` (series_id, model_type, run_id, val_mase). Without a champion the candidate is promoted;
    with one it is rolled back only when its MASE is more than 5 % worse. A candidate without a score never
    replaces a champion, and a champion without a score gives way to any candidate that has one.
    """
    current = champions.select(*KEY, F.col("run_id").alias("champion_run"), F.col("val_mase").alias("champion_mase"))
    reason = decision_reason(F.col("val_mase"), F.col("champion_run"), F.col("champion_mase"))
    return candidates.select("seq", *KEY, "run_id", "val_mase").join(current, list(KEY), "left").select(
        "seq",
        *KEY,
        "run_id",
        "val_mase",
        reason.isin(*PROMOTING).alias("promoted"),
        "champion_run",
        "champion_mase",
        reason.alias("reason"),
    )


def next_champions(current: DataFrame, decided: DataFrame) -> DataFrame:
    """Champions after the decisions: promoted runs, and those of before where none was promoted."""
    new = decided.where("promoted").select(*KEY, "run_id", "val_mase")
    kept = current.join(new.select(*KEY), list(KEY), "left_anti")
    return new.unionByName(kept.select(*KEY, "run_id", "val_mase"))


#: Runs of a key that one fold walks; longer histories take a round for each such piece.
PIECE = 1000


def _walked(pieces: DataFrame) -> DataFrame:
    """(key, decided, champion) from (key, runs, champion): a fold over the runs in order, the champion as its state."""

    def step(state: Column, run: Column) -> Column:
        def decide(champion: Column) -> Column:
            reason = decision_reason(run["val_mase"], champion["run_id"], champion["val_mase"])

            def record(why: Column) -> Column:
                promoted = why.isin(*PROMOTING)
                row = F.struct(
                    run["seq"].alias("seq"), run["run_id"].alias("run_id"), run["val_mase"].alias("val_mase"), promoted.alias("promoted"),
                    champion["run_id"].alias("champion_run"), champion["val_mase"].alias("champion_mase"), why.alias("reason"),
                )
                after = F.struct(
                    F.when(promoted, run["run_id"]).otherwise(champion["run_id"]).alias("run_id"),
                    F.when(promoted, run["val_mase"]).otherwise(champion["val_mase"]).alias("val_mase"),
                )
                return F.struct(after.alias("champion"), F.concat(state["decided"], F.array(row)).alias("decided"))

            return let(reason, record)

        return let(state["champion"], decide)

    rows = "array<struct<seq:bigint,run_id:string,val_mase:double,promoted:boolean,champion_run:string,champion_mase:double,reason:string>>"
    zero = F.struct(F.col("champion"), F.array().cast(rows).alias("decided"))
    return pieces.withColumn("end", F.aggregate("runs", zero, step)).select(*KEY, "end.decided", "end.champion")


def replay(runs: DataFrame, piece: int = PIECE) -> DataFrame:
    """Decisions of a whole run history in sequence: each run meets the champion its predecessors left.

    Each decision depends on the one before, so a key is folded in order, ``piece`` runs at a time: a round folds the next
    piece of every key that has one, and hands the champions on as a written table, so no key is ever held whole. This is
    the audit of past runs; jobs decide new runs by ``promote``. Every run gets a decision, also one without a score.
    """
    spark = runs.sparkSession
    order = Window.partitionBy(*KEY).orderBy("seq", "run_id")
    numbered = runs.select("seq", *KEY, "run_id", null_if_nan(F.col("val_mase")).alias("val_mase")).withColumn(
        "piece", F.floor((F.row_number().over(order) - 1) / piece)
    )
    gathered = numbered.groupBy(*KEY, "piece").agg(F.array_sort(F.collect_list(F.struct("seq", "run_id", "val_mase"))).alias("runs"))
    nobody = F.struct(F.lit(None).cast("string").alias("run_id"), F.lit(None).cast("double").alias("val_mase"))
    flat = lambda walked: walked.select(*KEY, F.explode("decided").alias("d")).select(
        "d.seq", *KEY, "d.run_id", "d.val_mase", "d.promoted", "d.champion_run", "d.champion_mase", "d.reason"
    )

    def written(frame: DataFrame, name: str) -> DataFrame:
        path = work_path(spark, name)
        frame.write.parquet(path)
        return spark.read.schema(frame.schema).parquet(path)

    pieces = written(gathered, "run_pieces")
    last = pieces.agg(F.max("piece")).first()[0] or 0
    walked = _walked(pieces.where("piece = 0").withColumn("champion", nobody))
    decided = []
    for turn in range(1, last + 1):
        walked = written(walked, "run_decisions")
        decided.append(flat(walked))
        walked = _walked(pieces.where(F.col("piece") == turn).join(walked.select(*KEY, "champion"), list(KEY)))
    return reduce(DataFrame.unionByName, [*decided, flat(walked)])


def stages(decided: DataFrame) -> DataFrame:
    """Stage of every run: rolled_back, production for the last promoted one of its key, else archived."""
    last = F.max(F.when(F.col("promoted"), F.col("seq"))).over(Window.partitionBy(*KEY))
    stage = (
        F.when(~F.col("promoted"), F.lit("rolled_back"))
        .when(F.col("seq") == last, F.lit("production"))
        .otherwise(F.lit("archived"))
    )
    return decided.select("seq", *KEY, "run_id", "val_mase", stage.alias("stage"))


def champions(staged: DataFrame) -> DataFrame:
    """Current production run per series and model."""
    rows = staged.where(F.col("stage") == "production")
    newest = F.max_by(F.struct("run_id", "val_mase"), "seq")
    return rows.groupBy(*KEY).agg(newest.alias("c")).select(*KEY, "c.run_id", "c.val_mase")


def production_run(staged: DataFrame, series_id: str, model_type: str) -> DataFrame:
    return champions(staged.where((F.col("series_id") == series_id) & (F.col("model_type") == model_type)))


def list_production(staged: DataFrame) -> DataFrame:
    return champions(staged).orderBy("series_id", "model_type")


def rollback_alerts(decided: DataFrame) -> DataFrame:
    """Rows for human review: one per rolled-back run; the degradation of a run without a score is NULL."""
    degradation = _degradation(F.col("val_mase"), F.col("champion_mase"))
    unscored = F.concat(F.concat_ws("/", "series_id", "model_type"), F.lit(": new run has no MASE"))
    worse = F.format_string(
        "%s: new MASE %.4f against %.4f in production, %.1f%% worse",
        F.concat_ws("/", "series_id", "model_type"),
        F.col("val_mase"),
        F.col("champion_mase"),
        degradation * 100,
    )
    return decided.where("not promoted").select(
        "seq",
        *KEY,
        "run_id",
        F.lit("rollback").alias("alert_type"),
        degradation.alias("metric_value"),
        F.col("champion_run").alias("kept_run"),
        F.when(F.col("val_mase").isNull(), unscored).otherwise(worse).alias("message"),
    )
