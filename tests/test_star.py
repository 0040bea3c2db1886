"""Star-schema adapter: hot keys and plan shape."""

import pytest
from pyspark.sql import functions as F

from weeklens.plans import catalog
from weeklens.sources import star


@pytest.fixture(scope="module")
def hot_star(spark, tmp_path_factory):
    """A third of the lines belong to one order and a third of the orders to one customer."""
    folder = str(tmp_path_factory.mktemp("star"))

    def write(name, df):
        df.selectExpr(*[
            f"CAST({c} AS {t}) AS {c}" if c in df.columns else f"CAST(NULL AS {t}) AS {c}"
            for c, t in (field.split() for field in star.SCHEMAS[name].split(", "))
        ]).repartition(6).write.parquet(f"{folder}/{name}.parquet")

    write("region", spark.sql("SELECT id AS r_regionkey, concat('R', id) AS r_name FROM range(2)"))
    write("nation", spark.sql("SELECT id AS n_nationkey, concat('N', id) AS n_name, id % 2 AS n_regionkey FROM range(4)"))
    write("customer", spark.sql("SELECT id AS c_custkey, id % 4 AS c_nationkey, concat('S', id % 3) AS c_mktsegment FROM range(3000)"))
    write("orders", spark.sql("SELECT id AS o_orderkey, CASE WHEN id % 3 = 0 THEN 7 ELSE id % 3000 END AS o_custkey FROM range(60000)"))
    write("lineitem", spark.sql(
        """SELECT CASE WHEN id % 3 = 0 THEN 5 ELSE id % 60000 END AS l_orderkey, 1 + id % 9 AS l_quantity,
                  timestamp_ntz'2000-01-03' + make_dt_interval(id % 700) AS l_shipdate FROM range(300000)"""
    ))
    return folder


def test_hot_keys_are_split_and_nothing_is_lost(spark, hot_star):
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        out = catalog.Inputs(spark, hot_star).weekly
        total = sum(r.total_sales for r in out.collect())
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert total == spark.read.parquet(f"{hot_star}/lineitem.parquet").agg(F.sum("l_quantity")).first()[0]
    assert "skew=true" in plan


def test_scan_reads_only_the_needed_columns(spark, hot_star):
    plan = star.daily_sales(spark, hot_star)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<l_orderkey:bigint,l_quantity:double,l_shipdate:timestamp_ntz>" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in plan


def test_windows_share_one_exchange(spark, hot_star):
    """From weekly rows to features there is a single exchange by series."""
    plan = catalog.queries()["split_labels"](spark, hot_star)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(series_id") == 1
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
