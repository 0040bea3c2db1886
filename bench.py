"""Times the headline queries and prints one JSON line.

BENCH_RUNS takes the median of several runs of each query; ``duckdb`` holds one run of the same queries' SQL.
"""

from __future__ import annotations

import json
import os
import tempfile
import time
from statistics import median

import duckdb

from weeklens.config import spark_session
from weeklens.plans import catalog, oracles

HEADLINE = (
    "weekly_sales", "dense_weekly", "features", "split_labels", "scaled_series", "training_windows",
    "model_results", "metrics_by_horizon", "rolling_mase", "store_scan", "decompose_ma", "anomalies", "acf", "pacf",
    "adf_test", "decompose_stl", "sar_fit", "sar_forecast", "sar_diagnostics", "additive_fit", "additive_forecast",
    "window_forecast", "psi", "drift_checks", "alert_rows", "health_table", "newsvendor", "run_stages",
    "weekly_stream", "wide_to_weekly", "full_run",
)


def duckdb_seconds(sf_dir: str, names: tuple[str, ...], cpus: str) -> dict[str, float]:
    """The same results from the queries' SQL on the same tables."""
    con = duckdb.connect()
    con.execute(f"SET threads = {int(cpus)}")
    for file in os.listdir(sf_dir):
        path = f"{sf_dir}/{file}"
        source = f"{path}/*.parquet" if os.path.isdir(path) else path
        con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{source}')")
    seconds, statements = {}, oracles.oracle_sql()
    for name in names:
        if name in statements:
            start = time.perf_counter()
            con.execute(statements[name]).fetchall()
            seconds[name] = round(time.perf_counter() - start, 3)
    return seconds


def main() -> None:
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = spark_session(
        "bench",
        master=f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "12g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.python.sql.dataFrameDebugging.enabled": "false",
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="weeklens-bench-"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    available = catalog.queries()
    available["weekly_sales"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm the JVM
    seconds = {}
    for name in HEADLINE:
        taken = []
        for _ in range(runs):
            start = time.perf_counter()
            available[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(median(taken), 3)
    total = round(sum(seconds.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    spark.stop()
    out = {"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": sf}
    print(json.dumps(out | {"runs": runs, "duckdb": duckdb_seconds(sf_dir, HEADLINE, cpus)}))


if __name__ == "__main__":
    main()
