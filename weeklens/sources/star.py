"""Star-schema adapter: order lines as daily sales, plus a calendar over their span."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weeklens.sources.calendar import calendar_from_days

# Region name -> calendar column with its benefit days, and their first and last day of month.
REGION_STATES = {
    "AFRICA": "snap_AFRICA",
    "AMERICA": "snap_AMERICA",
    "ASIA": "snap_ASIA",
    "EUROPE": "snap_EUROPE",
    "MIDDLE EAST": "snap_MIDDLE_EAST",
}
BENEFIT_DAYS = {
    "snap_AFRICA": (1, 10),
    "snap_AMERICA": (2, 11),
    "snap_ASIA": (3, 12),
    "snap_EUROPE": (4, 13),
    "snap_MIDDLE_EAST": (5, 14),
}


# Declared, so reading a table opens no footers before the scan itself.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def order_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order key with the place and category it belongs to.

    Customers, nations and regions join on the order side, which is several times smaller than the
    lines, so the lines move through one exchange only. No side is broadcast by hint: Spark
    broadcasts a customer table whose measured size is under its threshold, and adaptive skew join
    splits a hot customer or order key.
    """
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    places = nation.join(region, nation.n_regionkey == region.r_regionkey).select("n_nationkey", "n_name", "r_name")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    buyers = customer.join(places, customer.c_nationkey == places.n_nationkey)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    return orders.join(buyers, orders.o_custkey == buyers.c_custkey).select(
        "o_orderkey",
        F.col("r_name").alias("state_id"),
        F.concat("r_name", F.lit("_1")).alias("store_id"),
        F.col("c_mktsegment").alias("cat_id"),
        F.concat_ws("_", "c_mktsegment", "n_name").alias("item_id"),
    )


def daily_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order line: state, store, category, item, day, units sold.

    Both sides of this join grow with the data. The merge hint keeps Spark from broadcasting either one
    (the pruned lines of a small sample look smaller than the estimated places).
    """
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        F.to_date("l_shipdate").alias("date"),
        F.col("l_quantity").cast("int").alias("sales"),
    )
    places = order_places(spark, sf_dir).hint("merge")
    return lines.join(places, lines.l_orderkey == places.o_orderkey).select(
        "state_id", "store_id", "cat_id", "item_id", "date", "sales"
    )


def day_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First and last shipping day: one row from a one-column scan."""
    day = F.to_date("l_shipdate")
    return table(spark, sf_dir, "lineitem").agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))


def _event_name(day: Column) -> Column:
    month, dom, dow = F.month(day), F.dayofmonth(day), F.weekday(day)
    return (
        F.when((month == 11) & (dow == 3) & dom.between(22, 28), F.lit("Thanksgiving"))
        .when((month == 11) & (dow == 4) & dom.between(23, 29), F.lit("BlackFriday"))
        .when((month == 12) & (dom == 25), F.lit("Christmas"))
        .when((month == 7) & (dom == 4), F.lit("IndependenceDay"))
    )


def raw_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar input rows, one per day of the span: d, date, event and benefit-day columns."""
    days = day_span(spark, sf_dir).select(
        F.posexplode(F.sequence("first_day", "last_day", F.expr("interval 1 day"))).alias("pos", "date")
    )
    dom = F.dayofmonth("date")
    name = _event_name(F.col("date"))
    kind = F.when(name == "BlackFriday", F.lit("Commercial")).when(name.isNotNull(), F.lit("National"))
    return days.select(
        F.concat(F.lit("d_"), (F.col("pos") + 1).cast("string")).alias("d"),
        "date",
        name.alias("event_name_1"),
        kind.alias("event_type_1"),
        *[dom.between(lo, hi).cast("int").alias(col) for col, (lo, hi) in BENEFIT_DAYS.items()],
    )


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calendar_from_days(raw_calendar(spark, sf_dir), REGION_STATES.values())
