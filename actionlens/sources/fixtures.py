"""The job inputs expressed over the star-schema test tables (see FIXTURES.md)."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import timestamp_to_epoch
from ..operators.hot_keys import join_per_key

# Schemas of the test tables, stated so that opening a table starts no job.
EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("user_id", T.LongType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)
ORDERS = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderdate", T.TimestampNTZType()),
        T.StructField("o_orderpriority", T.StringType()),
    ]
)


CUSTOMER = T.StructType(
    [
        T.StructField("c_custkey", T.LongType()),
        T.StructField("c_name", T.StringType()),
        T.StructField("c_nationkey", T.IntegerType()),
        T.StructField("c_acctbal", T.DoubleType()),
        T.StructField("c_mktsegment", T.StringType()),
    ]
)


EXPERIMENT_FIRST = date(2024, 1, 28)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(ORDERS).parquet(f"{sf_dir}/orders.parquet")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(CUSTOMER).parquet(f"{sf_dir}/customer.parquet")


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    action = F.when(F.col("event_type") == "click", "like").otherwise(F.col("event_type"))
    return (
        events(spark, sf_dir)
        .filter(F.col("event_type") != "purchase")
        .select("user_id", F.col("ts").alias("time"), action.alias("action"))
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        events(spark, sf_dir)
        .filter(F.col("event_type") == "purchase")
        .select("user_id", F.col("ts").alias("time"))
    )


def registrations(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = orders(spark, sf_dir).groupBy("o_custkey").agg(F.min("o_orderdate").alias("t"))
    return first.select(F.col("o_custkey").alias("uid"), timestamp_to_epoch("t").alias("reg_ts"))


def sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders(spark, sf_dir).select(
        F.col("o_custkey").alias("uid"), timestamp_to_epoch("o_orderdate").alias("auth_ts")
    )


def event_registrations(spark: SparkSession, sf_dir: str) -> DataFrame:
    first = events(spark, sf_dir).groupBy("user_id").agg(F.min("ts").alias("t"))
    return first.select(F.col("user_id").alias("uid"), timestamp_to_epoch("t").alias("reg_ts"))


def event_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(
        F.col("user_id").alias("uid"), timestamp_to_epoch("ts").alias("auth_ts")
    )


def experiment(spark: SparkSession, sf_dir: str, first: date | None = EXPERIMENT_FIRST, last: date | None = None) -> DataFrame:
    """Purchases of the experiment's period, both days inclusive; ``None`` leaves that end open.

    By default the last days of the log, in which not everyone buys. Amounts have two decimals and are
    summed as such, so that the sum does not depend on the order of rows.
    """
    day = F.to_date("ts")
    counts = F.col("event_type") == "purchase"
    counts = counts & (day >= F.lit(first)) if first else counts
    counts = counts & (day <= F.lit(last)) if last else counts
    paid = F.when(counts, F.col("value").cast("decimal(18,2)"))
    group = F.when(F.col("user_id") % 2 == 0, "a").otherwise("b")
    return (
        events(spark, sf_dir)
        .groupBy("user_id")
        .agg(F.coalesce(F.sum(paid).cast("double"), F.lit(0.0)).alias("revenue"))
        .select("user_id", group.alias("testgroup"), "revenue")
    )


def unit_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as unit reports: the customer is the unit, hired on the day of the first order.

    The hire date is an aggregate joined back, not a window: a window would sort all reports of
    one unit in one task. Amounts are decimal, so that sums do not depend on the order of rows.
    """
    reports = orders(spark, sf_dir)
    hired = reports.groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("first_order"), F.count("*").alias("n_reports")
    )
    return join_per_key(reports, hired, "o_custkey", "n_reports").select(
        F.col("o_custkey").alias("dwarf_id"),
        F.to_date("first_order").alias("hired_date"),
        F.to_date("o_orderdate").alias("reported_date"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("gold_mined"),
        F.when(F.col("o_custkey") % 2 == 0, "2014-01-01").otherwise("2015-01-01").alias("hammer_date"),
    )
