"""Readers for action tables and landed files."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import ACTION_MESSAGE
from . import schemas


def _known(name: str, kind: T.DataType) -> Column:
    """A column without NaN: from here on, a missing number is NULL."""
    value = F.col(name).cast(kind)
    return F.when(~F.isnan(value), value) if isinstance(kind, (T.DoubleType, T.FloatType)) else value


def _conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast the declared columns; a missing column fails at analysis. NaN becomes NULL."""
    return df.select(*[_known(f.name, f.dataType).alias(f.name) for f in schema.fields])


def feed_actions(df: DataFrame) -> DataFrame:
    """``(user_id, time, action)`` from any DataFrame that carries these columns."""
    return _conform(df, schemas.FEED_ACTIONS)


def message_actions(df: DataFrame) -> DataFrame:
    """``(user_id, time)`` from any DataFrame that carries these columns."""
    return _conform(df, schemas.MESSAGE_ACTIONS)


def all_actions(feed: DataFrame, messages: DataFrame) -> DataFrame:
    """Feed actions and messages as one stream of actions, copies kept."""
    tagged = messages.select("user_id", "time", F.lit(ACTION_MESSAGE).alias("action"))
    return feed.select("user_id", "time", "action").unionByName(tagged)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return _conform(spark.read.parquet(path), schema)


def read_days(spark: SparkSession, path: str, schema: T.StructType, first: date, last: date) -> DataFrame:
    """The days ``first`` to ``last`` of an action table laid out by ``write_actions``. Other days
    are not listed as input, let alone opened."""
    table = spark.read.parquet(path)
    return _conform(table.filter(F.col("day").between(F.lit(first), F.lit(last))), schema)


def read_table(spark: SparkSession, name: str, schema: T.StructType) -> DataFrame:
    """A catalog table (any catalog the session has configured)."""
    return _conform(spark.table(name), schema)


def read_query(spark: SparkSession, sql: str, **tables: DataFrame) -> DataFrame:
    """SQL text to DataFrame; ``tables`` are passed as arguments, so that no view is registered:
    ``read_query(spark, "SELECT ... FROM {feed}", feed=df)``."""
    return spark.sql(sql, **tables)


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, sep: str = ";", date_format: str = "yyyy-MM-dd"
) -> DataFrame:
    """Delimited text with a header. A row that does not fit the schema fails the read; NaN becomes
    NULL."""
    rows = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("sep", sep)
        .option("mode", "FAILFAST")
        .option("dateFormat", date_format)
        .csv(path)
    )
    return _conform(rows, schema)


def read_registrations_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.REGISTRATIONS)


def read_sessions_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.SESSIONS)


def read_experiment_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.EXPERIMENT)


def read_unit_reports_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.UNIT_REPORTS, sep=",")


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    schema: T.StructType,
    partition_column: str,
    lower_bound: str,
    upper_bound: str,
    partitions: int,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """A warehouse table over JDBC, read by ``partitions`` tasks. The bounds only shape the split;
    rows outside of them are still read."""
    reader = (
        spark.read.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("partitionColumn", partition_column)
        .option("lowerBound", lower_bound)
        .option("upperBound", upper_bound)
        .option("numPartitions", partitions)
        .option("preferTimestampNTZ", True)
        .options(**(properties or {}))
    )
    return _conform(reader.load(), schema)
