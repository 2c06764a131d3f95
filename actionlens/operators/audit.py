"""Checks on input tables: nulls, copies, key uniqueness, types, unmatched joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _per_column(df: DataFrame, value, names: list[str], value_name: str) -> DataFrame:
    """One aggregate row over ``df``, turned into a row per column."""
    one_row = df.agg(*[value(c).alias(c) for c in names])
    return one_row.unpivot([], names, "column_name", value_name)


def null_counts(df: DataFrame) -> DataFrame:
    """``(column_name, nulls)`` for every column, in one pass without a shuffle of rows. NaN counts as
    missing too."""
    floats = {name for name, kind in df.dtypes if kind in ("double", "float")}
    missing = lambda c: F.col(c).isNull() | F.isnan(c) if c in floats else F.col(c).isNull()
    return _per_column(df, lambda c: F.count_if(missing(c)), df.columns, "nulls")


def column_types(df: DataFrame) -> DataFrame:
    """``(column_name, data_type, non_null)`` for every column."""
    counts = _per_column(df, lambda c: F.count(F.col(c)), df.columns, "non_null")
    types = dict(df.dtypes)
    names = F.create_map(*[F.lit(x) for c in df.columns for x in (c, types[c])])
    return counts.select("column_name", names[F.col("column_name")].alias("data_type"), "non_null")


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row in all columns. Copies meet on the map side first, so a row
    with very many copies is no hot spot."""
    return (
        df.groupBy(*df.columns)
        .agg(F.count("*").alias("copies"))
        .agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).cast("long").alias("duplicates"))
    )


def key_uniqueness(df: DataFrame, key: str) -> DataFrame:
    """``(n_rows, n_keys, is_unique)``; null keys make a key column not unique."""
    return (
        df.groupBy(key)
        .agg(F.count("*").alias("n"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n_rows"),
            F.count(key).alias("n_keys"),
        )
        .withColumn("is_unique", F.col("n_rows") == F.col("n_keys"))
    )


def unmatched_rows(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Rows of ``left`` whose key is missing on the right.

    Both sides are brought to one row per key first, so a key with very many rows is no hot spot.
    """
    keys = left.groupBy(key).agg(F.count("*").alias("n"))
    missing = keys.join(right.select(key).distinct(), key, "left_anti")
    return missing.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("unmatched"))
