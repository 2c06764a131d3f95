"""Dense numbers for keys, kept up to date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import cut_lineage


def numbered(keys: DataFrame, key: str, start: int = 1) -> DataFrame:
    """``(key, number)``: the distinct known keys numbered from ``start`` without a gap.

    Keys are stored first. Each stored partition counts its own; the numbers of a partition begin where the one
    before ends, so there is no order over all keys and no task that sees them all.
    """
    stored = cut_lineage(keys.filter(F.col(key).isNotNull()).select(key).distinct())
    placed = stored.withColumn("_at", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_at", 33))
    # One row for each stored partition.
    parts = placed.groupBy("_part").agg(F.count("*").alias("_rows"), F.min("_at").alias("_first"))
    earlier = Window.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("_part", "_first", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    number = F.lit(start) + F.col("_before") + F.col("_at") - F.col("_first")
    return placed.join(F.broadcast(parts), "_part").select(key, number.cast("long").alias("number"))


def extend_numbers(known: DataFrame | None, keys: DataFrame, key: str) -> DataFrame:
    """``known(key, number)`` and the keys that are new in ``keys``, numbered behind the last one. Known
    numbers never change, so whatever was stored by number stays right."""
    if known is None:
        return numbered(keys, key)
    distinct = keys.filter(F.col(key).isNotNull()).select(key).distinct()
    last = known.agg(F.max("number")).first()[0]
    new = distinct.join(known.select(key), key, "left_anti")
    return known.select(key, "number").unionByName(numbered(new, key, 1 if last is None else last + 1))
