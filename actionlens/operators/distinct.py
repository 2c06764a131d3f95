"""Distinct users per group and condition, counted at once or from stored bitmaps.

``distinct_by_condition`` counts directly. ``bitmap_states`` makes a bitmap of user numbers per day,
segment and chunk of 32,768 numbers; any window of days is then an OR of stored bitmaps, whose size
depends on the number of users and never on the number of their actions.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _met(condition: Column | None) -> Column:
    return F.lit(True) if condition is None else F.coalesce(condition, F.lit(False))


def distinct_by_condition(df: DataFrame, keys: list[Column], user: str, conditions: dict[str, Column | None]) -> DataFrame:
    """``(*keys, *conditions)``: for each group, the distinct known users with a row that meets each
    condition; None stands for any row.

    One aggregate per group and user, which combines on the map side, and one over those: rows are not
    repeated for each condition. A group without a known user counts zero.
    """
    flags = [F.bool_or(_met(condition)).alias(name) for name, condition in conditions.items()]
    per_user = df.groupBy(*keys, user).agg(*flags)
    names = [c for c in per_user.columns if c != user and c not in conditions]
    known = F.col(user).isNotNull()
    return per_user.groupBy(*names).agg(*[F.count_if(known & F.col(name)).alias(name) for name in conditions])


def bitmap_states(df: DataFrame, day: Column, user: str, conditions: dict[str, Column | None], numbers: DataFrame) -> DataFrame:
    """``(day, segment, chunk, bits)`` of ``df``: the users of each day that meet each condition, as bitmaps
    of their ``numbers(user, number)``. Users without a number are left out.

    Users and days meet before the join, so a user has a row for each day at most.
    """
    flags = [F.bool_or(_met(condition)).alias(name) for name, condition in conditions.items()]
    per_user = df.filter(F.col(user).isNotNull()).groupBy(day.alias("day"), user).agg(*flags)
    segments = F.filter(F.array(*[F.when(F.col(name), F.lit(name)) for name in conditions]), lambda x: x.isNotNull())
    placed = per_user.join(numbers, user).select("day", F.explode(segments).alias("segment"), "number")
    chunk = F.bitmap_bucket_number("number")
    return placed.groupBy("day", "segment", chunk.alias("chunk")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))


def _counted(merged: DataFrame, *keys: str) -> DataFrame:
    return merged.groupBy(*keys).agg(F.sum(F.bitmap_count("bits")).alias("users"))


def distinct_in_window(states: DataFrame, first: date, last: date) -> DataFrame:
    """``(segment, users)``: distinct users of the days ``first`` to ``last``, both inclusive."""
    window = states.filter(F.col("day").between(F.lit(first), F.lit(last)))
    return _counted(window.groupBy("segment", "chunk").agg(F.bitmap_or_agg("bits").alias("bits")), "segment")


def rolling_distinct(states: DataFrame, days: int, first: date, last: date) -> DataFrame:
    """``(date, segment, users)``: for each day from ``first`` to ``last``, the distinct users of the ``days`` days
    up to it; no row where there are none. Only states that a window needs are read."""
    needed = states.filter(F.col("day").between(F.lit(first - timedelta(days=days - 1)), F.lit(last)))
    ends = F.sequence(F.greatest("day", F.lit(first)), F.least(F.date_add("day", days - 1), F.lit(last)))
    windows = needed.withColumn("date", F.explode(ends))
    return _counted(windows.groupBy("date", "segment", "chunk").agg(F.bitmap_or_agg("bits").alias("bits")), "date", "segment")


def distinct_in_both(states: DataFrame, one: tuple[date, date], other: tuple[date, date]) -> DataFrame:
    """``(segment, users)``: users seen in both periods, each from its first to its last day."""
    parts = [
        states.filter(F.col("day").between(F.lit(first), F.lit(last))).groupBy("segment", "chunk").agg(F.bitmap_or_agg("bits").alias("bits"))
        for first, last in (one, other)
    ]
    met = parts[0].unionByName(parts[1]).groupBy("segment", "chunk").agg(F.bitmap_and_agg("bits").alias("bits"), F.count("*").alias("n"))
    return _counted(met.filter("n = 2"), "segment")
