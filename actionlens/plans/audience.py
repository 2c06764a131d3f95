"""Audience of any window of days from stored day states.

A daily run numbers the users it sees for the first time, stores the bitmaps of its days, and never
reads older actions again.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import ACTION_LIKE, ACTION_MESSAGE, ACTION_VIEW, day_of
from ..operators.distinct import bitmap_states, rolling_distinct
from ..operators.numbering import extend_numbers
from ..sources import sinks
from ..sources.versions import commit_version, read_version
from .daily import in_days

# Windows of the audience report, in days.
WINDOWS = (1, 7, 28)


def segments() -> dict:
    """What a user must have done to be of a segment; None stands for any action."""
    action = F.col("action")
    return {"users": None, "viewers": action == ACTION_VIEW, "likers": action == ACTION_LIKE, "writers": action == ACTION_MESSAGE}


def publish_audience_days(actions: DataFrame, first: date, last: date, folder: str, previous: date | None = None) -> DataFrame:
    """Store the states of the days ``first`` to ``last`` in ``<folder>/states`` and the user numbers as the
    version ``last`` of ``<folder>/numbers``; returns all stored states.

    ``previous`` is the version of the numbers to go on from; without one, numbers begin anew, and so must
    the states. Days that are stored again replace themselves. Only actions of these days are read.
    """
    spark = actions.sparkSession
    of_days = actions.filter(in_days("time", first, last))
    known = read_version(spark, f"{folder}/numbers/as_of={previous.isoformat()}") if previous else None
    path = f"{folder}/numbers/as_of={last.isoformat()}"
    commit_version(extend_numbers(known, of_days, "user_id"), path)
    states = bitmap_states(of_days, day_of("time"), "user_id", segments(), read_version(spark, path))
    sinks.write_partitions(states, f"{folder}/states", "day")
    return stored_states(spark, folder)


def stored_states(spark, folder: str) -> DataFrame:
    return spark.read.schema("segment string, chunk long, bits binary, day date").parquet(f"{folder}/states")


def audience_series(states: DataFrame, first: date, last: date, windows: tuple[int, ...] = WINDOWS) -> DataFrame:
    """``(date, segment, users_<days>, ...)`` for the days ``first`` to ``last``: distinct users of each window that
    ends there, zero for a segment seen in a longer window only."""
    parts = [rolling_distinct(states, days, first, last).withColumn("days", F.lit(days)) for days in windows]
    long = parts[0]
    for part in parts[1:]:
        long = long.unionByName(part)
    of = [F.coalesce(F.max(F.when(F.col("days") == days, F.col("users"))), F.lit(0)).cast("long").alias(f"users_{days}") for days in windows]
    return long.groupBy("date", "segment").agg(*of)
