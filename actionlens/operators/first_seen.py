"""First event of every user, from full history or kept up to date."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .hot_keys import join_per_key


def first_seen(actions: DataFrame) -> DataFrame:
    """``(user_id, first_time)`` over all rows given. Combines on the map side, so a user with very
    many rows still sends one row per map task."""
    return (
        actions.filter(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(F.min("time").alias("first_time"))
    )


def with_first_seen(actions: DataFrame) -> DataFrame:
    """Every action with the user's ``first_time`` (NULL without a user). Users with very many
    actions are joined without a shuffle of those."""
    users = (
        actions.filter(F.col("user_id").isNotNull())
        .groupBy("user_id")
        .agg(F.min("time").alias("first_time"), F.count("*").alias("n_actions"))
    )
    return join_per_key(actions, users, "user_id", "n_actions")


def merge_first_seen(known: DataFrame, new_actions: DataFrame) -> DataFrame:
    """Next state of the maintained table: the known rows and one more batch of actions.

    Taking the minimum makes the merge safe to repeat and safe for late rows.
    """
    return (
        known.select("user_id", "first_time")
        .unionByName(first_seen(new_actions))
        .groupBy("user_id")
        .agg(F.min("first_time").alias("first_time"))
    )


def merge_into_buckets(known: DataFrame, new_actions: DataFrame) -> DataFrame:
    """``merge_first_seen`` for a stored table that is laid out in buckets by user.

    A join by user in place of a union: the stored side is read where it is, and only the users of the new
    actions are sent to its buckets. The result lies in the same buckets.
    """
    new = first_seen(new_actions).withColumnRenamed("first_time", "new_time")
    merged = known.select("user_id", "first_time").join(new, "user_id", "full_outer")
    return merged.select("user_id", F.least("first_time", "new_time").alias("first_time"))
