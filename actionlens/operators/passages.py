"""Ordered steps as a state that merges.

What a stretch of time does to a user is told by a *passage*: an array that has, for every number of
steps passed before the stretch, the number passed after it. Passages of stretches that follow each other
compose, and composing is associative, so days can be stored and any window of them put together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def day_passages(actions: DataFrame, user: str, day: Column, second: Column, steps: list[Column]) -> DataFrame:
    """``(user, day, passage)`` for users and days with any of ``steps``.

    Each day has the distinct seconds in which a step was taken, gathered on the map side first, at most 86,400 a
    step. In time order, and in step order within a second, every step that is the next one is passed.
    """
    taken = F.array(*(F.when(F.coalesce(condition, F.lit(False)), F.lit(i)) for i, condition in enumerate(steps)))
    events = actions.filter(F.col(user).isNotNull()).select(
        F.col(user).alias("user"), day.alias("day"), second.alias("second"), F.explode(F.filter(taken, lambda x: x.isNotNull())).alias("step")
    )
    gathered = events.groupBy("user", "day").agg(F.sort_array(F.collect_set(F.struct("second", "step"))).alias("events"))
    starts = F.array(*(F.lit(i) for i in range(len(steps) + 1)))
    passed = F.transform(starts, lambda start: F.aggregate("events", start, lambda at, e: F.when(e["step"] == at, at + 1).otherwise(at)))
    return gathered.select("user", "day", passed.alias("passage"))


def composed(first: Column, then: Column) -> Column:
    """The passage of one stretch and the one that follows it."""
    return F.transform(first, lambda at: F.get(then, at))


def merged_passages(passages: DataFrame, keys: list[str], order: str = "day") -> DataFrame:
    """``(*keys, passage)``: the passages of each group composed in ``order``; a group has a row for each day at
    most."""
    parts = F.sort_array(F.collect_list(F.struct(F.col(order).alias("at"), "passage")))
    gathered = passages.groupBy(*keys).agg(parts.alias("parts"))
    rest = F.slice("parts", 2, F.greatest(F.size("parts") - 1, F.lit(0)))
    whole = F.aggregate(rest, F.col("parts")[0]["passage"], lambda done, part: F.transform(done, lambda at: F.get(part["passage"], at)))
    return gathered.select(*keys, whole.alias("passage"))


def step_counts(passages: DataFrame, steps: int) -> DataFrame:
    """One row with ``n0 .. n<steps - 1>``: users who passed at least so many steps, and one more."""
    users = merged_passages(passages, ["user"])
    return users.agg(*(F.count_if(F.col("passage")[0] > i).alias(f"n{i}") for i in range(steps)))
