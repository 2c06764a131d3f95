"""Quantiles of any span of days from stored sketches.

A sketch keeps a bounded sample of a day's values with weights. Sketches of days merge into the sketch of
their span. Ranks are off by no more than ``RANK_ERROR`` of all values, with a probability of 99 %; the exact
way is ``ranks.quantiles``.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Size of a sketch, and what its ranks are off by at most: 2.446 / k^0.9433, the two-sided bound of such sketches for all
# ranks at once.
SIZE = 2_000
RANK_ERROR = 2.446 / SIZE**0.9433


def day_sketches(df: DataFrame, group: str, day: Column, value: str, size: int = SIZE) -> DataFrame:
    """``(day, group, sketch, n, low, high)``; rows without a day, group or value (null or NaN) are left out. Values are
    taken into sketches where they are, and only sketches are sent."""
    number = F.col(value).cast("double")
    known = df.select(day.alias("day"), F.col(group).alias("group"), F.when(~F.isnan(number), number).alias("x")).dropna()
    return known.groupBy("day", "group").agg(
        F.kll_sketch_agg_double("x", size).alias("sketch"), F.count("*").alias("n"), F.min("x").alias("low"), F.max("x").alias("high")
    )


def quantiles_of_days(sketches: DataFrame, first: date, last: date, probabilities: list[float], size: int = SIZE) -> DataFrame:
    """``(group, n, low, high, quantiles)`` of the days ``first`` to ``last``, both inclusive. The smallest and the largest
    value are exact."""
    span = sketches.filter(F.col("day").between(F.lit(first), F.lit(last)))
    merged = span.groupBy("group").agg(
        F.kll_merge_agg_double("sketch", size).alias("sketch"), F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high")
    )
    wanted = F.array(*(F.lit(float(p)) for p in probabilities))
    return merged.select("group", "n", "low", "high", F.kll_sketch_get_quantile_double("sketch", wanted).alias("quantiles"))


def box_of_days(sketches: DataFrame, first: date, last: date) -> DataFrame:
    """``(group, n, low, q25, q50, q75, high)``: a box summary without its whiskers, from sketches."""
    boxed = quantiles_of_days(sketches, first, last, [0.25, 0.5, 0.75])
    return boxed.select("group", "n", "low", *(F.col("quantiles")[i].alias(name) for i, name in enumerate(("q25", "q50", "q75"))), "high")
