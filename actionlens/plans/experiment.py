"""A/B revenue comparison: conversion, revenue per payer and per user, outlier sensitivity.

The experiment table has one row per user: ``(user_id, testgroup, revenue)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import percent_text, ratio
from ..operators.distribution import describe
from ..operators.ranks import VALUES_PER_TASK, quantiles_of_counts, stored_counts_with_missing

# Group labels, control first, and the revenue from which a user is an outlier.
GROUPS = ("a", "b")
OUTLIER_CUT = 30_000.0


def _payer() -> Column:
    return (F.col("revenue") > 0) & ~F.isnan("revenue")


def ab_summary(experiment: DataFrame) -> DataFrame:
    """Per group: users, payers, conversion (own group as denominator), revenue per payer and per
    user. One pass."""
    return (
        experiment.filter(F.col("testgroup").isNotNull())
        .groupBy("testgroup")
        .agg(
            F.count("*").alias("users"),
            F.count_if(_payer()).alias("payers"),
            F.avg(F.when(_payer(), F.col("revenue"))).alias("arppu"),
            F.avg(F.when(~F.isnan("revenue"), F.col("revenue"))).alias("arpu"),
        )
        .select("testgroup", "users", "payers", ratio("payers", "users").alias("conversion"), "arppu", "arpu")
    )


def ab_summary_text(summary: DataFrame) -> DataFrame:
    """``(testgroup, message)``: the summary as text."""
    message = F.format_string(
        "Conversion of group %s: %s, revenue per payer: %.2f, revenue per user: %.2f",
        "testgroup",
        percent_text("conversion"),
        "arppu",
        "arpu",
    )
    return summary.select("testgroup", message.alias("message"))


def describe_payers(experiment: DataFrame, max_in_task: int = VALUES_PER_TASK) -> DataFrame:
    """Descriptive statistics of revenue among payers, per group."""
    return describe(experiment.filter(_payer()), "testgroup", "revenue", max_in_task)


def without_outliers(experiment: DataFrame, cut: float = OUTLIER_CUT) -> DataFrame:
    return experiment.filter(F.col("revenue") < cut)


def outlier_sensitivity(
    experiment: DataFrame, cut: float = OUTLIER_CUT, max_in_task: int = VALUES_PER_TASK
) -> DataFrame:
    """``(testgroup, variant, users, payers, conversion, arpu, q25, q50, q75)`` with all users
    (``all``) and with revenue below ``cut`` (``cut``); quartiles are those of payers.

    Both variants and both quartiles come from the same stored value counts, so the data are read
    once. Runs a job.
    """
    counted = stored_counts_with_missing(experiment, "testgroup", "revenue")
    value, n = F.col("value"), F.col("n")
    users = lambda which: F.coalesce(F.sum(F.when(which, n)), F.lit(0))
    mean = lambda which: F.try_divide(F.sum(F.when(which, value * n)), F.sum(F.when(which, n)))
    below = value < cut
    counts = counted.groupBy("testgroup").agg(
        F.sum("n").alias("users_all"),
        users(value > 0).alias("payers_all"),
        mean(value.isNotNull()).alias("arpu_all"),
        users(below).alias("users_cut"),
        users(below & (value > 0)).alias("payers_cut"),
        mean(below).alias("arpu_cut"),
    )
    variants = counts.select(
        "testgroup",
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(v).alias("variant"),
                        F.col(f"users_{v}").alias("users"),
                        F.col(f"payers_{v}").alias("payers"),
                        F.col(f"arpu_{v}").alias("arpu"),
                    )
                    for v in ("all", "cut")
                ]
            )
        ),
    )
    probabilities = [0.25, 0.5, 0.75]
    paid = counted.filter(value > 0)
    kept = {"all": paid, "cut": paid.filter(F.col("value") < cut)}
    quartiles = [
        quantiles_of_counts(counts, ["testgroup"], probabilities, max_in_task).withColumn("variant", F.lit(v))
        for v, counts in kept.items()
    ]
    return variants.join(quartiles[0].unionByName(quartiles[1]), ["testgroup", "variant"], "left").select(
        "testgroup",
        "variant",
        "users",
        "payers",
        ratio("payers", "users").alias("conversion"),
        "arpu",
        F.col("quantiles")[0].alias("q25"),
        F.col("quantiles")[1].alias("q50"),
        F.col("quantiles")[2].alias("q75"),
    )
