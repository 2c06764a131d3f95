"""Descriptive statistics, histograms and box summaries by group."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .ranks import MAX_BROADCAST_ROWS, VALUES_PER_TASK, quantiles_of_counts, stored_counts_with_missing, stored_value_counts


def describe(df: DataFrame, group: str, value: str, max_in_task: int = VALUES_PER_TASK) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum per group. NaN counts as
    missing.

    Everything follows from value counts, so ``df`` is read once. Runs jobs: the counts are stored.
    The means go back to them for the deviation, by broadcast if the groups were counted to be few.
    """
    counted = stored_counts_with_missing(df, group, value)
    counts = counted.filter(F.col("value").isNotNull())
    weight = F.when(F.col("value").isNotNull(), F.col("n"))
    moments = counted.groupBy(group).agg(
        F.coalesce(F.sum(weight), F.lit(0)).alias("n"),
        (F.sum(F.col("value") * F.col("n")) / F.sum(weight)).alias("mean"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    means = moments.select(group, "mean")
    few = means.count() <= MAX_BROADCAST_ROWS
    away = F.col("value") - F.col("mean")
    squares = (
        counts.join(F.broadcast(means) if few else means, group)
        .groupBy(group)
        .agg(F.sum(away * away * F.col("n")).alias("squares"))
    )
    quartiles = quantiles_of_counts(counts, [group], [0.25, 0.5, 0.75], max_in_task)
    described = moments.join(squares, group, "left").join(quartiles, group, "left")
    return described.withColumn("std", F.sqrt(F.try_divide("squares", F.col("n") - 1))).select(
        group,
        "n",
        "mean",
        "std",
        "min",
        F.col("quantiles")[0].alias("q25"),
        F.col("quantiles")[1].alias("q50"),
        F.col("quantiles")[2].alias("q75"),
        "max",
    )


def histogram(df: DataFrame, group: str, labels: tuple[str, ...], value: str, bins: int) -> DataFrame:
    """Equal-width bins between the smallest and the largest value of each named group:
    ``(group, bin, low, high, n)``. Bins count from 1, the last one is closed on both sides, empty
    ones are left out.

    Values and limits come from the same stored value counts, so the data are read once. The limits
    are one row per label: their size is known and they are broadcast.
    """
    counts = stored_value_counts(df.filter(F.col(group).isin(*labels)), [group], value)
    limits = counts.groupBy(group).agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    # A constant gets a range of one around itself.
    flat = F.col("lo") == F.col("hi")
    limits = limits.withColumn("half", F.when(flat, 0.5).otherwise(0.0)).select(
        group, (F.col("lo") - F.col("half")).alias("lo"), (F.col("hi") + F.col("half")).alias("hi")
    )
    width = (F.col("hi") - F.col("lo")) / bins
    position = F.floor((F.col("value") - F.col("lo")) / width) + 1
    return (
        counts.join(F.broadcast(limits), group)
        .withColumn("bin", F.least(F.lit(bins), position).cast("long"))
        .groupBy(group, "bin", "lo", "hi")
        .agg(F.sum("n").alias("n"))
        .select(
            group,
            "bin",
            (F.col("lo") + width * (F.col("bin") - 1)).alias("low"),
            (F.col("lo") + width * F.col("bin")).alias("high"),
            "n",
        )
    )


def box_summary(
    df: DataFrame,
    group: str,
    labels: tuple[str, ...],
    value: str,
    max_in_task: int = VALUES_PER_TASK,
) -> DataFrame:
    """Quartiles, whiskers (last values within 1.5 interquartile ranges) and number of outliers of
    each named group.

    The quartiles are one row per label; they are broadcast to the value counts.
    """
    counts = stored_value_counts(df.filter(F.col(group).isin(*labels)), [group], value)
    quartiles = quantiles_of_counts(counts, [group], [0.25, 0.5, 0.75], max_in_task).select(
        group,
        F.col("quantiles")[0].alias("q25"),
        F.col("quantiles")[1].alias("q50"),
        F.col("quantiles")[2].alias("q75"),
    )
    reach = (F.col("q75") - F.col("q25")) * 1.5
    inside = F.col("value").between(F.col("q25") - reach, F.col("q75") + reach)
    return (
        counts.join(F.broadcast(quartiles), group)
        .groupBy(group, "q25", "q50", "q75")
        .agg(
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.sum(F.when(inside, 0).otherwise(F.col("n"))).cast("long").alias("n_outliers"),
        )
    )
