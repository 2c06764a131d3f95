"""Mann-Whitney U test of two groups with tie correction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.significance import normal_two_sided_p
from ..session import cut_lineage
from .ranks import VALUES_PER_TASK, range_offsets, with_ranges, with_rows_before


def mann_whitney(
    df: DataFrame,
    group: str,
    value: str,
    labels: tuple[str, str],
    values_per_task: int = VALUES_PER_TASK,
) -> DataFrame:
    """One row: ``(n_first, n_second, rank_sum, u, mean_u, sigma_u, z, p_value)`` for the first group.

    Tied values share the mean of their ranks. The p-value is two-sided, from the normal
    approximation with tie and continuity correction. Ranks come from running totals over distinct
    values, so rows are never sorted.
    """
    counts = cut_lineage(
        df.filter(F.col(group).isin(*labels))
        .select(group, F.col(value).cast("double").alias("value"))
        .dropna()
        .groupBy("value")
        .agg(
            F.count("*").alias("n"),
            F.count_if(F.col(group) == labels[0]).alias("n_a"),
        )
    )
    ranged = with_ranges(counts, values_per_task)
    ranked = with_rows_before(ranged, range_offsets(ranged, []), [])
    # Twice the mean rank, times the rows: exact integers beyond the range of a long.
    twice = F.expr("CAST(2 * rows_before + n + 1 AS DECIMAL(19,0)) * CAST(n_a AS DECIMAL(18,0))")
    n = F.col("n").cast("double")
    sums = ranked.agg(
        F.sum("n_a").alias("n_first"),
        F.sum(F.col("n") - F.col("n_a")).alias("n_second"),
        (F.sum(twice) / 2).cast("double").alias("rank_sum"),
        F.sum(n * n * n - n).alias("ties"),
    )
    n1, n2 = F.col("n_first").cast("double"), F.col("n_second").cast("double")
    total = n1 + n2
    variance = n1 * n2 / 12 * (total + 1 - F.try_divide(F.col("ties"), total * (total - 1)))
    distance = F.greatest(F.abs(F.col("u") - F.col("mean_u")) - 0.5, F.lit(0.0))
    return (
        sums.withColumn("u", F.col("rank_sum") - n1 * (n1 + 1) / 2)
        .withColumn("mean_u", n1 * n2 / 2)
        .withColumn("sigma_u", F.sqrt(variance))
        .withColumn("z", F.try_divide(distance, F.col("sigma_u")))
        .withColumn("p_value", normal_two_sided_p(distance, F.col("sigma_u")))
        .drop("ties")
    )
