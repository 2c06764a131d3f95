"""Order statistics over groups of any size.

A value column is first collapsed to ``(group, value, n)``, where equal values meet on the map
side. The collapsed rows are cut into value ranges at data-driven split points, so that no task
sorts more than a bounded number of them. The split points are literals of the plan: every use of
the ranges, also after a lost executor, sees the same cut.
"""

from __future__ import annotations

from pyspark.ml.feature import QuantileDiscretizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import cut_lineage

# Distinct values that one task may hold.
VALUES_PER_TASK = 1_000_000
# Split points are literals of the plan. Beyond 10**10 distinct values ranges get larger, not more.
MAX_RANGES = 10_000

# Counted rows up to which a side of a join is broadcast.
MAX_BROADCAST_ROWS = 100_000


def value_counts(df: DataFrame, groups: list[str], value: str) -> DataFrame:
    """``(*groups, value, n)``; null groups and null values are left out, as in a group-by mean."""
    kept = df.select(*groups, F.col(value).cast("double").alias("value")).dropna()
    return kept.groupBy(*groups, "value").agg(F.count("*").alias("n"))


def stored_value_counts(df: DataFrame, groups: list[str], value: str) -> DataFrame:
    """``value_counts`` written to the checkpoint folder: the data are read once, and what follows
    reads the collapsed rows as often as it needs."""
    return cut_lineage(value_counts(df, groups, value))


def stored_counts_with_missing(df: DataFrame, group: str, value: str) -> DataFrame:
    """``(group, value, n)`` of the rows with a group, stored. NULL and NaN are one value, NULL, so a
    group without any known value is still there."""
    number = F.col(value).cast("double")
    kept = df.filter(F.col(group).isNotNull()).select(group, F.when(~F.isnan(number), number).alias("value"))
    return cut_lineage(kept.groupBy(group, "value").agg(F.count("*").alias("n")))


def with_ranges(counts: DataFrame, values_per_task: int = VALUES_PER_TASK) -> DataFrame:
    """Add ``value_range``, an integer that grows with ``value``, with a bounded number of rows of
    ``counts`` per range. ``counts`` should be stored, for it is read repeatedly."""
    rows = counts.count()
    if rows < 2:
        return counts.withColumn("value_range", F.lit(0).cast("long"))
    ranges = min(MAX_RANGES, max(2, -(-rows // values_per_task)))
    cutter = QuantileDiscretizer(
        numBuckets=ranges,
        inputCol="value",
        outputCol="value_range",
        relativeError=1.0 / (4 * ranges),
        handleInvalid="keep",
    ).fit(counts)
    return cutter.transform(counts).withColumn("value_range", F.col("value_range").cast("long"))


def range_offsets(ranged: DataFrame, groups: list[str], count: str = "n") -> DataFrame:
    """``(*groups, value_range, in_range, range_before, rows_total)``: rows in the range, in earlier
    ranges of the group, and in the whole group. One row per group and range; stored, for the
    following steps look at it more than once."""
    whole = Window.partitionBy(*groups) if groups else Window.partitionBy(F.lit(0))
    earlier = whole.orderBy("value_range").rowsBetween(Window.unboundedPreceding, -1)
    return cut_lineage(
        ranged.groupBy(*groups, "value_range")
        .agg(F.sum(count).alias("in_range"))
        .withColumn("range_before", F.coalesce(F.sum("in_range").over(earlier), F.lit(0)))
        .withColumn("rows_total", F.sum("in_range").over(whole))
    )


def with_rows_before(ranged: DataFrame, offsets: DataFrame, groups: list[str], count: str = "n") -> DataFrame:
    """Add ``rows_before`` (rows of the group with a smaller value) and ``rows_total`` to the rows
    whose range is in ``offsets``. The running total inside a range touches that range only.

    Offsets are broadcast if they were counted to be few.
    """
    few = offsets.count() <= MAX_BROADCAST_ROWS
    inside = (
        Window.partitionBy(*groups, "value_range")
        .orderBy("value")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        ranged.join(F.broadcast(offsets) if few else offsets, [*groups, "value_range"])
        .withColumn("inside_before", F.coalesce(F.sum(count).over(inside), F.lit(0)))
        .withColumn("rows_before", (F.col("range_before") + F.col("inside_before")).cast("long"))
        .withColumn("rows_total", F.col("rows_total").cast("long"))
        .drop("value_range", "in_range", "range_before", "inside_before")
    )


def quantiles(
    df: DataFrame,
    groups: list[str],
    value: str,
    probabilities: list[float],
    max_in_task: int = VALUES_PER_TASK,
) -> DataFrame:
    """Exact linear-interpolation quantiles: ``(*groups, quantiles)``, an array in the order of
    ``probabilities``."""
    return quantiles_of_counts(stored_value_counts(df, groups, value), groups, probabilities, max_in_task)


def quantiles_of_counts(
    counts: DataFrame, groups: list[str], probabilities: list[float], max_in_task: int = VALUES_PER_TASK
) -> DataFrame:
    """Quantiles from stored value counts.

    With at most ``max_in_task`` of them the built-in exact percentile is used: its state holds
    distinct values with their counts. Beyond that the ranks are found range by range.
    """
    if counts.count() <= max_in_task:
        wanted = F.array(*[F.lit(p) for p in probabilities])
        return counts.groupBy(*groups).agg(F.percentile("value", wanted, F.col("n")).alias("quantiles"))
    ranged = with_ranges(counts, max_in_task)
    offsets = range_offsets(ranged, groups)
    start, size = F.col("range_before"), F.col("in_range")
    needed = offsets.filter(F.size(_wanted_ranks(probabilities, start, size)) > 0)
    # Only ranges that hold a wanted rank are sorted; the others were needed for their size alone.
    ranked = with_rows_before(ranged, needed, groups)
    wanted = _wanted_ranks(probabilities, F.col("rows_before"), F.col("n"))
    hits = ranked.select(*groups, "value", F.explode(wanted).alias("w"))
    # Two picked values per probability and group: the neighbours of the position.
    per_probability = hits.groupBy(*groups, F.col("w.i").alias("i")).agg(
        F.min("value").alias("low"), F.max("value").alias("high"), F.first("w.part").alias("part")
    )
    # The arithmetic of the built-in percentile, so that size does not show in the last digits.
    between = (1 - F.col("part")) * F.col("low") + F.col("part") * F.col("high")
    quantile = F.when(F.col("low") == F.col("high"), F.col("low")).otherwise(between)
    ordered = F.array_sort(F.collect_list(F.struct("i", quantile.alias("q"))))
    return per_probability.groupBy(*groups).agg(F.transform(ordered, lambda s: s["q"]).alias("quantiles"))


def _wanted_ranks(probabilities: list[float], first: Column, rows: Column) -> Column:
    """Of the ranks next to the wanted positions, those within ``first .. first + rows - 1``: an
    array of ``(i, rank, part)``, probability number, rank, and way from it to the next one."""
    wanted = []
    for i, p in enumerate(probabilities):
        position = (F.col("rows_total") - 1) * F.lit(float(p))
        for rank in (F.floor(position), F.ceil(position)):
            part = position - F.floor(position)
            wanted.append(F.struct(F.lit(i).alias("i"), rank.cast("long").alias("rank"), part.alias("part")))
    return F.filter(F.array(*wanted), lambda w: (w["rank"] >= first) & (w["rank"] < first + rows))
