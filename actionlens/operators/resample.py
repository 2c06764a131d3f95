"""Two-sample bootstrap of a difference, with replicas as a data dimension.

One replica draws the same number of values with replacement from each group, pairs them by
position and applies a statistic to the differences. Ways to get there:

``resample``  mean only. Draws from the collapsed ``(value, n)`` rows: a multinomial count per
              distinct value, split over value parts. Same distribution as drawing rows one by
              one, but the work grows with distinct values, and zero revenue is one of them.
``poisson``   mean only. An independent Poisson weight per row and replica, added up in states of
              ``replicas x 2`` numbers a task. An approximation whose number of draws varies around
              the wanted one. With the ``key`` of a row, its weights are ones that SQL can draw too.
``order``     median or another quantile. Draws order statistics in place of pairs.
``vector``    any Python function of the vector of differences. Draws whole replicas where it is applied.
``paired``    any aggregate. Draws row positions that SQL can draw too. Means and quantiles draw them many
              at a time and look them up in the collapsed values. Of values too many for that, means send
              how often a replica takes each position to the ranges of the values; other aggregates
              and quantiles join every draw to the sorted values.

All randomness is a function of the seed and the data, never of the partitioning.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.digests import UNIFORM_BITS
from ..functions.significance import normal_two_sided_p
from ..session import cut_lineage
from .replica_state import MAX_VECTOR, PairedDraws, collapsed_counts, pairs_looked_up, quantiles_drawn, totals_dealt, vectors_drawn, weighted_means
from .ranks import (
    MAX_BROADCAST_ROWS,
    VALUES_PER_TASK,
    quantiles,
    range_offsets,
    stored_value_counts,
    with_ranges,
    with_rows_before,
)

METHODS = ("resample", "poisson", "order", "vector", "paired")

# Distinct values per task of the multinomial draw, and drawn counts held at a time.
VALUES_PER_PART = 10_000
DRAWN_AT_ONCE = 2_000_000

# Replicas that one task shares out over the value parts, and shares held at a time.
REPLICAS_PER_BLOCK = 250
SHARES_AT_ONCE = 20_000_000

# Draws per task, and the most tasks that a stage is cut into.
DRAWS_PER_TASK = 1_000_000
MAX_TASKS = 10_000

# Draws of a group that one step makes: what it holds of them fits the cache of a core.
DRAWS_PER_CHUNK = 32_768

# Weights by key that one task draws, and the most draws per row that are drawn by steps of their distribution.
WEIGHTS_PER_TASK = 4_000_000
MAX_POISSON_RATE = 20.0

# Rows written by one step of turning a repeated value into positions.
POSITIONS_PER_CHUNK = 8_192


def uniform(*parts: Column | int | str) -> Column:
    """A number in (0, 1) from the text of ``parts``, 52 bits of it."""
    texts = [p.cast("string") if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    digits = F.substring(F.md5(F.concat_ws("|", *texts)), 1, UNIFORM_BITS // 4)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / F.lit(float(2**UNIFORM_BITS))


def poisson_thresholds(rate: float) -> list[float]:
    """Cumulative probabilities of Poisson(rate), up to the resolution of ``uniform``."""
    if rate > MAX_POISSON_RATE:
        raise ValueError(f"{rate:.1f} draws per row: leave out the key or use method='resample'")
    probability, total, k, out = math.exp(-rate), 0.0, 0, []
    while k < rate or probability > 2.0**-UNIFORM_BITS:
        total += probability
        out.append(total)
        k += 1
        probability *= rate / k
    return out


def _group_sizes(known: DataFrame, group: str, labels: tuple[str, str], rows: Column | None = None) -> dict[str, int]:
    """Rows of each of the two groups, or the sum of ``rows``; two rows come to the driver."""
    counted = known.groupBy(group).agg((F.count("*") if rows is None else F.sum(rows)).alias("n")).collect()
    return {label: 0 for label in labels} | {r[0]: r[1] for r in counted}


def _draw_counts(sizes: dict[str, int], draws: str) -> dict[str, int]:
    if draws not in ("max", "own"):
        raise ValueError("draws is 'max' or 'own'")
    return {label: max(sizes.values()) if draws == "max" else n for label, n in sizes.items()}


def bootstrap_replicas(
    df: DataFrame,
    group: str,
    value: str,
    labels: tuple[str, str],
    replicas: int = 1000,
    method: str = "resample",
    statistic: str | float | Callable = "mean",
    draws: str = "max",
    seed: int = 0,
    key: str | None = None,
) -> DataFrame:
    """``(replica, stat)``: the statistic of first minus second group, once per replica.

    ``draws='max'`` draws as many values from each group as the larger one has; ``'own'`` draws
    the size of the group (for ``resample`` and ``poisson``). Statistics are ``'mean'``, ``'median'``, a
    probability for its quantile, or a callable: for ``paired`` it builds an aggregate column from the column
    of differences, for ``vector`` it turns an array of differences into a number. Rows without a value
    (NULL or NaN) are left out. ``key`` is a unique row key for ``poisson``. ``order`` becomes ``paired`` and ``vector`` is refused where the groups have too
    many distinct values to be sent to every task.
    """
    if method not in METHODS:
        raise ValueError(f"method is one of {METHODS}")
    probability = 0.5 if statistic == "median" else statistic
    fits = {
        "order": isinstance(probability, float) and 0 <= probability <= 1,
        "vector": callable(statistic),
        "paired": statistic == "mean" or callable(statistic) or isinstance(probability, float) and 0 <= probability <= 1,
    }
    if not fits.get(method, statistic == "mean"):
        raise ValueError(f"method={method!r} does not take the statistic {statistic!r}")
    if key is not None and method != "poisson":
        raise ValueError("only method='poisson' takes the key of a row")
    if method in fits and draws != "max":
        raise ValueError("pairs need the same number of draws from both groups")
    known = df.filter(F.col(group).isin(*labels)).dropna(subset=[value])
    # Ways that need the collapsed values read the data once, for them alone.
    counts = stored_value_counts(known, [group], value) if method in fits else None
    sizes = _group_sizes(known, group, labels) if counts is None else _group_sizes(counts, group, labels, F.col("n"))
    drawn = _draw_counts(sizes, draws)
    if method == "poisson":
        rates = {label: drawn[label] / sizes[label] if sizes[label] else 1.0 for label in labels}
        by = weighted_means if key is None else _means_by_key
        keyed = {} if key is None else {"key": key}
        return _difference(by(known, group, value, labels, replicas, rates, seed, **keyed), group, labels)
    if method == "resample":
        return _resample_replicas(known, group, value, labels, replicas, sizes, drawn, seed)
    both = None if callable(statistic) and method == "paired" else collapsed_counts(counts, group, labels)
    pairs = drawn[labels[0]]
    if method == "order" and both is not None:
        return quantiles_drawn(known, both, replicas, pairs, probability, seed)
    if method == "vector":
        if both is None:
            raise ValueError("too many distinct values; give the statistic as an aggregate column to method='paired'")
        return vectors_drawn(known, both, replicas, pairs, statistic, seed)
    if method == "paired" and not callable(statistic) and all(sizes.values()):
        paired = PairedDraws(seed, labels, tuple(sizes[x] for x in labels), pairs, DRAWS_PER_CHUNK)
        tasks = min(MAX_TASKS, replicas, max(1, -(-replicas * pairs // DRAWS_PER_TASK)))
        if both is not None and (statistic == "mean" or pairs <= MAX_VECTOR):
            return pairs_looked_up(known.sparkSession, paired, both, replicas, tasks, None if statistic == "mean" else probability)
        if statistic == "mean":
            totals = totals_dealt(_positions_of(counts, group), paired, group, replicas, tasks)
            means = totals.select("replica", group, (F.col("total") / pairs).alias("mean"))
            return _difference(means, group, labels)
    return _paired_replicas(_positions_of(counts, group), group, labels, replicas, sizes, drawn, seed, statistic)


def _difference(means: DataFrame, group: str, labels: tuple[str, str]) -> DataFrame:
    """``(replica, group, mean)`` to ``(replica, stat)``."""
    of = lambda label: F.max(F.when(F.col(group) == label, F.col("mean")))
    return means.groupBy("replica").agg((of(labels[0]) - of(labels[1])).alias("stat"))


def _means_by_key(df, group, value, labels, replicas, rates, seed, key) -> DataFrame:
    """``(replica, <group>, mean)`` under Poisson weights that are a function of seed, key and replica. Weights are
    added up where they are drawn: a task sends two numbers per replica and group."""
    weight = F.lit(0)
    for label in labels:
        steps = [F.when(F.col("u") >= t, 1).otherwise(0) for t in poisson_thresholds(rates[label])]
        weight = F.when(F.col(group) == label, reduce(lambda a, b: a + b, steps)).otherwise(weight)
    rows = cut_lineage(df.select(group, F.col(value).cast("double").alias("x"), F.col(key).alias("key")))
    tasks = min(MAX_TASKS, max(1, -(-rows.count() * replicas // WEIGHTS_PER_TASK)))
    numbers = F.sequence(F.lit(0).cast("long"), F.lit(replicas - 1).cast("long"))
    return (
        rows.repartition(tasks, "key")
        .withColumn("replica", F.explode(numbers))
        .withColumn("u", uniform(seed, F.col("key"), F.col("replica")))
        .withColumn("w", weight.cast("long"))
        .groupBy("replica", group)
        .agg(F.sum(F.col("w") * F.col("x")).alias("total"), F.sum("w").alias("weight"))
        .select("replica", group, F.try_divide("total", F.col("weight").cast("double")).alias("mean"))
    )


def _resample_replicas(df, group, value, labels, replicas, sizes, drawn, seed) -> DataFrame:
    counts = stored_value_counts(df, [group], value)
    n_parts = max(1, -(-counts.count() // VALUES_PER_PART))
    parted = counts.withColumn("part", F.pmod(F.xxhash64("value"), F.lit(n_parts)))
    # Few bytes but much arithmetic: a stated number of tasks keeps adaptive execution from merging
    # them by size.
    draw_tasks = min(MAX_TASKS, len(labels) * n_parts)

    per_block = max(1, min(REPLICAS_PER_BLOCK, SHARES_AT_ONCE // n_parts))
    n_blocks = -(-replicas // per_block)
    part_sizes = (
        parted.groupBy(group, "part")
        .agg(F.sum("n").alias("n"))
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
    )

    def share_out(pdf: pd.DataFrame) -> pd.DataFrame:
        """How many draws of each replica of one block fall into each part."""
        pdf = pdf.sort_values("part")
        label, block = pdf[group].iloc[0], int(pdf["block"].iloc[0])
        size = min(per_block, replicas - block * per_block)
        rng = np.random.default_rng([seed, labels.index(label), block])
        share = pdf["n"].to_numpy() / pdf["n"].sum()
        out = rng.multinomial(drawn[label], share, size=size)
        return pdf[[group, "part", "block"]].assign(draws=list(out.T))

    shared = (
        part_sizes.repartition(min(MAX_TASKS, len(labels) * n_blocks), group, "block")
        .groupBy(group, "block")
        .applyInPandas(share_out, f"{group} string, part long, block long, draws array<long>")
    )

    def draw_values(values: pd.DataFrame, blocks: pd.DataFrame) -> pd.DataFrame:
        """Sum of the values drawn from one part, per replica."""
        values, blocks = values.sort_values("value"), blocks.sort_values("block")
        label, part = values[group].iloc[0], int(values["part"].iloc[0])
        rng = np.random.default_rng([seed, labels.index(label), part, n_blocks])
        share = values["n"].to_numpy() / values["n"].sum()
        x = values["value"].to_numpy()
        n_draws = np.concatenate([np.asarray(d, dtype="int64") for d in blocks["draws"]])
        step = max(1, DRAWN_AT_ONCE // len(x))
        sums = [
            rng.multinomial(n_draws[i : i + step], share) @ x for i in range(0, len(n_draws), step)
        ]
        return pd.DataFrame(
            {group: label, "replica": np.arange(len(n_draws)), "part": part, "total": np.concatenate(sums)}
        )

    totals = (
        parted.repartition(draw_tasks, group, "part")
        .groupBy(group, "part")
        .cogroup(shared.repartition(draw_tasks, group, "part").groupBy(group, "part"))
        .applyInPandas(draw_values, f"{group} string, replica long, part long, total double")
    )
    n_draws = F.when(F.col(group) == labels[0], float(drawn[labels[0]])).otherwise(float(drawn[labels[1]]))
    sums = totals.groupBy("replica", group).agg(F.sum("total").alias("total"))
    means = sums.select("replica", group, F.try_divide("total", n_draws).alias("mean"))
    return _difference(means, group, labels)


def value_positions(df: DataFrame, group: str, value: str) -> DataFrame:
    """``(group, position, value)``: the values of each group in ascending order, numbered from 0.

    A value that occurs very often is cut into chunks of positions, which are spread over tasks
    before they are written out.
    """
    return _positions_of(stored_value_counts(df, [group], value), group)


def _positions_of(counts: DataFrame, group: str) -> DataFrame:
    """``value_positions`` from stored value counts."""
    ranged = with_ranges(counts)
    ranked = with_rows_before(ranged, range_offsets(ranged, [group]), [group])
    chunk = F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / POSITIONS_PER_CHUNK)))
    first = F.col("chunk") * POSITIONS_PER_CHUNK
    last = F.least(first + POSITIONS_PER_CHUNK, F.col("n")) - 1
    return (
        ranked.select(group, "value", "rows_before", "n", chunk.alias("chunk"))
        .repartition(group, "value", "chunk")
        .withColumn("position", F.explode(F.sequence(F.col("rows_before") + first, F.col("rows_before") + last)))
        .select(group, "position", "value")
    )


def _position(label: str, seed: int, replica: Column, i: Column, size: int) -> Column:
    """The row of its group that a draw takes."""
    return F.least(F.floor(uniform(seed, label, replica, i) * size), F.lit(size - 1))


def _paired_replicas(positions, group, labels, replicas, sizes, drawn, seed, statistic) -> DataFrame:
    n_pairs = drawn[labels[0]]
    spark = positions.sparkSession
    rows = replicas * n_pairs
    grid = spark.range(0, rows, 1, min(MAX_TASKS, max(1, -(-rows // DRAWS_PER_TASK)))).select(
        F.floor(F.col("id") / max(n_pairs, 1)).alias("replica"), (F.col("id") % max(n_pairs, 1)).alias("i")
    )
    for label in labels:
        at = _position(label, seed, F.col("replica"), F.col("i"), sizes[label]).alias("position")
        values = positions.filter(F.col(group) == label).select("position", F.col("value").alias(f"x_{label}"))
        # A small group has few positions, each drawn very often: it is broadcast, never shuffled to.
        values = F.broadcast(values) if sizes[label] <= MAX_BROADCAST_ROWS else values
        grid = grid.select("*", at).join(values, "position").drop("position")
    pairs = grid.select("replica", (F.col(f"x_{labels[0]}") - F.col(f"x_{labels[1]}")).alias("diff"))
    if statistic == "mean":
        return pairs.groupBy("replica").agg(F.avg("diff").alias("stat"))
    if statistic == "median" or isinstance(statistic, float):
        probability = 0.5 if statistic == "median" else statistic
        return quantiles(pairs, ["replica"], "diff", [probability], VALUES_PER_TASK).select(
            "replica", F.col("quantiles")[0].alias("stat")
        )
    return pairs.groupBy("replica").agg(statistic(F.col("diff")).alias("stat"))


def summarise_replicas(replicas: DataFrame, level: float = 0.95) -> DataFrame:
    """One row: number of replicas, mean, population sigma, percentile interval, z and the
    normal-approximation p-value. Input is one row per replica, so the percentile is small."""
    tail = (1.0 - level) / 2.0
    limits = F.percentile("stat", F.array(F.lit(tail), F.lit(1.0 - tail)))
    return (
        replicas.agg(
            F.count("stat").alias("replicas"),
            F.avg("stat").alias("mean"),
            F.stddev_pop("stat").alias("sigma"),
            limits.alias("limits"),
        )
        .select(
            "replicas",
            "mean",
            "sigma",
            F.col("limits")[0].alias("ci_low"),
            F.col("limits")[1].alias("ci_high"),
            F.try_divide(F.col("mean"), F.col("sigma")).alias("z"),
        )
        .withColumn("p_value", normal_two_sided_p("mean", "sigma"))
    )


def bootstrap_test(
    df: DataFrame, group: str, value: str, labels: tuple[str, str], level: float = 0.95, **options
) -> DataFrame:
    """Interval and p-value of the difference between two groups; options as for
    ``bootstrap_replicas``."""
    return summarise_replicas(bootstrap_replicas(df, group, value, labels, **options), level)
