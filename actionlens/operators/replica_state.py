"""Bootstrap replicas without a row per draw.

``weighted_means``  Poisson weights. Each task holds, for every replica, a weighted sum and the sum of weights
                    of the values it has seen: a state of fixed size that merges by adding. What is
                    shuffled depends on the number of tasks and replicas, not on the rows.
``quantiles_drawn`` A quantile of the paired differences. Of M independent draws the k-th smallest lies where a
                    Beta(k, M - k + 1) variable says within the distribution they are drawn from, so two
                    random numbers a replica take the place of M pairs.
``vectors_drawn``   Any function of the vector of paired differences. Every task draws whole replicas from
                    the collapsed values; nothing is shuffled.
``PairedDraws``     Pairs of positions that SQL can draw too, made a few ten thousand at a time where they are used.
``pairs_looked_up`` Mean or quantile of such pairs. Whole replicas lie in one task, which looks positions up
                    in the collapsed values; nothing is shuffled.
``totals_dealt``    Sums over such draws where values are too many to be sent to every task. The task that
                    draws a replica counts how often it takes each position, and sends the counts, a byte or
                    two each, by ranges of positions to where the values of the range are.

Draws depend on the seed and on values or replica numbers, never on the partitioning.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import groupby, islice
from operator import itemgetter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.digests import uniforms
from ..session import cut_lineage
from .ranks import value_counts

# Weights that one task draws, and the most tasks, each of which sends a state.
WEIGHTS_PER_TASK = 4_000_000
MAX_STATES = 2_048
# Distinct values of both groups that may be sent to every task.
MAX_VALUES = 1_000_000
# Replicas that a task draws at a time, and differences that it sorts at a time.
REPLICAS_PER_TASK = 250
DIFFERENCES_AT_ONCE = 2_000_000
# Pairs of one replica that a task may hold as a vector, and rows of a group up to which it holds them all.
MAX_VECTOR = 1 << 26
MAX_EXPANDED = 1 << 22
# Positions of one range, positions of a group up to which a task counts its draws of each, draws that it packs at
# a time beyond that, and draws that are held beside one range.
POSITIONS_PER_RANGE = 1 << 16
MAX_COUNTED = 1 << 26
PACKED_AT_ONCE = 1 << 22
DRAWS_PER_RANGE = 1 << 24
MAX_RANGE_TASKS = 10_000
# Draws of a position on average up to which counts of one byte are tried first.
DRAWS_PER_BYTE = 16


def _generator(*key: int) -> np.random.Generator:
    """Random numbers that belong to two numbers."""
    return np.random.Generator(np.random.Philox(key=np.array([k & ((1 << 64) - 1) for k in key], np.uint64)))


def weighted_means(df: DataFrame, group: str, value: str, labels: tuple[str, str], replicas: int, rates: dict[str, float], seed: int) -> DataFrame:
    """``(replica, <group>, mean)``: means under Poisson weights with ``rates`` draws per row on average.

    Rows of equal value are collapsed first: the weights of n rows add up to one Poisson variable of n times
    the rate. A replica in which a group gets no weight at all has no mean there.
    """
    counts = cut_lineage(value_counts(df, [group], value))
    tasks = min(MAX_STATES, max(1, -(-counts.count() * replicas // WEIGHTS_PER_TASK)))
    kind = counts.schema[group].dataType

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states = {label: np.zeros((2, replicas)) for label in labels}
        for batch in batches:
            bits = batch.column("value").to_numpy().view(np.int64).tolist()
            for label, x, bit, n in zip(*(batch.column(c).to_pylist() for c in (group, "value")), bits, batch.column("n").to_pylist()):
                weights = _generator(bit, (seed << 1) + labels.index(label)).poisson(n * rates[label], replicas)
                states[label][0] += weights * x
                states[label][1] += weights
        for label, (total, weight) in states.items():
            if weight.any():
                yield pa.RecordBatch.from_arrays([pa.array([label] * replicas), pa.array(np.arange(replicas)), pa.array(total), pa.array(weight)], names=[group, "replica", "total", "weight"])

    # Few bytes but much arithmetic: a stated number of tasks keeps adaptive execution from merging them.
    states = counts.repartition(tasks, group, "value").mapInArrow(add_up, f"{group} {kind.simpleString()}, replica long, total double, weight double")
    merged = states.groupBy("replica", group).agg(F.sum("total").alias("total"), F.sum("weight").alias("weight"))
    return merged.select("replica", group, F.try_divide("total", "weight").alias("mean"))


class Collapsed:
    """Distinct values of both groups in ascending order, with the rows up to each."""

    def __init__(self, values: dict[str, np.ndarray], rows: dict[str, np.ndarray], labels: tuple[str, str]):
        (self.first, self.second), (first, second) = ([values[x] for x in labels], [rows[x] for x in labels])
        self.first_up_to, self.second_rows = np.concatenate([[0], np.cumsum(first)]), second
        self.second_up_to = np.concatenate([[0], np.cumsum(second)])
        self.pairs = float(self.first_up_to[-1]) * float(self.second_up_to[-1])

    def _reach(self, difference: float) -> np.ndarray:
        """For each value of the second group, how many values of the first exceed it by no more."""
        return np.searchsorted(self.first, difference + self.second, "right")

    def _share(self, reach: np.ndarray) -> float:
        return float(self.first_up_to[reach].astype(float) @ self.second_rows) / self.pairs

    def share_up_to(self, difference: float) -> float:
        """Share of all pairs that differ by no more."""
        return self._share(self._reach(difference))

    def difference_quantiles(self, shares: np.ndarray) -> np.ndarray:
        """For each of the ascending ``shares``, the smallest difference (a value of the first group less one
        of the second) that at least this share of all pairs does not exceed."""
        low, high = self.first[0] - self.second[-1], self.first[-1] - self.second[0]
        below, above = np.zeros(len(self.second), np.int64), np.full(len(self.second), len(self.first))
        while (above - below).sum() > DIFFERENCES_AT_ONCE:
            middle = low + (high - low) / 2
            if not low < middle < high:
                break  # the pairs in between all have one difference
            reach = self._reach(middle)
            share = self._share(reach)
            if share < shares[0]:
                low, below = middle, np.maximum(below, reach)
            elif share >= shares[-1]:
                high, above = middle, np.minimum(above, reach)
            else:
                cut = int(np.searchsorted(shares, share, "right"))
                return np.concatenate([self.difference_quantiles(shares[:cut]), self.difference_quantiles(shares[cut:])])
        counts = above - below
        starts = np.cumsum(counts) - counts
        first = np.repeat(below - starts, counts) + np.arange(counts.sum())
        second = np.repeat(np.arange(len(self.second)), counts)
        differences = self.first[first] - self.second[second]
        weights = np.diff(self.first_up_to)[first].astype(float) * self.second_rows[second]
        order = np.argsort(differences, kind="stable")
        shares_up_to = (self.first_up_to[below].astype(float) @ self.second_rows + np.cumsum(weights[order])) / self.pairs
        at = np.searchsorted(shares_up_to, shares - 1e-15)
        return differences[order][np.minimum(at, len(order) - 1)]

    def drawn(self, random: np.random.Generator, draws: int) -> np.ndarray:
        """Differences of ``draws`` pairs."""
        first, second = self.lookups()
        return first(random.integers(0, self.first_up_to[-1], draws)) - second(random.integers(0, self.second_up_to[-1], draws))

    def lookups(self) -> list[Callable[[np.ndarray], np.ndarray]]:
        """For each group, from positions among its rows in ascending order to their values."""
        return [_lookup(self.first, self.first_up_to), _lookup(self.second, self.second_up_to)]


def _lookup(values: np.ndarray, up_to: np.ndarray) -> Callable[[np.ndarray], np.ndarray]:
    if up_to[-1] <= MAX_EXPANDED:
        return np.repeat(values, np.diff(up_to)).take
    return lambda positions: values[np.searchsorted(up_to, positions, "right") - 1]


def collapsed(df: DataFrame, group: str, value: str, labels: tuple[str, str]) -> Collapsed | None:
    """The collapsed values of both groups on the driver, or None if they are more than ``MAX_VALUES``.
    A group may be empty."""
    return collapsed_counts(cut_lineage(value_counts(df, [group], value)), group, labels)


def collapsed_counts(counts: DataFrame, group: str, labels: tuple[str, str]) -> Collapsed | None:
    """``collapsed`` from stored value counts."""
    if counts.count() > MAX_VALUES:
        return None
    table = counts.toArrow()
    names, x, n = np.array(table[group].to_pylist(), object), table["value"].to_numpy(), table["n"].to_numpy()
    values, rows = {}, {}
    for label in labels:
        mine = names == label
        order = np.argsort(x[mine])
        values[label], rows[label] = x[mine][order], n[mine][order]
    return Collapsed(values, rows, labels)


def _per_replica(df: DataFrame, both: Collapsed, replicas: int, statistics: Callable[[Collapsed, list[int]], np.ndarray]) -> DataFrame:
    """``(replica, stat)``, by tasks of whole replicas; no statistic where a group is empty."""
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast(both)

    def draw(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            numbers = batch.column("id").to_pylist()
            if numbers and shared.value.pairs:
                found = pa.array(np.asarray(statistics(shared.value, numbers), float))
            else:
                found = pa.nulls(len(numbers), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("id"), found], names=["replica", "stat"])

    return spark.range(0, replicas, 1, max(1, -(-replicas // REPLICAS_PER_TASK))).mapInArrow(draw, "replica long, stat double")


def quantiles_drawn(df: DataFrame, both: Collapsed, replicas: int, draws: int, probability: float, seed: int) -> DataFrame:
    """``(replica, stat)``: the interpolated quantile of ``draws`` paired differences."""
    position = (draws - 1) * probability
    k, part = int(position) + 1, position - int(position)

    def statistics(both: Collapsed, numbers: list[int]) -> np.ndarray:
        shares = np.empty((len(numbers), 2))
        for i, number in enumerate(numbers):
            random = _generator(seed, number)
            shares[i, 0] = random.beta(k, draws - k + 1)
            # The next one in order is the smallest of the rest, which lie above.
            shares[i, 1] = shares[i, 0] + (1 - shares[i, 0]) * random.beta(1, draws - k) if part else shares[i, 0]
        flat, back = np.unique(shares, return_inverse=True)
        found = both.difference_quantiles(flat)[back].reshape(shares.shape)
        return (1 - part) * found[:, 0] + part * found[:, 1]

    return _per_replica(df, both, replicas, statistics)


def vectors_drawn(df: DataFrame, both: Collapsed, replicas: int, draws: int, statistic: Callable[[np.ndarray], float], seed: int) -> DataFrame:
    """``(replica, stat)``: ``statistic`` of the vector of ``draws`` paired differences."""
    if draws > MAX_VECTOR:
        raise ValueError(f"{draws} pairs are too many for one vector; give the statistic as an aggregate column")

    def statistics(both: Collapsed, numbers: list[int]) -> list[float]:
        return [float(statistic(both.drawn(_generator(seed, number), draws))) for number in numbers]

    return _per_replica(df, both, replicas, statistics)


@dataclass(frozen=True)
class PairedDraws:
    """``pairs`` draws with replacement from each of two groups, for each replica; ``at_once`` are made at a time."""

    seed: int
    labels: tuple[str, str]
    sizes: tuple[int, int]
    pairs: int
    at_once: int

    def positions(self, replicas: Iterable[int]) -> Iterator[tuple[list[int], list[np.ndarray]]]:
        """For both groups, the positions by replica and draw: of whole replicas, as many as are made at a time, or
        of one replica, the first draws first."""
        for _, of_length in groupby(replicas, key=lambda replica: len(str(replica))):
            while numbers := list(islice(of_length, max(1, self.at_once // self.pairs))):
                for start in range(0, self.pairs, self.at_once):
                    stop = min(start + self.at_once, self.pairs)
                    yield numbers, [self._positions(label, numbers, start, stop, n) for label, n in zip(self.labels, self.sizes)]

    def _positions(self, label: str, replicas: list[int], start: int, stop: int, size: int) -> np.ndarray:
        drawn = (uniforms([f"{self.seed}|{label}|{replica}|" for replica in replicas], start, stop) * size).astype(np.int64)
        return np.minimum(drawn, size - 1, out=drawn)


def _replicas(spark: SparkSession, replicas: int, tasks: int) -> DataFrame:
    return spark.range(0, replicas, 1, tasks).withColumnRenamed("id", "replica")


def pairs_looked_up(spark: SparkSession, draws: PairedDraws, both: Collapsed, replicas: int, tasks: int, probability: float | None) -> DataFrame:
    """``(replica, stat)``: the mean, or the interpolated quantile, of the differences of each replica."""
    shared = spark.sparkContext.broadcast(both)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, second = shared.value.lookups()
        for batch in batches:
            for numbers, pieces in groupby(draws.positions(batch.column("replica").to_pylist()), key=itemgetter(0)):
                differences = (first(a) - second(b) for _, (a, b) in pieces)
                if probability is None:
                    found = sum(d.sum(axis=1) for d in differences) / draws.pairs
                else:
                    found = np.quantile(np.concatenate(list(differences), axis=1), probability, axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(numbers), pa.array(found)], names=["replica", "stat"])

    return _replicas(spark, replicas, tasks).mapInArrow(look_up, "replica long, stat double")


def _counts_of(times: np.ndarray) -> tuple[str, bytes]:
    form = "<u1" if times.max() < 1 << 8 else "<u4" if times.max() < 1 << 32 else "<u8"
    return form, times.astype(form).tobytes()


def _packed(positions: np.ndarray, width: int) -> Iterator[tuple[int, str, bytes]]:
    """``(range, form, bytes)`` of drawn positions: times drawn for each position of the range in a number of
    one byte or more, or, of few draws, the position within the range of each."""
    numbers, offsets = np.divmod(np.sort(positions), width)
    starts = np.flatnonzero(np.diff(numbers, prepend=-1))
    for start, end in zip(starts, [*starts[1:], len(numbers)]):
        of_range = offsets[start:end]
        if 2 * len(of_range) <= of_range[-1]:
            yield int(numbers[start]), "offsets", of_range.astype("<u2").tobytes()
        else:
            yield int(numbers[start]), *_counts_of(np.bincount(of_range))


def _counted(draws: PairedDraws, replica: int) -> list[np.ndarray]:
    """How often a replica draws each position of both groups."""
    few = all(draws.pairs <= DRAWS_PER_BYTE * n for n in draws.sizes)
    for kind in (np.uint8, np.uint64) if few else (np.uint64,):
        times = [np.zeros(n, kind) for n in draws.sizes]
        for _, piece in draws.positions([replica]):
            for counts, positions in zip(times, piece):
                np.add.at(counts, positions[0], kind(1))
        # A count that went over its byte is missing in the sum.
        if all(int(counts.sum(dtype=np.int64)) == draws.pairs for counts in times):
            break
    return times


def _packed_replica(draws: PairedDraws, replica: int, width: int) -> Iterator[tuple[str, list[tuple[int, str, bytes]]]]:
    """The label of a group and ``(range, form, bytes)`` of its draws, in one or more steps."""
    if max(draws.sizes) <= MAX_COUNTED:
        for label, times in zip(draws.labels, _counted(draws, replica)):
            ranges = (times[start : start + width] for start in range(0, len(times), width))
            yield label, [(k, *_counts_of(counts)) for k, counts in enumerate(ranges) if counts.any()]
        return
    held, n, left = [], 0, draws.pairs
    for _, (first, second) in draws.positions([replica]):
        held.append((first[0], second[0]))
        n += first.size
        left -= first.size
        if n >= PACKED_AT_ONCE or not left:
            for label, positions in zip(draws.labels, zip(*held)):
                yield label, list(_packed(np.concatenate(positions), width))
            held, n = [], 0


def _total(values: np.ndarray, form: str, packed: bytes) -> float:
    if form == "offsets":
        return float(values[np.frombuffer(packed, "<u2")].sum())
    times = np.frombuffer(packed, form)
    return float(times @ values[: len(times)])


def totals_dealt(values: DataFrame, draws: PairedDraws, group: str, replicas: int, tasks: int) -> DataFrame:
    """``(replica, <group>, total)``: the sum of the drawn values. ``values`` is ``(<group>, position, value)``."""
    width, labels = POSITIONS_PER_RANGE, draws.labels
    ranges = {x: -(-n // width) for x, n in zip(labels, draws.sizes)}
    # Replicas whose draws from one range are held at a time, for each group.
    blocks = {x: max(1, min(REPLICAS_PER_TASK, DRAWS_PER_RANGE * n // draws.pairs)) for x, n in ranges.items()}

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for replica in batch.column("replica").to_pylist():
                for label, packed in _packed_replica(draws, replica, width):
                    numbers, forms, parts = zip(*packed)
                    k = len(numbers)
                    columns = [[label] * k, numbers, [replica // blocks[label]] * k, [replica] * k, forms, parts]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[group, "range", "block", "replica", "form", "packed"])

    def in_order(values: pd.DataFrame) -> pd.DataFrame:
        x = values.sort_values("position")["value"].to_numpy()
        return values[[group, "range"]].iloc[:1].assign(held=[x.astype("<f8").tobytes()])

    def add_up(values: pd.DataFrame, draws: pd.DataFrame) -> pd.DataFrame:
        x = np.frombuffer(values["held"].iloc[0], "<f8")
        totals = [_total(x, form, packed) for form, packed in zip(draws["form"], draws["packed"])]
        return draws[["replica", group]].assign(total=np.array(totals, float))

    kind = values.schema[group].dataType.simpleString()
    first_last, second_last = (F.lit((replicas - 1) // blocks[x]).cast("long") for x in labels)
    numbers = F.sequence(F.lit(0).cast("long"), F.when(F.col(group) == labels[0], first_last).otherwise(second_last))
    ranged = values.select(group, F.floor(F.col("position") / width).alias("range"), "position", "value")
    # Few keys but much to add: a stated number of tasks keeps adaptive execution from merging them by size.
    packed_values = (
        ranged.repartition(min(MAX_RANGE_TASKS, sum(ranges.values())), group, "range")
        .groupBy(group, "range")
        .applyInPandas(in_order, f"{group} {kind}, range long, held binary")
    )
    repeated = packed_values.select(group, "range", "held", F.explode(numbers).alias("block"))
    packed = _replicas(values.sparkSession, replicas, tasks).mapInArrow(pack, f"{group} {kind}, range long, block long, replica long, form string, packed binary")
    keys = sum(n * -(-replicas // blocks[x]) for x, n in ranges.items())
    by = (min(MAX_RANGE_TASKS, keys), group, "range", "block")
    totals = (
        repeated.repartition(*by)
        .groupBy(*by[1:])
        .cogroup(packed.repartition(*by).groupBy(*by[1:]))
        .applyInPandas(add_up, f"replica long, {group} {kind}, total double")
    )
    return totals.groupBy("replica", group).agg(F.sum("total").alias("total"))
