"""Hard negatives of anchors by lists that the anchors of a cluster share.

Anchors are clustered by angle. Where the candidates are, each task sorts its rows once per cluster by
what a member can score with them at most: a row's norm times the cosine of its angle to the centroid, less
the widest angle of a member. Every member walks that list from the top and stops where no later row can
come into its result any more. The results of tasks are merged by anchor.

Candidates are never moved. Anchors are sent to them in rounds of bounded size, so memory is bounded
and the rows are read twice a round: for the positives, then for the negatives, whose limits the
positives' scores set. All scores are whole numbers and exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import cut_lineage

SCALE = 256
POSITIVES, NEGATIVES = 5, 5
# A negative scores at least 80 and at most 100 hundredths of its positive.
FLOOR_PERCENT, CEILING_PERCENT = 80, 100
# Bytes of anchor vectors in one round, and members of a cluster on average.
ROUND_BYTES = 16 << 20
MEMBERS = 64
# Rows of candidates that are sorted together, and rows that a walk takes at first.
LIST_BYTES = 16 << 20
FIRST_STEP, LONGEST_STEP = 256, 4096
_SEED = 13
_EXACT = float(1 << 53)
_LOWEST, _HIGHEST = -(1 << 63), (1 << 63) - 1


def usable(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", label: str = "label") -> DataFrame:
    """``(vec_id, label, vector)``: rows with an id, a label and a vector of finite numbers without nulls."""
    rows = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), F.col(column).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return rows.where("vec_id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL").where(finite)


def whole(vectors: np.ndarray) -> np.ndarray:
    """Components as whole numbers, in doubles; beyond the largest double they stay there."""
    with np.errstate(over="ignore"):
        return np.nan_to_num(np.floor(SCALE * vectors))


def products(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products of whole vectors as 64-bit numbers. Doubles are exact as long as every sum is
    below 2^53; larger components are multiplied as Python numbers. A product that 64 bits do not hold
    becomes the nearest number that they do."""
    if not anchors.size or not rows.size:
        return np.zeros((len(anchors), len(rows)), np.int64)
    if float(np.abs(anchors).max()) * float(np.abs(rows).max()) * anchors.shape[1] < _EXACT:
        return (anchors @ rows.T).astype(np.int64)
    exact = lambda x: np.array([[int(v) for v in row] for row in x], object)
    return np.clip(exact(anchors) @ exact(rows).T, _LOWEST, _HIGHEST).astype(np.int64)


def _largest(rows: np.ndarray) -> np.ndarray:
    largest = np.abs(rows).max(1, initial=0)[:, None]
    return np.where(largest > 0, largest, 1)


def _norms(rows: np.ndarray) -> np.ndarray:
    largest = _largest(rows)
    with np.errstate(over="ignore"):
        return largest[:, 0] * np.sqrt(((rows / largest) ** 2).sum(1))


def _units(rows: np.ndarray) -> np.ndarray:
    scaled = rows / _largest(rows)
    norms = np.sqrt((scaled * scaled).sum(1))[:, None]
    return np.divide(scaled, norms, out=np.zeros_like(scaled), where=norms > 0)


def cluster(vectors: np.ndarray, clusters: int, rounds: int = 6, seed: int = _SEED) -> tuple[np.ndarray, np.ndarray]:
    """Unit centroids and the cluster of each row, by spherical k-means."""
    units = _units(vectors)
    centroids = units[np.random.default_rng(seed).permutation(len(units))[:clusters]]
    for _ in range(rounds):
        nearest = (units @ centroids.T).argmax(1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, units)
        full = _norms(sums) > 0
        centroids[full] = _units(sums[full])
    return centroids, (units @ centroids.T).argmax(1)


@dataclass
class Askers:
    """What is asked for: by asker, its anchor, and the lowest and highest score that counts."""

    anchor: np.ndarray
    floor: np.ndarray
    ceiling: np.ndarray


@dataclass
class Round:
    """Anchors of one vector length, by cluster, and what they ask."""

    ids: np.ndarray
    labels: np.ndarray
    vectors: np.ndarray
    same_label: bool
    askers: Askers
    nearest: int

    def __post_init__(self):
        self.norms = _norms(self.vectors)
        self.centroids, of = cluster(self.vectors, max(1, len(self.ids) // MEMBERS))
        cosines = (_units(self.vectors) * self.centroids[of]).sum(1)
        # A zero vector scores zero with everything, at any angle.
        angles = np.where(self.norms > 0, np.arccos(np.clip(cosines, -1, 1)), 0)
        self.members = [np.flatnonzero(of == c) for c in range(len(self.centroids))]
        self.widest = np.array([angles[m].max(initial=0) for m in self.members])
        asked_by = np.argsort(self.askers.anchor, kind="stable")
        ends = np.searchsorted(self.askers.anchor[asked_by], np.arange(len(self.ids) + 1))
        self.asked = [asked_by[a:b] for a, b in zip(ends[:-1], ends[1:])]

    def found_in(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(asker, id, score)`` of the best rows of a list for every asker."""
        norms, units, parts = _norms(vectors), _units(vectors), []
        for c, centroid in enumerate(self.centroids):
            if len(self.members[c]):
                angles = np.arccos(np.clip(units @ centroid, -1, 1))
                bound = norms * np.cos(np.maximum(0, angles - self.widest[c]))
                parts.append(self._walk(c, ids, labels, vectors, np.where(np.isnan(bound), np.inf, bound)))
        return tuple(map(np.concatenate, zip(*parts)))

    def _walk(self, c: int, ids, labels, vectors, bound) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Walk the list of one cluster in descending order of ``bound`` until every member is certain."""
        order = np.argsort(-bound, kind="stable")
        bound = bound[order]
        askers = np.concatenate([self.asked[m] for m in self.members[c]])
        floor, ceiling = self.askers.floor[askers], self.askers.ceiling[askers]
        anchor = self.askers.anchor[askers]
        # The score that a further row must reach: the lowest that counts, then the last one kept.
        least = floor.copy()
        kept = [np.empty(0, np.int64)] * 3
        # A little more than a score can exceed its bound by rounding.
        norms = self.norms[anchor]
        with np.errstate(invalid="ignore", over="ignore"):
            slack = 0.5 + 1e-9 * norms * (np.abs(bound).max(initial=0) + 1)
        at, step = 0, FIRST_STEP
        open_askers = np.flatnonzero(floor <= ceiling)
        while at < len(order):
            # Beyond all numbers nothing is certain.
            with np.errstate(invalid="ignore", over="ignore"):
                open_askers = open_askers[~(norms[open_askers] * bound[at] + slack[open_askers] < least[open_askers])]
            if not len(open_askers):
                break
            rows = order[at : at + step]
            asking, of = np.unique(anchor[open_askers], return_inverse=True)
            scores = products(self.vectors[asking], vectors[rows])
            allowed = (self.labels[asking][:, None] == labels[rows]) == self.same_label
            allowed &= self.ids[asking][:, None] != ids[rows]
            scores, allowed = scores[of], allowed[of]
            hit = allowed & (scores >= least[open_askers][:, None]) & (scores <= ceiling[open_askers][:, None])
            who, where = np.nonzero(hit)
            kept = best_of(*(np.concatenate(x) for x in zip(kept, (open_askers[who], ids[rows[where]], scores[who, where]))), self.nearest)
            full = np.flatnonzero(np.bincount(kept[0], minlength=len(askers)) == self.nearest)
            last = np.searchsorted(kept[0], full, "right") - 1
            least[full] = kept[2][last]
            at, step = at + step, min(2 * step, LONGEST_STEP)
        return askers[kept[0]], kept[1], kept[2]


def best_of(asker: np.ndarray, ids: np.ndarray, scores: np.ndarray, nearest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``nearest`` highest scores of each asker, ties by smaller id, in order."""
    order = np.lexsort((ids, -scores, asker))
    asker, ids, scores = asker[order], ids[order], scores[order]
    heads = np.flatnonzero(np.append(True, asker[1:] != asker[:-1])) if len(asker) else np.empty(0, np.int64)
    rank = np.arange(len(asker)) - np.repeat(heads, np.diff(np.append(heads, len(asker))))
    best = rank < nearest
    return asker[best], ids[best], scores[best]


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _searched(vectors: DataFrame, size: int, asked: Round) -> DataFrame:
    """``(asker, vec_id, score)``: the best rows for every asker, of all ``vectors`` of this length."""
    shared = vectors.sparkSession.sparkContext.broadcast(asked)
    list_rows = max(FIRST_STEP, LIST_BYTES // (8 * max(size, 1)))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [np.empty(0, np.int64)] * 3
        held, rows = [], 0

        def taken():
            ids, labels = (np.concatenate([b.column(c).to_numpy() for b in held]) for c in ("vec_id", "label"))
            found = shared.value.found_in(ids, labels, whole(np.concatenate([_matrix(b.column("vector")) for b in held])))
            return best_of(*(np.concatenate(x) for x in zip(kept, found)), shared.value.nearest)

        for batch in batches:
            if batch.num_rows:
                held.append(batch)
                rows += batch.num_rows
            if rows >= list_rows:
                kept, held, rows = taken(), [], 0
        if held:
            kept = taken()
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in kept], names=["asker", "vec_id", "score"])

    found = vectors.where(F.size("vector") == size).mapInArrow(search, "asker long, vec_id long, score long")
    best = Window.partitionBy("asker").orderBy(F.col("score").desc(), "vec_id")
    return cut_lineage(found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= asked.nearest))


_FOUND = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mine(vectors: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, floor: int = FLOOR_PERCENT, ceiling: int = CEILING_PERCENT, round_bytes: int = ROUND_BYTES) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)`` for ``anchors``, one
    row for each id, against all ``vectors``, both ``(vec_id, label, vector)``.

    A row's score is the inner product of whole components. An anchor's positives are its best rows of
    the same label under another id, its negatives for a positive the best rows of other labels whose score
    is from ``floor`` to ``ceiling`` percent of the positive's; ties go to the smaller id, and rows of
    the same id are rows of their own. Only vectors of the same length are compared. A positive without
    such a row gives none, neither does one with a score below zero. Runs jobs: two for each round of
    anchors, whose results are stored.
    """
    spark = vectors.sparkSession
    out = []
    # A row for each length of vector.
    for size, asked in sorted((r["size"], r["rows"]) for r in anchors.groupBy(F.size("vector").alias("size")).agg(F.count("*").alias("rows")).collect()):
        rounds = -(-asked * 8 * max(size, 1) // round_bytes)
        for i in range(rounds):
            chosen = anchors.where((F.size("vector") == size) & (F.pmod(F.xxhash64("vec_id"), F.lit(rounds)) == i))
            # Vectors of one round: ``round_bytes``, give or take what the hash deals unevenly.
            table = chosen.select("vec_id", "label", "vector").toArrow().sort_by("vec_id").combine_chunks()
            if not table.num_rows:
                continue
            ids, labels = (table[c].to_numpy() for c in ("vec_id", "label"))
            whole_vectors = whole(_matrix(table["vector"].chunk(0)))
            every = np.arange(len(ids))
            unlimited = Askers(every, np.full(len(ids), _LOWEST), np.full(len(ids), _HIGHEST))
            near = _searched(vectors, size, Round(ids, labels, whole_vectors, True, unlimited, positives))
            # A few rows for each anchor of the round.
            pairs = near.select("asker", "vec_id", "score").toArrow().sort_by([("asker", "ascending"), ("score", "descending"), ("vec_id", "ascending")])
            anchor, positive, score = (pairs[c].to_numpy() for c in ("asker", "vec_id", "score"))
            limited = Askers(anchor, *limits(score, floor, ceiling))
            far = _searched(vectors, size, Round(ids, labels, whole_vectors, False, limited, negatives))
            named = pa.table({"asker": np.arange(len(anchor)), "anchor_id": ids[anchor], "positive_id": positive, "positive_score": score})
            named = spark.createDataFrame(named)
            out.append(cut_lineage(far.join(F.broadcast(named), "asker").select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))))
    return _union(out) if out else spark.createDataFrame([], _FOUND)


def limits(score: np.ndarray, floor: int, ceiling: int) -> tuple[np.ndarray, np.ndarray]:
    """Lowest and highest whole number from ``floor`` to ``ceiling`` percent of each score, without
    leaving 64 bits."""
    part, rest = np.divmod(score, 100)
    return part * floor + -(-(rest * floor) // 100), part * ceiling + rest * ceiling // 100


def _union(frames: list[DataFrame]) -> DataFrame:
    while len(frames) > 1:
        frames = [a.unionByName(b) for a, b in zip(frames[::2], frames[1::2])] + frames[len(frames) // 2 * 2 :]
    return frames[0]


def hard_negatives(vectors: DataFrame, anchor_every: int = 100, moved_every: int = 7, labels: int = 10) -> DataFrame:
    """Mine for the rows whose id is divisible by ``anchor_every``, against all usable rows.

    Labels of ids divisible by ``moved_every`` go up by one, modulo ``labels``. Of rows that repeat an
    anchor's id, the one with the smallest label, then vector, is the anchor.
    """
    rows = usable(vectors)
    moved = F.when(F.col("vec_id") % moved_every == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))
    rows = rows.withColumn("label", moved)
    first = F.min(F.struct("label", "vector")).alias("first")
    anchors = rows.where(F.col("vec_id") % anchor_every == 0).groupBy("vec_id").agg(first).select("vec_id", "first.label", "first.vector")
    return mine(rows, cut_lineage(anchors))

