"""Nearest neighbours by cosine: inverted lists, scanned dimension by dimension.

Vectors are assigned to the nearest of some centroids, which a bounded sample is clustered into.
Every vector is in a list. A query probes its nearest lists. Within a list, vectors are turned by a random
rotation, so that any leading dimensions are a fair sample of all; distances are added up over
column blocks, and after each block a hypothesis test abandons candidates whose distance is, by what
has been seen, beyond the query's current k-th. The survivors' cosines are computed in full on the original
vectors.

Lists and the queries that probe them are dealt in blocks of bounded size, so that a list with a third of
all vectors, equal ones even, is the work of many tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..session import cut_lineage

NEAREST = 5
# Every so many vectors have a list of their own, up to the number that the sample can tell apart.
VECTORS_PER_LIST = 2000
SAMPLE, MOST_LISTS = 20_000, 1024
# Share of the sample's own nearest neighbours that the probed lists must hold.
RECALL, TRIALS = 0.97, 500
# Rows of a list, and of its queries, in one block.
LIST_BLOCK, QUERY_BLOCK = 4096, 512
COLUMN_BLOCK = 16
# Standard deviations beyond which a candidate is given up.
CONFIDENCE = 2.0
# Share of candidates left above which blocks are added up for all.
DENSE = 0.05
_SEED = 6


def usable(vectors: DataFrame, key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """``(vec_id, vector)``: rows with an id and a finite, non-zero vector without nulls, of any length."""
    doubles = vectors.select(F.col(key).cast("long").alias("vec_id"), F.col(column).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return doubles.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull()).where(finite).where(F.exists("vector", lambda x: x != 0))


def _unit(matrix: np.ndarray) -> np.ndarray:
    matrix = matrix / np.abs(matrix).max(1, keepdims=True)
    return matrix / np.sqrt((matrix * matrix).sum(1, keepdims=True))


def cluster(sample: np.ndarray, lists: int, rounds: int = 12, seed: int = _SEED) -> np.ndarray:
    """Unit centroids by spherical k-means; equal vectors count once."""
    sample = np.unique(_unit(sample), axis=0)
    random = np.random.default_rng(seed)
    centroids = sample[random.permutation(len(sample))[:lists]]
    for _ in range(rounds):
        nearest = (sample @ centroids.T).argmax(1)
        sums = np.zeros_like(centroids)
        np.add.at(sums, nearest, sample)
        norms = np.sqrt((sums * sums).sum(1))
        full = norms > 0
        centroids[full] = sums[full] / norms[full, None]
    return centroids


def probes_for(sample: np.ndarray, centroids: np.ndarray, recall: float = RECALL, nearest: int = NEAREST) -> int:
    """Lists to probe: so many that they hold a ``recall`` of the nearest neighbours, found by brute force
    within the sample, of some of its vectors. Neighbours are farther apart in a sample than in the
    whole table, so this errs on the safe side."""
    sample = np.unique(_unit(sample), axis=0)
    asked = np.random.default_rng(_SEED).permutation(len(sample))[:TRIALS]
    similar = sample[asked] @ sample.T
    similar[np.arange(len(asked)), asked] = -np.inf
    near = np.argsort(-similar, 1)[:, :nearest]
    order = np.argsort(-(sample[asked] @ centroids.T), 1, kind="stable").argsort(1)
    lists = (sample @ centroids.T).argmax(1)
    needed = np.sort(np.take_along_axis(order, lists[near], 1).ravel())
    return int(needed[min(len(needed) - 1, int(np.ceil(recall * len(needed))))]) + 1


def rotation(size: int, seed: int = _SEED) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy().reshape(len(column), -1)


def _assigned(vectors: DataFrame, centroids, probes: int, held: np.ndarray | None = None, least: int = 0) -> DataFrame:
    """``vectors`` once for each of the ``probes`` nearest lists, and for as many more as it takes to hold
    ``least`` rows; ``held`` has the rows of every list."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            similar = _unit(_matrix(batch.column("vector"))) @ centroids.value.T
            nearest = np.argsort(-similar, 1, kind="stable")
            count = np.full(batch.num_rows, probes)
            if held is not None:
                count = np.maximum(count, 1 + (np.cumsum(held[nearest], 1) < least).sum(1))
            wanted = np.arange(nearest.shape[1]) < count[:, None]
            rows, nearest = pa.array(np.nonzero(wanted)[0]), nearest[wanted]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id").take(rows), batch.column("vector").take(rows), pa.array(nearest)], names=["vec_id", "vector", "list"]
            )

    return vectors.mapInArrow(assign, "vec_id long, vector array<double>, list long")


def _cosines(queries: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Cosines of rows in pairs, in double precision."""
    norms = np.sqrt((queries * queries).sum(1)) * np.sqrt((candidates * candidates).sum(1))
    return (queries * candidates).sum(1) / norms


def scan(queries: np.ndarray, query_ids: np.ndarray, candidates: np.ndarray, ids: np.ndarray, turn: np.ndarray, nearest: int = NEAREST):
    """The ``nearest`` candidates of each query, as ``(query row, candidate row, cosine)`` arrays.

    On unit vectors a small squared distance is a large cosine. The candidates that look nearest after
    the first column block give each query its bound and are never abandoned, so every query finds
    ``nearest`` candidates where there are so many; another one stays as long as its partial distance,
    scaled to all dimensions, is within the bound and a margin that narrows as more is seen.
    """
    size = queries.shape[1]
    q, c = _unit(queries) @ turn, _unit(candidates) @ turn
    first = min(COLUMN_BLOCK, size)
    partial = (q[:, :first] ** 2).sum(1)[:, None] + (c[:, :first] ** 2).sum(1)[None] - 2 * q[:, :first] @ c[:, :first].T
    own = query_ids[:, None] == ids[None]
    partial[own] = np.inf
    count = min(nearest, len(ids))
    look = np.argpartition(partial, count - 1, 1)[:, :count]
    exact = ((q[:, None] - c[look]) ** 2).sum(2)
    exact[np.take_along_axis(own, look, 1)] = np.inf
    bound = exact.max(1)
    looked = np.zeros(own.shape, bool)
    np.put_along_axis(looked, look, True, 1)
    seen = first
    stays = ((partial <= _limit(bound, seen, size)[:, None]) | looked) & ~own
    # While many candidates are left, a block is one matrix product; then pairs are taken one by one.
    while seen < size and stays.mean() > DENSE:
        end = min(seen + COLUMN_BLOCK, size)
        a, b = q[:, seen:end], c[:, seen:end]
        partial += (a**2).sum(1)[:, None] + (b**2).sum(1)[None] - 2 * a @ b.T
        seen = end
        stays &= (partial <= _limit(bound, seen, size)[:, None]) | looked
    row, col = np.nonzero(stays)
    so_far = partial[row, col]
    while seen < size and len(row):
        end = min(seen + COLUMN_BLOCK, size)
        so_far = so_far + ((q[row, seen:end] - c[col, seen:end]) ** 2).sum(1)
        seen = end
        near = (so_far <= _limit(bound, seen, size)[row]) | looked[row, col]
        row, col, so_far = row[near], col[near], so_far[near]
    cosine = np.empty(len(row))
    for at in range(0, len(row), 1 << 16):
        part = slice(at, at + (1 << 16))
        cosine[part] = _cosines(queries[row[part]], candidates[col[part]])
    order = np.lexsort((ids[col], -cosine, row))
    row, col, cosine = row[order], col[order], cosine[order]
    heads = np.flatnonzero(np.append(True, row[1:] != row[:-1])) if len(row) else np.empty(0, np.int64)
    rank = np.arange(len(row)) - np.repeat(heads, np.diff(np.append(heads, len(row))))
    best = rank < nearest
    return row[best], col[best], cosine[best]


def _limit(bound: np.ndarray, seen: int, size: int) -> np.ndarray:
    """Largest partial squared distance that the test lets pass. A margin for rounding keeps ties."""
    if seen >= size:
        return bound + 1e-9
    return bound * (seen / size) * (1 + CONFIDENCE / np.sqrt(seen)) ** 2 + 1e-9


def _block(rows: str, size: int) -> Column:
    return F.ceil(F.col(rows) / size).cast("long")


_FOUND = "query_id long, vec_id long, score double"


def nearest_neighbours(vectors: DataFrame, queries: DataFrame, nearest: int = NEAREST, recall: float = RECALL, vectors_per_list: int = VECTORS_PER_LIST) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for every row of ``queries`` the nearest rows of
    ``vectors`` found, both ``(vec_id, vector)``, not counting rows with its own id.

    A query probes so many lists that they hold ``nearest`` rows besides its own. Repeated ids stay
    separate candidates. A table of few vectors is one list and is searched whole.
    Runs jobs: the sample is clustered on the driver, and lists are stored.
    """
    spark = vectors.sparkSession
    vectors = cut_lineage(vectors)
    rows = vectors.count()
    if not rows:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    sample = np.array([r["vector"] for r in vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("vector").collect()])
    lists = max(1, min(MOST_LISTS, rows // vectors_per_list, len(sample) // 16))
    middles = cluster(sample, lists)
    probes = probes_for(sample, middles, recall, nearest)
    centroids = spark.sparkContext.broadcast(middles)
    turn = spark.sparkContext.broadcast(rotation(sample.shape[1]))
    # A table of a few hundred vectors has a single list.
    listed = cut_lineage(_assigned(vectors, centroids, 1))
    # One number for each of at most MOST_LISTS lists.
    held = np.zeros(len(middles), np.int64)
    for r in listed.groupBy("list").agg(F.count("*").alias("rows")).collect():
        held[r["list"]] = r["rows"]
    probing = cut_lineage(_assigned(queries, centroids, probes, held, nearest + 1))
    sizes = listed.groupBy("list").agg(F.count("*").alias("rows")).join(
        probing.groupBy("list").agg(F.count("*").alias("asked")), "list"
    ).select("list", _block("rows", LIST_BLOCK).alias("parts"), _block("asked", QUERY_BLOCK).alias("query_parts"))
    # One row for each of at most MOST_LISTS lists.
    sizes = F.broadcast(sizes)
    dealt = (
        listed.join(sizes, "list")
        .withColumn("part", F.expr("pmod(xxhash64(vec_id), parts)"))
        .withColumn("query_part", F.explode(F.expr("sequence(bigint(0), query_parts - 1)")))
        .select("list", "part", "query_part", "vec_id", "vector")
    )
    asked = (
        probing.join(sizes, "list")
        .withColumn("query_part", F.expr("pmod(xxhash64(vec_id, 1), query_parts)"))
        .withColumn("part", F.explode(F.expr("sequence(bigint(0), parts - 1)")))
        .select("list", "part", "query_part", "vec_id", "vector")
    )

    def search(candidates: pa.Table, questions: pa.Table) -> pa.Table:
        if not candidates.num_rows or not questions.num_rows:
            return pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        candidates, questions = candidates.combine_chunks(), questions.combine_chunks()
        ids, query_ids = candidates["vec_id"].to_numpy(), questions["vec_id"].to_numpy()
        row, col, cosine = scan(
            _matrix(questions["vector"].chunk(0)), query_ids, _matrix(candidates["vector"].chunk(0)), ids, turn.value, nearest
        )
        return pa.table({"query_id": query_ids[row], "vec_id": ids[col], "score": cosine})

    keys = ["list", "part", "query_part"]
    found = dealt.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(search, _FOUND)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= nearest).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )


def search_table(vectors: DataFrame, every: int = 50) -> DataFrame:
    """Queries are the rows whose id is divisible by ``every``, once for each id and length of vector.

    A cosine needs two vectors of one length, so each length is searched by itself, in jobs of its own.
    """
    good = usable(vectors)
    size = F.size("vector")
    # A row for each length.
    lengths = sorted(r["size"] for r in good.groupBy(size.alias("size")).count().collect())
    found = None
    for length in lengths or [0]:
        mine = good.where(size == length) if len(lengths) > 1 else good
        queries = mine.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("vector").alias("vector"))
        part = nearest_neighbours(mine, queries)
        found = part if found is None else found.unionByName(part)
    return found
