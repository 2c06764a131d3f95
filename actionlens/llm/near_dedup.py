"""Near-duplicate documents: one-permutation hashing with optimal densification, banded buckets and
star-shaped candidate edges.

1. Every document gets the size and a 128-bit digest of its set of word shingles and a signature: the
   set is hashed once, each of ``BINS`` ranges of the hash keeps its smallest value, and an empty
   range borrows from ranges picked by a hash that all documents share. Documents with equal sets
   collapse to one representative.
2. Bands of the signature are sorted by value. Candidates are the edges from the centre of each bucket
   of equal bands to its other documents, not all pairs. The centre is the document with the most
   bucket neighbours, so that the original of many edited copies meets them all.
3. Candidates are confirmed on full sets.
4. Documents of buckets that still hold several components may have links to each other that no centre
   shows. An exact search over the rarest shingles of just these documents finds them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.hot_keys import join_per_key
from ..session import cut_lineage
from .flat import LOWER, Substrings, mix, steps, word_spans
from .links import components

SHINGLE_WORDS = 5
SIMILAR_PERCENT = 75

# 64 bands of 5: a pair at 75 % is missed by all bands with a probability of 3e-8.
BANDS, BAND_ROWS = 64, 5
BINS = BANDS * BAND_ROWS
BLOCK = 256

# Pairs with one document that are confirmed in one task.
PAIRS_PER_SALT = 2048
# Rows of a step, so that a row number takes two bytes, which are sorted fast.
_ROWS = 1 << 16
_EMPTY = np.uint64(np.iinfo(np.uint64).max)
_FACTORS = mix(np.arange(1, 65, dtype=np.uint64)) | np.uint64(1)
_TRIES = 64
_BORROW = np.random.default_rng(320).integers(0, BINS, (_TRIES, BINS))


def shingles(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 64-bit shingle hashes of at most 65,536 texts, ascending in each text, and the offsets of each
    text's part. A null text is empty; an empty one, or one without words, has no shingle."""
    n = len(offsets) - 1
    lowered = LOWER[data]
    starts, ends, rows = word_spans(lowered, offsets)
    words = Substrings(lowered).hashes(starts, ends)
    counts = np.bincount(rows, minlength=n)
    first = np.concatenate([[0], np.cumsum(counts)])
    keys, owners = [], []
    if len(words) >= SHINGLE_WORDS:
        m = len(words) - SHINGLE_WORDS + 1
        window = np.zeros(m, np.uint64)
        for k in range(SHINGLE_WORDS):
            window += words[k : k + m] * _FACTORS[k]
        whole = rows[:m] == rows[SHINGLE_WORDS - 1 :]
        keys.append(window[whole])
        owners.append(rows[:m][whole])
    # A text with fewer words is one shingle.
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE_WORDS))
    one = np.zeros(len(short), np.uint64)
    for k in range(SHINGLE_WORDS - 1):
        has = counts[short] > k
        one[has] += words[first[short[has]] + k] * _FACTORS[k]
    keys.append(one + counts[short].astype(np.uint64) * _FACTORS[63])
    owners.append(short)
    hashed, owner = mix(np.concatenate(keys)), np.concatenate(owners).astype(np.uint16)
    order = np.argsort(hashed)
    order = order[np.argsort(owner[order], kind="stable")]
    hashed, owner = hashed[order], owner[order]
    new = np.append(True, (hashed[1:] != hashed[:-1]) | (owner[1:] != owner[:-1])) if len(hashed) else np.empty(0, bool)
    return hashed[new], np.searchsorted(owner[new], np.arange(n + 1), "left")


def signatures(hashed: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """One value for each text and bin, empty bins filled."""
    n = len(bounds) - 1
    rows = np.repeat(np.arange(n), np.diff(bounds))
    bins = ((hashed >> np.uint64(32)) * np.uint64(BINS) >> np.uint64(32)).astype(np.int64)
    cell = rows * BINS + bins
    lowest = np.flatnonzero(np.append(True, cell[1:] != cell[:-1])) if len(cell) else np.empty(0, np.int64)
    table = np.full(n * BINS, _EMPTY)
    table[cell[lowest]] = hashed[lowest]
    table = table.reshape(n, BINS)
    filled = table.copy()
    todo = np.flatnonzero(np.diff(bounds) > 0)
    for turn in range(_TRIES):
        todo = todo[(filled[todo] == _EMPTY).any(1)]
        if not len(todo):
            break
        part = filled[todo]
        filled[todo] = np.where(part == _EMPTY, table[todo][:, _BORROW[turn]], part)
    # The rare rest takes the next filled bin.
    while len(todo := todo[(filled[todo] == _EMPTY).any(1)]):
        part = filled[todo]
        filled[todo] = np.where(part == _EMPTY, np.roll(part, -1, 1), part)
    return filled


def band_keys(filled: np.ndarray) -> np.ndarray:
    """A 64-bit key for each text and band."""
    banded = mix(filled).reshape(len(filled), BANDS, BAND_ROWS)
    total = (banded * _FACTORS[:BAND_ROWS]).sum(2, dtype=np.uint64)
    return mix(total + _FACTORS[:BANDS] * np.uint64(3)).view(np.int64)


def _bounded(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Steps of a bounded number of rows."""
    for at in range(0, len(column), _ROWS):
        for low, high, data, offsets in steps(column.slice(at, _ROWS)):
            yield at + low, at + high, data, offsets


def document_bands(documents: DataFrame) -> DataFrame:
    """``(doc_id, n_shingles, d1, d2, bands)``; ``d1`` and ``d2`` are a digest of the set. A null or empty text
    has no shingles and bands that mean nothing; a null id stays null; repeated rows get equal rows."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in _bounded(batch.column("text")):
                hashed, bounds = shingles(data, offsets)
                keys = band_keys(signatures(hashed, bounds))
                sizes = np.diff(bounds)
                digests = []
                for salt in (17, 40):
                    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashed * _FACTORS[salt] + _FACTORS[salt + 1]))])
                    digests.append((total[bounds[1:]] - total[bounds[:-1]]).view(np.int64))
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(high - low + 1, dtype=np.int32) * BANDS), pa.array(keys.ravel())
                )
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(low, high - low), pa.array(sizes), *map(pa.array, digests), lists],
                    names=["doc_id", "n_shingles", "d1", "d2", "bands"],
                )

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        extract, "doc_id long, n_shingles long, d1 long, d2 long, bands array<long>"
    )


def document_sets(documents: DataFrame) -> DataFrame:
    """``(doc_id, shingle_set)`` with the set as a sorted array."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in _bounded(batch.column("text")):
                hashed, bounds = shingles(data, offsets)
                lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(hashed.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(low, high - low), lists], names=["doc_id", "shingle_set"])

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(extract, "doc_id long, shingle_set array<long>")


def shared_buckets(bands: DataFrame) -> DataFrame:
    """The rows of ``bands(band, doc)``, both known, whose bucket has several documents; an empty table gives none. They are sorted by band and
    document over ranges, and streamed. A row whose neighbour is in another partition is given too;
    it can be alone in its bucket."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, band, doc = None, np.empty(0, np.int64), np.empty(0, np.int64)

        def rows(after: int | None) -> pa.RecordBatch:
            """Rows equal to a neighbour; an unknown neighbour counts as equal."""
            up = np.append(True if before is None else band[0] == before, band[1:] == band[:-1])
            down = np.append(band[1:] == band[:-1], True if after is None else band[-1] == after)
            pick = up | down
            return pa.RecordBatch.from_arrays([pa.array(band[pick]), pa.array(doc[pick])], names=["band", "doc"])

        for batch in batches:
            if not batch.num_rows:
                continue
            following = batch.column("band").to_numpy()
            if len(band):
                yield rows(following[0])
                before = band[-1]
            band, doc = following, batch.column("doc").to_numpy()
        if len(band):
            yield rows(None)

    return bands.repartitionByRange("band", "doc").sortWithinPartitions("band", "doc").mapInArrow(stream, "band long, doc long")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` whose full sets are similar enough. ``pairs`` should be stored.

    A document with very many pairs, such as the centre of a large group, has its set repeated, and its
    pairs are dealt to the repeats.
    """
    one = sets.select(F.col("doc_id").alias("a"), F.col("shingle_set").alias("set_a"))
    two = sets.select(F.col("doc_id").alias("b"), F.col("shingle_set").alias("set_b"))
    both = F.size(F.array_intersect("set_a", "set_b"))
    union = F.size("set_a") + F.size("set_b") - both
    loads = cut_lineage(
        pairs.groupBy("a").agg(F.count("*").alias("rows")).where(F.col("rows") > PAIRS_PER_SALT)
        .withColumn("salts", F.expr(f"(rows + {PAIRS_PER_SALT - 1}) div {PAIRS_PER_SALT}"))
    )
    on = ["a"]
    if not loads.isEmpty():
        salts = F.coalesce("salts", F.lit(1))
        pairs = join_per_key(pairs, loads, "a", "rows").withColumn("salt", F.pmod(F.xxhash64("b"), salts)).drop("salts")
        one = one.join(loads.drop("rows"), "a", "left").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), salts - 1))).drop("salts")
        on = ["a", "salt"]
    return pairs.join(two, "b").join(one, on).where(100 * both >= percent * union).select("a", "b")


def _possible(a: str, b: str, percent: int) -> str:
    """Sizes of sets that can be similar enough."""
    return f"100 * least({a}, {b}) >= {percent} * greatest({a}, {b})"


def _central_stars(buckets: DataFrame) -> DataFrame:
    """Edges ``(a, b)`` from the centre of every bucket to its other rows. The centre is the document
    that shares the most bucket places with others: the original of edited copies is in larger buckets
    than a copy, and nearer to them."""
    places = buckets.groupBy("band").agg(F.count("*").alias("places")).where("places > 1")
    shared = cut_lineage(join_per_key(buckets, places.withColumn("rows", F.col("places")), "band", "rows").where("places IS NOT NULL"))
    central = shared.groupBy("doc").agg(F.sum("places").alias("score"))
    centres = (
        shared.join(central, "doc")
        .groupBy("band")
        .agg(F.max_by("doc", F.struct("score", -F.col("doc"))).alias("centre"), F.max("places").alias("rows"))
    )
    edges = join_per_key(shared, centres, "band", "rows").where("doc <> centre")
    return edges.select(F.col("centre").alias("a"), F.col("doc").alias("b")).distinct()


def _in_mixed_buckets(members: DataFrame) -> DataFrame:
    """Documents of buckets with several components; ``members(band, doc, component)``."""
    mixed = members.groupBy("band").agg(F.min("component").alias("least"), F.max("component").alias("most")).where("least < most")
    return members.join(mixed.select("band"), "band", "left_semi").select("doc", "component").distinct()


def _pairs_across(sets: DataFrame, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` of different components that can be similar enough;
    ``sets(doc, component, shingle_set)``.

    With all shingles in one order, the rarest first, two sets that are similar enough share one of
    their first ``n - percent * n / 100 + 1`` shingles. Shingles that no other set has never pair, so
    an edited copy with many words of its own pairs with few others. At the first shingle that two sets
    share, what is left of the smaller rest must be enough for the whole overlap; other pairs are left
    out. A shingle's rows are paired in blocks.
    """
    whole = sets.select("doc", "component", F.size("shingle_set").cast("long").alias("n"), F.xxhash64("shingle_set").alias("text"), "shingle_set")
    each = whole.select("doc", "component", "n", "text", F.explode("shingle_set").alias("shingle"))
    often = cut_lineage(each.groupBy("shingle").agg(F.count("*").alias("often")).where("often > 1"))
    first = F.expr(f"n - (({percent} * n + 99) div 100) + 1 - (n - size(common))")
    prefixes = cut_lineage(
        join_per_key(each, often.withColumn("rows", F.col("often")), "shingle", "rows")
        .where("often IS NOT NULL")
        .groupBy("doc", "component", "n", "text")
        .agg(F.sort_array(F.collect_list(F.struct("often", "shingle"))).alias("common"))
        .select("doc", "component", "n", (F.col("n") - F.size("common")).alias("own"), F.posexplode(F.slice("common", F.lit(1), F.greatest(F.lit(0), first.cast("int")))).alias("at", "rare"))
        # Shingles from this one on: at most so many can be shared with a set that shares none before it.
        .select("doc", "component", "n", F.col("rare.shingle").alias("shingle"), (F.col("n") - F.col("own") - F.col("at")).alias("rest"))
    )
    mixed = prefixes.groupBy("shingle").agg(F.min("component").alias("least"), F.max("component").alias("most"), F.count("*").alias("rows")).where("least < most")
    placed = (
        join_per_key(prefixes, mixed.select("shingle", "rows", F.col("rows").alias("held")), "shingle", "held")
        .where("rows IS NOT NULL")
        .withColumn("last", F.expr(f"(rows - 1) div {BLOCK}"))
        .withColumn("block", F.expr("pmod(xxhash64(doc, n), last + 1)"))
    )
    left = placed.select("shingle", F.col("doc").alias("a"), F.col("n").alias("n_a"), F.col("component").alias("c_a"), F.col("rest").alias("r_a"), F.col("block").alias("i"), F.explode(F.expr("sequence(block, last)")).alias("j"))
    right = placed.select("shingle", F.col("doc").alias("b"), F.col("n").alias("n_b"), F.col("component").alias("c_b"), F.col("rest").alias("r_b"), F.explode(F.expr("sequence(bigint(0), block)")).alias("i"), F.col("block").alias("j"))
    enough = f"(100 + {percent}) * least(r_a, r_b) >= {percent} * (n_a + n_b)"
    paired = left.join(right, ["shingle", "i", "j"]).where(f"c_a <> c_b AND (i < j OR a < b) AND {enough}")
    return paired.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(documents: DataFrame, percent: int = SIMILAR_PERCENT) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every row of ``documents``.

    Rows with the same id are one node, whatever their texts. A row without words is linked with
    nothing. A row without an id cannot be named: its component is null and it is kept. Runs jobs.
    """
    table = cut_lineage(document_bands(documents))
    linkable = table.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = cut_lineage(
        linkable.groupBy("n_shingles", "d1", "d2")
        .agg(F.min("doc_id").alias("doc"), F.count("*").alias("rows"), F.min("bands").alias("bands"))
    )
    bands = classes.select(F.explode("bands").alias("band"), "doc")
    buckets = cut_lineage(shared_buckets(bands))
    stars = _central_stars(buckets)
    sizes = classes.groupBy("doc").agg(F.min("n_shingles").alias("least_n"), F.max("n_shingles").alias("n_shingles"))
    # Sizes rule pairs out before any set is read; an id with several texts is not ruled out.
    sized = (
        stars.join(sizes.select(F.col("doc").alias("a"), F.col("least_n").alias("l_a"), F.col("n_shingles").alias("n_a")), "a")
        .join(sizes.select(F.col("doc").alias("b"), F.col("least_n").alias("l_b"), F.col("n_shingles").alias("n_b")), "b")
        .where(_possible("n_a", "n_b", percent) + " OR l_a < n_a OR l_b < n_b")
        .select("a", "b")
    )
    candidates = cut_lineage(sized)
    wanted = buckets.select(F.col("doc").alias("doc_id")).distinct()
    representatives = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(wanted, "doc_id", "left_semi")
    sets = cut_lineage(document_sets(representatives))
    near = cut_lineage(_confirmed(candidates, sets, percent))
    first = cut_lineage(components(near))
    members = buckets.join(first.select(F.col("node").alias("doc"), "component"), "doc", "left").select(
        "band", "doc", F.coalesce("component", "doc").alias("component")
    )
    open_sets = sets.withColumnRenamed("doc_id", "doc").join(_in_mixed_buckets(members), "doc")
    across = cut_lineage(_pairs_across(cut_lineage(open_sets), percent))
    more = _confirmed(across, sets, percent)
    named = first.select(F.col("node").alias("doc"), "component")
    # Back to all rows: class, then component. An id with several texts links their classes.
    by_id = linkable.select("doc_id", "n_shingles", "d1", "d2").join(
        classes.select("n_shingles", "d1", "d2", "doc"), ["n_shingles", "d1", "d2"]
    )
    several = by_id.groupBy("doc_id").agg(F.min("doc").alias("least"), F.max("doc").alias("most")).where("least < most")
    same_id = by_id.join(several.select("doc_id"), "doc_id", "left_semi").select(F.col("doc_id").alias("a"), F.col("doc").alias("b"))
    joined = components(
        named.select(F.col("doc").alias("a"), F.col("component").alias("b")).unionByName(more).unionByName(same_id)
    )
    return _with_components(table, by_id, joined)


def _with_components(table: DataFrame, by_id: DataFrame, named: DataFrame) -> DataFrame:
    """Give every row its component: its representative's, or its own id."""
    of_id = (
        by_id.where("doc_id <> doc").select("doc_id", "doc").distinct()
        .join(named.select(F.col("node").alias("doc"), "component"), "doc", "left")
        .select("doc_id", F.coalesce("component", "doc").alias("component"))
        .unionByName(named.select(F.col("node").alias("doc_id"), "component"))
        .groupBy("doc_id").agg(F.min("component").alias("component"))
    )
    return table.select("doc_id", "n_shingles").join(of_id, "doc_id", "left").select(
        "doc_id",
        "n_shingles",
        F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce(F.coalesce("component", "doc_id") == F.col("doc_id"), F.lit(True)).alias("kept"),
    )


def keep_first_copies(documents: DataFrame, percent: int = SIMILAR_PERCENT) -> DataFrame:
    """The rows of ``documents`` that stay, one document of each group of near-duplicates. Rows without an id, and those
    whose text is null, empty or without words, stay; all rows of an id that goes go."""
    dropped = near_duplicates(documents, percent).where("NOT kept").select(F.col("doc_id").alias("gone")).distinct()
    return documents.join(dropped, documents["doc_id"].cast("long") == dropped["gone"], "left_anti")
