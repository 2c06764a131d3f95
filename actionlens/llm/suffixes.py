"""Removal of long byte strings that occur more than once, by per-shard suffix arrays.

1. Every window of ``LENGTH`` bytes is given the smallest hash of the ``GRAM``-byte strings in it. Windows
   with equal bytes have equal smallest hashes, so repeats can be sought hash by hash. Consecutive
   windows with the same smallest hash form a segment; its string holds all their bytes.
2. Segments are cut into shards by that hash. Segments with equal strings collapse to one with a
   count, and a hash that a single segment of all documents has is left out: its windows occur once.
3. A shard concatenates its strings, sorts their suffixes by Larsson-Sadakane refinement, and gets common
   prefixes by Kasai's method. Neighbours in the suffix array that share ``LENGTH`` bytes are the same
   window. A hash with more text than one shard may hold is cut into a few sorted shards, which
   are merged pairwise by binary search of one shard's windows among the other's.
4. A hash with more text than that, such as that of a line in very many documents, says too little. Its
   segments are cut anew by the smallest hash of longer strings, in the end of whole windows, and most
   of them turn out to be alone with it. So the work stays in proportion to the text.
5. Repeated windows go back to the documents as byte ranges; their union is removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.hot_keys import join_per_key
from ..session import cut_lineage, scratch_folder
from .flat import Substrings, steps, texts_of

LENGTH = 400
GRAM = 48
# Windows of one segment at most, so that a text of one repeated letter is cut too.
MAX_WINDOWS = 2048
# Bytes of strings in one shard, and the most shards of one hash.
SHARD_BYTES = 2 << 20
MOST_PIECES = 6

# Text cut into segments at a time; a dozen arrays of eight bytes a byte are held.
STEP_BYTES = 1 << 20
# Texts unpacked at a time.
ROWS = 500

_PLACE_BITS = 26
_SWAPPED = np.random.default_rng(400).permutation(256).astype(np.uint8)


def sliding_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of every ``width`` neighbours."""
    out, have = values, 1
    while have < width:
        move = min(have, width - have)
        out = np.minimum(out[:-move], out[move:])
        have += move
    return out


def segments(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> dict[str, np.ndarray]:
    """Segments of all texts: row, first byte in the row, windows, smallest hash, whether the segment can hold
    a window twice, and a 128-bit digest."""
    names = ("row", "start", "windows", "key", "again", "d1", "d2")
    counts = np.maximum(np.diff(offsets) - length + 1, 0)
    if not counts.any():
        return {n: np.empty(0, np.uint64 if n in ("key", "d1", "d2") else np.int64) for n in names}
    at = np.arange(len(data) - gram + 1)
    plain = Substrings(data)
    keys = plain.hashes(at, at + gram)
    width, mask = length - gram + 1, np.uint64((1 << _PLACE_BITS) - 1)
    place = at.astype(np.uint64) & mask
    first = sliding_minimum((keys & ~mask) | place, width) & mask
    last = mask - (sliding_minimum((keys & ~mask) | (mask - place), width) & mask)
    rows = np.repeat(np.arange(len(counts)), counts)
    within = np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)
    window = offsets[rows] + within
    if len(at) > 1 << _PLACE_BITS:
        # Places of a very long text wrap around; take its windows one stretch at a time.
        lowest, twice = sliding_minimum(keys, width)[window], np.ones(len(window), bool)
    else:
        lowest, twice = keys[first[window].astype(np.int64)], first[window] != last[window]
    new = np.append(True, (lowest[1:] != lowest[:-1]) | (rows[1:] != rows[:-1]))
    heads = np.flatnonzero(new)
    sizes = np.diff(np.append(heads, len(rows)))
    parts = -(-sizes // MAX_WINDOWS)
    if (parts > 1).any():
        heads = np.concatenate([h + MAX_WINDOWS * np.arange(k) for h, k in zip(heads, parts)])
        sizes = np.diff(np.append(heads, len(rows)))
    begin, end = window[heads], window[heads] + sizes + length - 1
    other = Substrings(_SWAPPED[data])
    # Equal windows so far apart that no window between them has the hash twice take a segment of that size.
    again = np.logical_or.reduceat(twice, heads) | (sizes > width)
    found = (rows[heads], within[heads], sizes, lowest[heads], again, plain.hashes(begin, end), other.hashes(begin, end))
    return dict(zip(names, found))


def suffix_array(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of ``text`` (non-negative integers) in the order of their first ``depth`` symbols at
    least, and which of them differ from the one before within so many. Equal ones stand by place.

    Larsson-Sadakane: suffixes sorted by ``h`` symbols fall into groups; each group that is not yet
    single is sorted by the group of the suffix ``h`` further, which doubles ``h``.
    """
    n = len(text)
    # The first round packs seven symbols of nine bits.
    packed = np.zeros(n, np.int64)
    padded = np.concatenate([text.astype(np.int64) + 1, np.zeros(7, np.int64)])
    for k in range(7):
        packed = (packed << 9) | padded[k : k + n]
    order = np.argsort(packed)
    new = np.append(True, packed[order][1:] != packed[order][:-1])
    heads = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank = np.empty(n + 1, np.int64)
    rank[order], rank[n] = heads, -1
    h = 7
    while h < depth:
        single = new & np.append(new[1:], True)
        open_at = np.flatnonzero(~single)
        if not len(open_at):
            break
        suffixes = order[open_at]
        further = rank[np.minimum(suffixes + h, n)]
        group = heads[open_at]
        arranged = np.argsort(group * (n + 1) + further + 1)
        suffixes, further = suffixes[arranged], further[arranged]
        order[open_at] = suffixes
        split = np.append(True, (group[1:] != group[:-1]) | (further[1:] != further[:-1]))
        new[open_at] = split
        heads[open_at] = np.maximum.accumulate(np.where(split, open_at, 0))
        rank[suffixes] = heads[open_at]
        h *= 2
    order = order[np.argsort(heads * n + order)]
    return order, new


# Places that one lane of Kasai's method goes through.
LANE = 512


def common_prefixes(text: np.ndarray, order: np.ndarray, new: np.ndarray, limit: int) -> np.ndarray:
    """Common prefix of each suffix with the one before it in ``order``, up to ``limit``.

    Suffixes that are not ``new`` share ``limit`` symbols or more. For the others Kasai's method: from one
    place of the text to the next the common prefix shrinks by one symbol at most, so each comparison
    goes on where the last one ended; after a suffix that was not new nothing is known. The text
    is cut into lanes that all walk in lockstep.
    """
    n = len(order)
    before = np.full(n, -1, np.int64)
    before[order[1:]] = order[:-1]
    new_at = np.empty(n, bool)
    new_at[order] = new
    by_place = np.where(new_at, 0, limit)
    padded = np.append(text.astype(np.int32), [-1])
    at = np.arange(0, n, LANE)
    stop = np.minimum(at + LANE, n)
    have = np.zeros(len(at), np.int64)
    while len(at):
        other, compared = before[at], new_at[at]
        mine, theirs = np.minimum(at + have, n), np.minimum(other + have, n)
        more = compared & (other >= 0) & (have < limit) & (mine < n) & (theirs < n)
        more &= padded[mine] == padded[theirs]
        done = compared & ~more
        by_place[at[done]] = have[done]
        have = np.where(more, have + 1, np.where(compared, np.maximum(have - 1, 0), 0))
        at = at + ~more
        going = at < stop
        if not going.all():
            at, stop, have = at[going], stop[going], have[going]
    return by_place[order]


class Shard:
    """Sorted windows of the strings of one shard."""

    def __init__(self, strings: list[bytes], windows: np.ndarray, length: int):
        self.length = length
        sizes = np.array([len(x) for x in strings], np.int64)
        self.starts = np.cumsum(sizes + 1) - sizes - 1
        text = np.full(int(sizes.sum()) + len(strings), 256, np.int32)
        inside = np.ones(len(text), bool)
        inside[self.starts + sizes] = False
        text[inside] = np.frombuffer(b"".join(strings), np.uint8)
        self.text = text
        # Places where a window of a string starts.
        counts = np.zeros(len(text), np.int64)
        self.string_of = np.repeat(np.arange(len(strings)), sizes + 1)
        counts = np.arange(len(text)) - self.starts[self.string_of]
        self.is_window = counts < windows[self.string_of]
        order, new = suffix_array(text, length)
        prefixes = common_prefixes(text, order, new, length)
        kept = self.is_window[order]
        # Other suffixes may stand between two windows; equal windows stay neighbours all the same,
        # for whatever stands between them has their first bytes too.
        group = np.cumsum(prefixes < length)
        self.order, self.group = order[kept], group[kept]

    def repeated(self, weight: np.ndarray) -> np.ndarray:
        """Places of windows that occur more than once, a string counting ``weight`` times."""
        if not len(self.order):
            return self.order
        heads = np.flatnonzero(np.append(True, self.group[1:] != self.group[:-1]))
        total = np.add.reduceat(weight[self.string_of[self.order]], heads)
        many = np.repeat(total > 1, np.diff(np.append(heads, len(self.order))))
        return np.sort(self.order[many])

    def found_in(self, other: Shard) -> tuple[np.ndarray, np.ndarray]:
        """Places of windows that both shards have, here and there: binary search of this shard's
        distinct windows among the other's sorted ones."""
        none = np.empty(0, np.int64)
        if not len(self.order) or not len(other.order):
            return none, none
        heads = np.flatnonzero(np.append(True, self.group[1:] != self.group[:-1]))
        there = np.flatnonzero(np.append(True, other.group[1:] != other.group[:-1]))
        mine, theirs = self.order[heads], other.order[there]
        low, high = np.zeros(len(mine), np.int64), np.full(len(mine), len(theirs))
        while (going := np.flatnonzero(low < high)).size:
            middle = (low[going] + high[going]) // 2
            after = self._after(mine[going], other, theirs[middle])
            low[going] = np.where(after > 0, middle + 1, low[going])
            high[going] = np.where(after > 0, high[going], middle)
        inside = np.flatnonzero(low < len(theirs))
        equal = inside[self._after(mine[inside], other, theirs[low[inside]]) == 0]
        here = np.isin(self.group, self.group[heads[equal]])
        there_too = np.isin(other.group, other.group[there[low[equal]]])
        return np.sort(self.order[here]), np.sort(other.order[there_too])

    def _after(self, mine: np.ndarray, other: Shard, theirs: np.ndarray) -> np.ndarray:
        """Sign of the comparison of windows."""
        result = np.zeros(len(mine), np.int64)
        left = np.arange(len(mine))
        for k in range(self.length):
            if not len(left):
                break
            a, b = self.text[mine[left] + k], other.text[theirs[left] + k]
            differs = a != b
            result[left[differs]] = np.where(a[differs] > b[differs], 1, -1)
            left = left[~differs]
        return result

    def ranges(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """String, first window and end window of the runs of ``places``."""
        if not len(places):
            return places, places, places
        string = self.string_of[places]
        heads = np.flatnonzero(np.append(True, (np.diff(places) != 1) | (string[1:] != string[:-1])))
        ends = np.append(heads[1:], len(places)) - 1
        return string[heads], places[heads] - self.starts[string[heads]], places[ends] - self.starts[string[heads]] + 1


def _stored(df: DataFrame) -> DataFrame:
    """``df`` as Parquet in the shared folder, so that later steps read the columns they need."""
    path = scratch_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


_SEGMENTS = "doc_id long, text_hash long, start long, windows long, key long, again boolean, d1 long, d2 long"


def document_segments(documents: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """``(doc_id, text_hash, start, windows, key, again, d1, d2)`` of all segments."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, _, data, offsets in steps(batch.column("text"), STEP_BYTES):
                found = segments(data, offsets, length, gram)
                rows = pa.array(found["row"] + low)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").take(rows), batch.column("text_hash").take(rows), pa.array(found["start"]),
                        pa.array(found["windows"]), pa.array(found["key"].view(np.int64)), pa.array(found["again"].astype(bool)),
                        pa.array(found["d1"].view(np.int64)), pa.array(found["d2"].view(np.int64)),
                    ],
                    names=["doc_id", "text_hash", "start", "windows", "key", "again", "d1", "d2"],
                )

    return _keyed(documents).mapInArrow(extract, _SEGMENTS)


def _keyed(documents: DataFrame) -> DataFrame:
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))


def _packed(documents: DataFrame) -> DataFrame:
    """Texts compressed, to be shuffled: ``(doc_id, text_hash, packed)``."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=3, write_checksum=False)
        for batch in batches:
            for low, high, data, offsets in steps(batch.column("text")):
                packed = pa.array([press.compress(t) for t in texts_of(data, offsets)], pa.binary())
                rest = [batch.column(c).slice(low, high - low) for c in ("doc_id", "text_hash")]
                yield pa.RecordBatch.from_arrays([*rest, packed], names=["doc_id", "text_hash", "packed"])

    return _keyed(documents).mapInArrow(pack, "doc_id long, text_hash long, packed binary")


_SAME_TEXT = "d.doc_id <=> p.doc_id AND d.text_hash = p.text_hash"


def _strings(documents: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """The bytes of ``wanted`` segments: ``(key, d1, d2, n, windows, shard, piece, string)``."""
    plans = wanted.groupBy("doc_id", "text_hash").agg(
        F.collect_list(F.struct("start", "windows", "key", "d1", "d2", "n", "shard", "pieces")).alias("plan")
    )
    schema = "key long, d1 long, d2 long, n long, windows long, shard long, pieces long, string binary"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            texts, plan = batch.column("packed"), batch.column("plan")
            for i in range(batch.num_rows):
                parts = plan[i].values
                text = unpack.decompress(texts[i].as_py())
                starts, windows = (parts.field(n).to_pylist() for n in ("start", "windows"))
                cuts = [text[a : a + w + length - 1] for a, w in zip(starts, windows)]
                yield pa.RecordBatch.from_arrays(
                    [*(parts.field(n) for n in ("key", "d1", "d2", "n", "windows", "shard", "pieces")), pa.array(cuts, pa.binary())],
                    names=["key", "d1", "d2", "n", "windows", "shard", "pieces", "string"],
                )

    joined = _packed(documents).alias("d").join(plans.alias("p"), F.expr(_SAME_TEXT))
    return joined.select("d.packed", "p.plan").mapInArrow(cut, schema)


_RANGES = "key long, d1 long, d2 long, first long, end long"


def _search(length: int):
    """The work of one shard, or of a pair of shards that are merged."""

    def search(table: pa.Table) -> pa.Table:
        rows = table.to_pydict()
        groups: dict[int, list[int]] = {}
        seen = set()
        for i, name in enumerate(zip(rows["key"], rows["d1"], rows["d2"])):
            if name not in seen:  # equal rows of the documents give a string twice
                seen.add(name)
                groups.setdefault(rows["piece"][i], []).append(i)
        made = {}
        for piece, members in groups.items():
            made[piece] = Shard([rows["string"][i] for i in members], np.array([rows["windows"][i] for i in members]), length)
        places: list[tuple[int, np.ndarray]] = []
        if rows["piece_a"][0] == rows["piece_b"][0]:
            for piece, shard in made.items():
                places.append((piece, shard.repeated(np.array([rows["n"][i] for i in groups[piece]]))))
        elif len(made) == 2:
            one, two = made
            here, there = made[one].found_in(made[two])
            places += [(one, here), (two, there)]
        out: list[list[np.ndarray]] = [[] for _ in range(5)]
        for piece, found in places:
            string, first, end = made[piece].ranges(found)
            index = np.array(groups[piece])[string]
            for k, name in enumerate(("key", "d1", "d2")):
                out[k].append(np.array(rows[name], np.int64)[index])
            out[3].append(first)
            out[4].append(end)
        names = ["key", "d1", "d2", "first", "end"]
        return pa.table({n: pa.array(np.concatenate([*x, np.empty(0, np.int64)]).astype(np.int64)) for n, x in zip(names, out)})

    return search


def shared_segments(found: DataFrame) -> DataFrame:
    """The rows of ``found`` whose key another segment has too, or that may hold a window twice.

    Rows are sorted by key over ranges and streamed; a key with very many rows goes over several
    partitions. A row whose neighbour is in another partition is given too: it can be alone with its key.
    """

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        before, held = None, None

        def rows(after: int | None) -> pa.RecordBatch:
            keys = held.column("key").to_numpy()
            up = np.append(True if before is None else keys[0] == before, keys[1:] == keys[:-1])
            down = np.append(keys[1:] == keys[:-1], True if after is None else keys[-1] == after)
            again = held.column("again").to_numpy(zero_copy_only=False)
            return held.filter(pa.array(up | down | again))

        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                yield rows(batch.column("key")[0].as_py())
                before = held.column("key")[-1].as_py()
            held = batch
        if held is not None:
            yield rows(None)

    # Ranges by digest too, so that many rows of a key can be split.
    order = ["key", "d1", "d2", "doc_id", "start"]
    return found.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(stream, found.schema)


def _finer_segments(documents: DataFrame, coarse: DataFrame, length: int, gram: int) -> DataFrame:
    """The windows of the ``coarse`` segments as segments by the smallest hash of longer strings."""
    plans = coarse.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("start", "windows")).alias("plan"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        names = ["start", "windows", "key", "again", "d1", "d2"]
        for batch in batches:
            texts, plan = batch.column("packed"), batch.column("plan")
            for i in range(batch.num_rows):
                text = unpack.decompress(texts[i].as_py())
                starts, windows = (plan[i].values.field(n).to_numpy() for n in ("start", "windows"))
                # Some stretches at a time; windows that overlap two stretches are in one of them only.
                ends = np.cumsum(windows + length - 1)
                for low in np.unique(np.searchsorted(ends, np.arange(0, ends[-1], STEP_BYTES), "right")):
                    high = np.searchsorted(ends, ends[low] - windows[low] + STEP_BYTES, "right") + 1
                    stretches = [text[a : a + w + length - 1] for a, w in zip(starts[low:high].tolist(), windows[low:high].tolist())]
                    offsets = np.concatenate([[0], np.cumsum([len(x) for x in stretches])])
                    found = segments(np.frombuffer(b"".join(stretches), np.uint8), offsets, length, gram)
                    out = [starts[low:high][found["row"]] + found["start"], found["windows"], found["key"].view(np.int64), found["again"].astype(bool), found["d1"].view(np.int64), found["d2"].view(np.int64)]
                    ids = [pa.array([batch.column(c)[i].as_py()] * len(found["row"]), pa.int64()) for c in ("doc_id", "text_hash")]
                    yield pa.RecordBatch.from_arrays([*ids, *map(pa.array, out)], names=["doc_id", "text_hash", *names])

    joined = _packed(documents).alias("d").join(plans.alias("p"), F.expr(_SAME_TEXT))
    return joined.select("d.doc_id", "d.text_hash", "d.packed", "p.plan").mapInArrow(extract, _SEGMENTS)


def repeated_ranges(documents: DataFrame, length: int = LENGTH, gram: int = GRAM, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``(doc_id, text_hash, ranges)``: for every text that shares a string of ``length`` bytes with
    itself or another, the byte ranges ``array<struct<a, b>>`` that such strings cover, overlapping
    and in no order. Runs jobs; segments and shared strings are stored, once more for each longer
    string that some hashes need."""
    found = document_segments(documents, length, gram)
    spans = None
    for finer in (max(gram, (gram + length) // 3), length, None):
        found = cut_lineage(shared_segments(_stored(found)))
        size = F.col("at.windows") + length - 1
        strings = cut_lineage(
            found.groupBy("key", "d1", "d2")
            .agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "text_hash", "start", "windows")).alias("at"))
            .withColumn("size", size)
        )
        total = strings.agg(F.sum("size")).first()[0] or 0
        shards = max(1, -(-total // shard_bytes))
        # A key with more text than a shard may hold has shards of its own, apart from the numbered ones.
        large = strings.groupBy("key").agg(F.sum("size").alias("bytes"), F.sum("n").alias("rows")).where(F.col("bytes") > shard_bytes)
        # Whole windows of one key are equal: no key is large by then.
        large = cut_lineage(large.select("key", "rows", F.ceil(F.col("bytes") / shard_bytes).cast("long").alias("pieces")))
        few = F.coalesce("pieces", F.lit(1).cast("long")).alias("pieces")
        coarse = large.where(F.lit(finer is not None) & (F.col("pieces") > MOST_PIECES))
        any_coarse = not coarse.isEmpty()
        if any_coarse:
            strings = _of_keys(strings, coarse, keep=False)
        wanted = join_per_key(strings, large, "key", "rows").select("key", "d1", "d2", "n", "at.*", few).withColumn(
            "shard", F.when(F.col("pieces") > 1, F.col("key")).otherwise(F.pmod("key", F.lit(shards)))
        )
        cut = _strings(documents, wanted, length).withColumn("piece", F.pmod(F.col("d1"), F.col("pieces")))
        pairs = F.expr(
            "transform(sequence(bigint(0), pieces - 1), x -> struct(least(piece, x) AS piece_a, greatest(piece, x) AS piece_b))"
        )
        dealt = cut.withColumn("pair", F.explode(pairs)).select("*", "pair.*").drop("pair")
        own = (F.col("pieces") > 1).alias("own")
        marked = dealt.groupBy("shard", own, "piece_a", "piece_b").applyInArrow(_search(length), _RANGES)
        # A string's digest names it; its key is a function of it. Its marks are no more than its windows.
        digest = F.struct("d1", "d2").alias("digest")
        marks = marked.groupBy(digest).agg(F.collect_list(F.struct("first", "end")).alias("marks"))
        times = strings.groupBy(digest).agg(F.sum("n").alias("rows"))
        seen = found.select("doc_id", "text_hash", "start", digest)
        of_size = join_per_key(seen, marks.join(times, "digest"), "digest", "rows").where("marks IS NOT NULL").select("doc_id", "text_hash", "start", F.explode("marks").alias("mark")).select(
            "doc_id",
            "text_hash",
            F.struct((F.col("start") + F.col("mark.first")).alias("a"), (F.col("start") + F.col("mark.end") - 1 + length).alias("b")).alias("span"),
        )
        spans = of_size if spans is None else spans.unionByName(of_size)
        if not any_coarse:
            break
        found = _finer_segments(documents, _of_keys(found, coarse, keep=True), length, finer)
    return spans.groupBy("doc_id", "text_hash").agg(F.collect_list("span").alias("ranges"))


def _of_keys(rows: DataFrame, keys: DataFrame, keep: bool) -> DataFrame:
    """The rows whose key is one of ``keys(key, rows)``, or is none."""
    marked = join_per_key(rows, keys.select("key", "rows", F.lit(True).alias("met")), "key", "rows")
    return marked.where(F.col("met").isNotNull() if keep else F.col("met").isNull()).drop("met")


def _remove(text: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[int, int, bytes]:
    """Removed bytes, maximal removed runs, and what is left."""
    order = np.argsort(starts)
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    heads = np.flatnonzero(np.append(True, starts[1:] > ends[:-1]))
    low, high = starts[heads], ends[np.append(heads[1:], len(starts)) - 1]
    kept, at = [], 0
    for a, b in zip(low.tolist(), high.tolist()):
        kept.append(text[at:a])
        at = b
    kept.append(text[at:])
    return int((high - low).sum()), len(low), b"".join(kept)


def repeat_digests(documents: DataFrame, ranges: DataFrame) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256, n_kept, touched)`` for every row; a null text is
    empty. ``n_kept`` has the bytes that are left, ``touched`` tells whether any are gone.

    The removed ranges can cut a character, so what is left is bytes and not always text.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            packed, lists = batch.column("packed"), batch.column("ranges")
            for low in range(0, batch.num_rows, ROWS):
                high, out = min(low + ROWS, batch.num_rows), []
                for i in range(low, high):
                    text, spans = unpack.decompress(packed[i].as_py()), lists[i]
                    if not spans.is_valid:
                        out.append((len(text), 0, 0, text))
                        continue
                    a, b = (spans.values.field(k).to_numpy() for k in ("a", "b"))
                    out.append((len(text), *_remove(text, a, b)))
                out = [(n, removed, runs, hashlib.sha256(kept).hexdigest()) for n, removed, runs, kept in out]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(low, high - low),
                        *(pa.array([x[k] for x in out], pa.int64()) for k in range(3)),
                        pa.array([x[3] for x in out]),
                        pa.array([x[0] - x[1] for x in out], pa.int64()),
                        pa.array([x[1] > 0 for x in out], pa.bool_()),
                    ],
                    names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "n_kept", "touched"],
                )

    joined = _packed(documents).alias("d").join(ranges.alias("p"), F.expr(_SAME_TEXT), "left")
    return joined.select("d.doc_id", "d.packed", "p.ranges").mapInArrow(
        digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, n_kept long, touched boolean"
    )
