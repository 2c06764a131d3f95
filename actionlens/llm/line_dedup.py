"""Removal of lines that many documents share.

Line keys are hashed, range-partitioned by (hash, document) and sorted within partitions, so the
documents of a line pass by in order, the largest id first. A stream over each partition keeps
the first and marks the lines of the others as dropped once enough documents have been seen. A
hash whose rows go over the end of a partition, such as that of a very common line, is decided
from the counts of its parts. Dropped positions are gathered per document into a compressed bitmap;
no text is moved until the bitmaps are applied.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .flat import free_name, steps, texts_of

BLANK = b" \t\n\x0b\x0c\r"
MIN_CHARS = 20
MIN_DOCUMENTS = 3

DROP, UNDECIDED, PART = 0, 1, 2
_KEYS = "h1 long, h2 long, doc_id long, text_hash long, n_lines int, lines array<int>"
_STREAM = f"kind int, {_KEYS}, n_docs long"


def line_key(line: bytes) -> bytes:
    """Stripped, with A-Z in lower case."""
    return line.strip(BLANK).lower()


def _long_enough(key: bytes, min_chars: int) -> bool:
    return len(key) >= 4 * min_chars or (len(key) >= min_chars and len(key.decode("utf-8", "replace")) >= min_chars)


def line_positions(documents: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per document and line key, with the positions of the key's lines."""

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, hashes = batch.column("doc_id"), batch.column("text_hash")
            for low, _, data, offsets in steps(batch.column("text")):
                digests, rows, counts, positions, sizes = [], [], [], [], []
                for i, text in enumerate(texts_of(data, offsets)):
                    lines = text.split(b"\n")
                    found: dict[bytes, list[int]] = {}
                    for at, line in enumerate(lines):
                        key = line_key(line)
                        if _long_enough(key, min_chars):
                            found.setdefault(hashlib.blake2b(key, digest_size=16).digest(), []).append(at)
                    digests += found
                    rows += [low + i] * len(found)
                    counts += [len(lines)] * len(found)
                    for at in found.values():
                        positions += at
                        sizes.append(len(at))
                if rows:
                    pair = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                    ends = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                    lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(positions, pa.int32()))
                    taken = pa.array(rows)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(pair[:, 0]), pa.array(pair[:, 1]), ids.take(taken), hashes.take(taken), pa.array(counts, pa.int32()), lists],
                        names=["h1", "h2", "doc_id", "text_hash", "n_lines", "lines"],
                    )

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash")).mapInArrow(extract, _KEYS)


def shared_line_stream(positions: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """Stream the sorted ranges. Rows of kind DROP are decided. At the two ends of a partition, the
    rows that other partitions may decide are UNDECIDED, and PART has the documents counted here."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, n_docs, waiting, at_start = None, 0, [], True
        out: list[tuple] = []

        def close(at_end: bool) -> None:
            if key is None or not (at_start or at_end):
                return
            out.extend((UNDECIDED, *r, 0) for r in waiting)
            out.append((PART, *key, waiting[0][2], 0, 0, [], n_docs))

        def give() -> pa.RecordBatch:
            columns = list(zip(*out)) or [[]] * 8
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.list_(pa.int32()), pa.int64()]
            names = ["kind", "h1", "h2", "doc_id", "text_hash", "n_lines", "lines", "n_docs"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], names=names)

        last_doc = None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[:2] != key:
                    if key is not None:
                        close(False)
                        at_start = False
                    key, n_docs, waiting, last_doc = row[:2], 0, [], object()
                if row[2] != last_doc:
                    n_docs, last_doc = n_docs + 1, row[2]
                    if n_docs == min_documents:
                        out.extend((DROP, *r, 0) for r in waiting if r[2] != waiting[0][2])
                        waiting = [r for r in waiting if r[2] == waiting[0][2]]
                if n_docs < min_documents:
                    waiting.append(row)
                else:
                    out.append((DROP, *row, 0))
            if len(out) > 10_000:
                yield give()
                out.clear()
        close(True)
        yield give()

    order = ["h1", "h2", F.col("doc_id").desc_nulls_last()]
    return positions.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(stream, _STREAM)


def keep_bitmaps(documents: DataFrame, min_chars: int = MIN_CHARS, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """``(doc_id, text_hash, keep)`` of the documents that lose lines.

    ``keep`` is a zlib-compressed bitmap with a bit for each line, the first line in the highest
    bit. A null id counts as the smallest one. Rows with the same id are one document when documents
    are counted; each text has a bitmap of its own. Runs jobs: the keys and the streamed decisions
    are stored, for sampling of ranges and later steps read them again.
    """
    found = cut_lineage(shared_line_stream(cut_lineage(line_positions(documents, min_chars)), min_documents))
    decided = found.where(F.col("kind") == DROP)
    # At most two parts for each partition of the stream, so this side is small at any input size.
    spread = (
        found.where(F.col("kind") == PART)
        .groupBy("h1", "h2")
        .agg(F.sum("n_docs").alias("docs"), F.max("doc_id").alias("kept_doc"))
        .where(F.col("docs") >= min_documents)
    )
    late = (
        found.where(F.col("kind") == UNDECIDED)
        .join(F.broadcast(spread), ["h1", "h2"])
        .where(~F.col("doc_id").eqNullSafe(F.col("kept_doc")))
    )
    wanted = ["doc_id", "text_hash", "n_lines", "lines"]
    gathered = (
        decided.select(*wanted)
        .unionByName(late.select(*wanted))
        .groupBy("doc_id", "text_hash")
        .agg(F.first("n_lines").alias("n_lines"), F.flatten(F.collect_list("lines")).alias("lines"))
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            maps = []
            for n, lines in zip(batch.column("n_lines").to_pylist(), batch.column("lines")):
                bits = np.ones(n, np.uint8)
                bits[lines.values.to_numpy()] = 0
                maps.append(zlib.compress(np.packbits(bits).tobytes()))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(maps, pa.binary())], names=["doc_id", "text_hash", "keep"]
            )

    return gathered.mapInArrow(pack, "doc_id long, text_hash long, keep binary")


def _kept(text: bytes, keep: bytes | None) -> tuple[int, int, bytes]:
    """Lines, dropped lines, and what is left."""
    if keep is None:
        return text.count(b"\n") + 1, 0, text
    lines = text.split(b"\n")
    bits = np.unpackbits(np.frombuffer(zlib.decompress(keep), np.uint8), count=len(lines))
    return len(lines), int(len(lines) - bits.sum()), b"\n".join(line for line, bit in zip(lines, bits) if bit)


def with_bitmaps(documents: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``documents`` and the bitmap of each row, null where nothing is dropped."""
    same = F.expr("CAST(d.doc_id AS LONG) <=> b.doc_id AND xxhash64(d.text) = b.text_hash")
    return documents.alias("d").join(bitmaps.alias("b"), same, "left")


def line_digests(documents: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``(doc_id, n_lines, n_dropped, kept_sha256)`` for every row of ``documents``."""

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keeps = batch.column("keep").to_pylist()
            for low, high, data, offsets in steps(batch.column("text")):
                rows = [_kept(t, k) for t, k in zip(texts_of(data, offsets), keeps[low:high])]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(low, high - low),
                        pa.array([r[0] for r in rows], pa.int64()),
                        pa.array([r[1] for r in rows], pa.int64()),
                        pa.array([hashlib.sha256(r[2]).hexdigest() for r in rows]),
                    ],
                    names=["doc_id", "n_lines", "n_dropped", "kept_sha256"],
                )

    joined = with_bitmaps(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), bitmaps)
    return joined.select("d.doc_id", "d.text", "b.keep").mapInArrow(digest, "doc_id long, n_lines long, n_dropped long, kept_sha256 string")


def apply_bitmaps(documents: DataFrame, bitmaps: DataFrame) -> DataFrame:
    """``documents`` without the dropped lines; a null text stays null."""

    @F.pandas_udf("string")
    def kept(texts, keeps):
        return texts.combine(keeps, lambda t, k: t if t is None or k is None else _kept(t.encode(), k)[2].decode())

    name = free_name(documents.columns, "keep")
    joined = with_bitmaps(documents, bitmaps).select(*(F.col(f"d.`{c}`") for c in documents.columns), F.col("b.keep").alias(name))
    text = F.when(F.col(name).isNull(), F.col("text")).otherwise(kept("text", name))
    return joined.withColumn("text", text).select(*documents.columns)
