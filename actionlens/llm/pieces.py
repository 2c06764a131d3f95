"""Piece encoding and decoding by vectorised merge rounds over flat symbol arrays.

A text, with a space put before it and spaces written as U+2581, falls into units: some space
marks and what follows up to the next one. No piece goes over a unit's end, so every distinct unit
of a step is encoded once. All units are merged together: in each round every unit merges its best
pair of neighbours at all its places from the left, and arrays are compacted, until no pair is left.
Merging all places of a pair at once equals one merge at a time unless the new piece makes a pair that
is as good or better; pairs of such pieces are merged one place per round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .flat import CONTINUATION, Substrings, mix, rows_at, steps

MARK = "▁"
_NEVER = np.iinfo(np.int32).max
# Larger steps share more units, and take more memory.
STEP_BYTES = 8 << 20
# Where the ids themselves are given, not only digests.
SMALL_STEP_BYTES = 2 << 20


class PieceModel:
    """Tables of a BPE model with byte fallback and the identity normaliser."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        pieces = [model.id_to_piece(i) for i in range(size)]
        ordinary = [i for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
        self.byte_ids = np.array([model.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
        ids = {pieces[i]: i for i in ordinary}
        scores = np.array([model.get_score(i) for i in range(size)])
        self.rank = np.searchsorted(np.unique(-scores), -scores).astype(np.int32)
        # Characters that are no piece still take part as symbols that merge with nothing.
        self.chars = {ord(p): i for p, i in ids.items() if len(p) == 1}
        codes = np.array(sorted(self.chars))
        self.char_codes, self.char_ids = codes, np.array([self.chars[c] for c in codes], np.int64)
        self.size = size
        pairs = sorted((ids[p[:k]] * size + ids[p[k:]], ids[p]) for p in ids for k in range(1, len(p)) if p[:k] in ids and p[k:] in ids)
        self.pair_keys = np.array([k for k, _ in pairs], np.int64)
        self.pair_ids = np.array([i for _, i in pairs], np.int32)
        # Pieces whose merge may open a pair that must come before the other places of the same merge.
        left, right, made = self.pair_keys // size, self.pair_keys % size, self.rank[self.pair_ids]
        self.single = np.zeros(size, bool)
        for part in (left, right):
            self.single[part[made <= self.rank[part]]] = True
        runs = [len(p) for p in ids if set(p) == {MARK}]
        self.longest_run = max(runs, default=1)
        # Bytes that a piece stands for.
        spelled = [b""] * size
        for i in ordinary:
            spelled[i] = pieces[i].replace(MARK, " ").encode()
        for b, i in enumerate(self.byte_ids.tolist()):
            spelled[i] = bytes([b])
        self.spelled = spelled

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Piece of each pair of symbols, or -1."""
        keys = left * self.size + right
        keys[(left < 0) | (right < 0)] = -1
        at = np.searchsorted(self.pair_keys, keys)
        at[at == len(self.pair_keys)] = 0
        return np.where(self.pair_keys[at] == keys, self.pair_ids[at], -1)


@lru_cache(maxsize=2)
def load_model(path: str) -> PieceModel:
    return PieceModel(path)


def unit_starts(data: np.ndarray, offsets: np.ndarray, longest_run: int) -> np.ndarray:
    """Byte positions where units begin, for texts that each begin with a space.

    A unit begins at a space that follows something else. A run of spaces longer than the longest
    piece of space marks is cut into such pieces from the left, as single merges would do it, but for
    the end of the run, whose last mark may go to the word behind it.
    """
    space = data == 0x20
    first = np.zeros(len(data), bool)
    first[offsets[:-1]] = True
    begins = first.copy()
    begins[1:] |= space[1:] & ~space[:-1]
    starts = np.flatnonzero(begins)
    ends = np.append(starts[1:], len(data))
    stops = np.flatnonzero(~space)
    at = np.searchsorted(stops, starts)
    word = np.minimum(np.append(stops, len(data))[at], ends)
    more = np.maximum(word - starts - 1, 0) // longest_run
    long = np.flatnonzero(more)
    if not len(long):
        return starts
    within = np.concatenate([np.arange(1, n + 1) for n in more[long]])
    return np.sort(np.concatenate([starts, np.repeat(starts[long], more[long]) + longest_run * within]))


def _decoded_chars(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start byte and code point of every character of valid UTF-8."""
    starts = np.flatnonzero(~CONTINUATION[data])
    return starts, np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32).astype(np.int64)


def encode_units(model: PieceModel, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ids of every unit: flat ids and unit offsets."""
    starts, codes = _decoded_chars(data)
    units = rows_at(offsets, starts)
    codes[codes == 0x20] = ord(MARK)
    at = np.minimum(np.searchsorted(model.char_codes, codes), len(model.char_codes) - 1)
    known = model.char_codes[at] == codes
    # A symbol: its piece, or -1 with its characters' bytes; begin is its first byte.
    symbols, begin = np.where(known, model.char_ids[at], -1), starts
    done_symbols, done_begin, done_units = [], [], []
    same = units[1:] == units[:-1]
    pair = np.full(len(symbols), -1, np.int64)
    pair[:-1] = np.where(same, model.merged(symbols[:-1], symbols[1:]), -1)
    while len(symbols):
        rank = np.where(pair >= 0, model.rank[pair], _NEVER)
        heads = np.flatnonzero(np.append(True, units[1:] != units[:-1]))
        lengths = np.diff(np.append(heads, len(units)))
        best = np.minimum.reduceat(rank, heads)
        # Units without a pair are done; the rest go on.
        open_unit = best != _NEVER
        open_symbol = np.repeat(open_unit, lengths)
        if not open_unit.all():
            closed = ~open_symbol
            done_symbols.append(symbols[closed])
            done_begin.append(begin[closed])
            done_units.append(units[closed])
            symbols, begin, units, pair, rank = (x[open_symbol] for x in (symbols, begin, units, pair, rank))
            if not len(symbols):
                break
            lengths, best = lengths[open_unit], best[open_unit]
        places = np.flatnonzero(rank == np.repeat(best, lengths))
        # Of places that overlap, every second one from the left; of single pieces the first of the unit.
        chained = np.append(False, np.diff(places) == 1)
        chain_head = np.maximum.accumulate(np.where(~chained, np.arange(len(places)), 0))
        take = (np.arange(len(places)) - chain_head) % 2 == 0
        unit_of = units[places]
        opens = np.append(True, unit_of[1:] != unit_of[:-1])
        one_only = model.single[pair[places]]
        if one_only.any():
            group = np.cumsum(opens) - 1
            group_single = np.zeros(group[-1] + 1, bool)
            group_single[group[one_only]] = True
            take &= opens | ~group_single[group]
        places = places[take]
        symbols[places] = pair[places]
        keep = np.ones(len(symbols), bool)
        keep[places + 1] = False
        moved = places - np.arange(len(places))
        symbols, begin, units, pair = symbols[keep], begin[keep], units[keep], pair[keep]
        for touched in (moved, moved[moved > 0] - 1):
            ok = touched[touched < len(symbols) - 1]
            fits = units[ok] == units[ok + 1]
            pair[ok] = np.where(fits, model.merged(symbols[ok], symbols[ok + 1]), -1)
            pair[touched[touched == len(symbols) - 1]] = -1
    if not done_symbols:
        return np.empty(0, np.int64), np.zeros(len(offsets), np.int64)
    symbols, begin, units = map(np.concatenate, (done_symbols, done_begin, done_units))
    order = np.argsort(begin)
    symbols, begin, units = symbols[order], begin[order], units[order]
    # Characters without a piece become their bytes.
    unknown = symbols < 0
    width = np.ones(len(symbols), np.int64)
    first = data[begin[unknown]]
    width[unknown] = 1 + (first >= 0xC0).astype(np.int64) + (first >= 0xE0) + (first >= 0xF0)
    ends = np.cumsum(width)
    ids = np.repeat(symbols, width)
    lows = np.flatnonzero(ids < 0)
    within = lows - np.repeat(ends - width, width)[lows]
    ids[lows] = model.byte_ids[data[np.repeat(begin, width)[lows] + within]]
    counts = np.bincount(units, weights=width, minlength=len(offsets) - 1).astype(np.int64)
    return ids, np.concatenate([[0], np.cumsum(counts)])


def _spaced(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts with a space in front; empty texts stay empty. A space mark of the text itself counts
    as a space."""
    mark = np.frombuffer(MARK.encode(), np.uint8)
    raw = data
    if len(raw) >= 3:
        hits = np.flatnonzero((raw[:-2] == mark[0]) & (raw[1:-1] == mark[1]) & (raw[2:] == mark[2]))
        if len(hits):
            keep = np.ones(len(raw), bool)
            keep[hits + 1] = keep[hits + 2] = False
            raw = raw.copy()
            raw[hits] = 0x20
            gone = np.concatenate([[0], np.cumsum(~keep)])
            raw, offsets = raw[keep], offsets - gone[offsets]
    filled = np.diff(offsets) > 0
    return np.insert(raw, offsets[:-1][filled], 0x20), offsets + np.concatenate([[0], np.cumsum(filled)])


class Encoded:
    """Ids of the texts of one step, as distinct units and each text's sequence of them."""

    def __init__(self, model: PieceModel, data: np.ndarray, offsets: np.ndarray):
        self.model, self.rows = model, len(offsets) - 1
        data, offsets = _spaced(data, offsets)
        if not len(data):
            self.unit_ids, self.unit_offsets = np.empty(0, np.int64), np.zeros(1, np.int64)
            self.sequence, self.text_offsets = np.empty(0, np.int64), np.zeros(self.rows + 1, np.int64)
            return
        full = np.concatenate([[True], offsets[1:] > offsets[:-1]])
        starts = unit_starts(data, np.unique(offsets[full]), model.longest_run)
        ends = np.append(starts[1:], len(data))
        hashed = Substrings(data).hashes(starts, ends)
        _, firsts, self.sequence = np.unique(hashed, return_index=True, return_inverse=True)
        lengths = (ends - starts)[firsts]
        unit_offsets = np.concatenate([[0], np.cumsum(lengths)])
        places = np.repeat(starts[firsts] - unit_offsets[:-1], lengths) + np.arange(unit_offsets[-1])
        unit_data = data[places]
        self._verify(data, starts, ends, unit_data, unit_offsets)
        self.unit_ids, self.unit_offsets = encode_units(model, unit_data, unit_offsets)
        self.text_offsets = np.searchsorted(starts, offsets)

    def _verify(self, data, starts, ends, unit_data, unit_offsets) -> None:
        """Units with the same hash are the same bytes."""
        lengths = ends - starts
        if not (np.diff(unit_offsets)[self.sequence] == lengths).all():
            raise ValueError("units of different lengths share a hash")
        there = np.repeat(unit_offsets[self.sequence] - starts, lengths) + np.arange(len(data))
        if not (unit_data[there] == data).all():
            raise ValueError("different units share a hash")

    def counts(self) -> np.ndarray:
        """Ids of each text."""
        running = np.concatenate([[0], np.cumsum(np.diff(self.unit_offsets)[self.sequence])])
        return np.diff(running[self.text_offsets])

    def flat_ids(self) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in one array, and the offsets of each text's part."""
        sizes = np.diff(self.unit_offsets)[self.sequence]
        ends = np.cumsum(sizes)
        places = np.repeat(self.unit_offsets[self.sequence] - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)
        return self.unit_ids[places], np.concatenate([[0], ends])[self.text_offsets]

    def per_text(self, of_unit: list, join) -> Iterator:
        sequence = self.sequence.tolist()
        for a, b in zip(self.text_offsets[:-1].tolist(), self.text_offsets[1:].tolist()):
            yield join([of_unit[u] for u in sequence[a:b]])

    def unit_lists(self) -> list[list[int]]:
        ids = self.unit_ids.tolist()
        return [ids[a:b] for a, b in zip(self.unit_offsets[:-1].tolist(), self.unit_offsets[1:].tolist())]


def decode_bytes(model: PieceModel, ids: list[int]) -> bytes:
    return b"".join(map(model.spelled.__getitem__, ids))


def decode_text(spelled: bytes) -> str:
    """The text of spelled ids, without the space put in front. Broken UTF-8 becomes U+FFFD."""
    return spelled[1:].decode("utf-8", "replace") if spelled[:1] == b" " else spelled.decode("utf-8", "replace")


def encode_documents(documents: DataFrame, model_path: str) -> DataFrame:
    """Every row of ``documents`` with ``ids`` (array<int>) in place of the text; null and empty texts
    have no ids. All other columns stay, but for one already called ``ids``."""
    others = [c for c in documents.columns if c not in ("text", "ids")]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load_model(model_path)
        for batch in batches:
            for low, high, data, offsets in steps(batch.column("text"), STEP_BYTES):
                ids, ends = Encoded(model, data, offsets).flat_ids()
                flat, ends = pa.array(ids.astype(np.int32)), ends.astype(np.int32)
                rest = [batch.column(c).slice(low, high - low) for c in others]
                yield pa.RecordBatch.from_arrays([*rest, pa.ListArray.from_arrays(pa.array(ends), flat)], names=[*others, "ids"])

    frame = documents.select(*others, "text")
    schema = frame.drop("text").withColumn("ids", F.lit(None).cast("array<int>")).schema
    return frame.mapInArrow(encode, schema)


def decode_documents(encoded: DataFrame, model_path: str) -> DataFrame:
    """Turn ``ids`` back into ``text``; the other columns stay."""

    @F.pandas_udf("string")
    def decode(ids):
        model = load_model(model_path)
        return ids.map(lambda x: decode_text(decode_bytes(model, x.tolist())) if x is not None else None)

    return encoded.withColumn("text", decode("ids")).drop("ids")


def encode_and_decode(documents: DataFrame, model_path: str) -> DataFrame:
    """Every row of ``documents`` with ``text`` as its ids decode to, ``token_ids`` and ``n_tokens``; all
    other columns stay, but for ones of these names. A null text becomes an empty one."""
    others = [c for c in documents.columns if c not in ("text", "token_ids", "n_tokens")]

    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load_model(model_path)
        for batch in batches:
            for low, high, data, offsets in steps(batch.column("text"), SMALL_STEP_BYTES):
                step = Encoded(model, data, offsets)
                ids, ends = step.flat_ids()
                spelled = [decode_bytes(model, x) for x in step.unit_lists()]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(c).slice(low, high - low) for c in others),
                        pa.array([decode_text(x) for x in step.per_text(spelled, b"".join)], pa.string()),
                        pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(ids.astype(np.int32))),
                        pa.array(np.diff(ends)),
                    ],
                    names=[*others, "text", "token_ids", "n_tokens"],
                )

    kept = documents.select(*others, "text")
    schema = kept.select("*", F.lit(None).cast("array<int>").alias("token_ids"), F.lit(None).cast("long").alias("n_tokens")).schema
    return kept.mapInArrow(code, schema)


def piece_digests(documents: DataFrame, model_path: str) -> DataFrame:
    """``(doc_id, n_tokens, ids_sha256, decoded_sha256)`` of every row; a null text counts as empty.

    Every text is encoded, and its ids are decoded again.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = load_model(model_path)
        for batch in batches:
            for low, high, data, offsets in steps(batch.column("text"), STEP_BYTES):
                step = Encoded(model, data, offsets)
                lists = step.unit_lists()
                written = [",".join(map(str, x)).encode() for x in lists]
                spelled = [decode_bytes(model, x) for x in lists]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(low, high - low),
                        pa.array(step.counts(), pa.int64()),
                        pa.array([hashlib.sha256(x).hexdigest() for x in step.per_text(written, b",".join)]),
                        pa.array([hashlib.sha256(decode_text(x).encode()).hexdigest() for x in step.per_text(spelled, b"".join)]),
                    ],
                    names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        digest, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )
