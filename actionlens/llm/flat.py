"""Texts of an Arrow batch as one flat byte array, with word and substring hashes in numpy.

Null texts count as empty everywhere.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
CONTINUATION = (np.arange(256) & 0xC0) == 0x80

# Bytes of text that one numpy step works on; a longer text is a step of its own.
STEP_BYTES = 4 << 20

_random = np.random.default_rng(20240131)
_BYTE_CODES = _random.integers(1, 1 << 63, 256, dtype=np.uint64)
_BASE = np.uint64(int(_random.integers(1 << 40, 1 << 62)) * 2 + 1)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))


def binary_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string or binary column."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = pc.fill_null(column, b"")
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def steps(column: pa.Array, step_bytes: int = STEP_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """``(first row, end row, bytes, offsets)`` of consecutive rows with about ``step_bytes`` of text."""
    data, offsets = binary_parts(column)
    low, rows = 0, len(offsets) - 1
    while low < rows:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + step_bytes, "right")) - 1)
        high = min(high, rows)
        yield low, high, data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low]
        low = high


def texts_of(data: np.ndarray, offsets: np.ndarray) -> list[bytes]:
    raw = data.tobytes()
    return [raw[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (a bijection)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Substrings:
    """64-bit hashes of any substrings of ``data``: prefix sums of a polynomial modulo 2**64."""

    _powers = np.ones(1, np.uint64)
    _inverses = np.ones(1, np.uint64)

    def __init__(self, data: np.ndarray):
        n = len(data)
        if len(Substrings._powers) <= n:
            size = n + 1 + n // 4
            for name, base in (("_powers", _BASE), ("_inverses", _BASE_INVERSE)):
                grown = np.full(size, base, np.uint64)
                grown[0] = 1
                setattr(Substrings, name, np.cumprod(grown))
        self.prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE_CODES[data] * Substrings._powers[:n], out=self.prefix[1:])

    def hashes(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        raw = (self.prefix[ends] - self.prefix[starts]) * Substrings._inverses[starts]
        return mix(raw ^ (ends - starts).astype(np.uint64))


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word ``[^\\x20\\x09-\\x0D]+``."""
    if not len(data):
        none = np.empty(0, np.int64)
        return none, none, none
    inside = ~SPACE[data]
    first = np.zeros(len(data) + 1, bool)
    first[offsets] = True
    begins = inside.copy()
    begins[1:] &= ~inside[:-1] | first[1:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:] | first[1:-1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(closes) + 1, rows_at(offsets, starts)


def rows_at(offsets: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """Row of each byte position (ascending)."""
    return np.searchsorted(offsets, positions, "right") - 1


def per_row(values: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Sum of integer ``values`` by row."""
    return np.bincount(rows, weights=values, minlength=n).astype(np.int64)


def free_name(taken: list[str], name: str) -> str:
    """``name``, with underscores added until no column is called so."""
    lowered = {c.lower() for c in taken}
    while name.lower() in lowered:
        name += "_"
    return name
