"""MD5 of many texts at once, each one of a few prefixes and a number.

The texts of a step go through the 64 rounds together, as arrays of 32-bit words. Equal to the MD5 of Spark, SQL
and ``hashlib`` bit for bit, in a fraction of the time of a call for each text.
"""

from __future__ import annotations

import math
import struct
from functools import lru_cache

import numpy as np

# Bits of a digest that make a number in (0, 1): its first 13 hexadecimal digits.
UNIFORM_BITS = 52

_MASK = 0xFFFFFFFF
_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)
_SINES = [int(abs(math.sin(i + 1)) * 2**32) for i in range(64)]
_SHIFTS = [(7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)]
_LEFT = [_SHIFTS[i // 16][i % 4] for i in range(64)]
_WORDS = [(i, 5 * i + 1, 3 * i + 5, 7 * i)[i // 16] % 16 for i in range(64)]
# Operands without a dimension save the conversion of a number at each step.
_LEFT_BY = [np.array(s, np.uint32) for s in _LEFT]
_RIGHT_BY = [np.array(32 - s, np.uint32) for s in _LEFT]


def _one_step(i: int, a: int, b: int, c: int, d: int, word: int) -> tuple[int, int, int, int]:
    mixed = (d ^ (b & (c ^ d)), c ^ (d & (b ^ c)), b ^ c ^ d, c ^ (b | (d ^ _MASK)))[i // 16]
    x = (a + mixed + _SINES[i] + word) & _MASK
    return d, (b + (x << _LEFT[i] | x >> (32 - _LEFT[i]))) & _MASK, b, c


def _after_block(state: tuple, words: list) -> tuple:
    """The state after a block of 16 words. Both are numbers, or arrays of ``uint32`` where the texts differ."""
    length = next((len(x) for x in (*state, *words) if not isinstance(x, int)), None)
    a, b, c, d = state
    i = 0
    # Steps before the first word in which the texts differ are the same for all of them.
    while i < 64 and all(isinstance(x, int) for x in (a, b, c, d, words[_WORDS[i]])):
        a, b, c, d = _one_step(i, a, b, c, d, words[_WORDS[i]])
        i += 1
    if i < 64:
        a, b, c, d = (np.full(length, x, np.uint32) for x in (a, b, c, d))
        mixed, differs = np.empty(length, np.uint32), None
    for i in range(i, 64):
        if i < 16:
            np.bitwise_xor(c, d, out=mixed)
            np.bitwise_and(mixed, b, out=mixed)
            np.bitwise_xor(mixed, d, out=mixed)
        elif i < 32:
            np.bitwise_xor(b, c, out=mixed)
            np.bitwise_and(mixed, d, out=mixed)
            np.bitwise_xor(mixed, c, out=mixed)
        elif i < 48:
            # The b and c of an even step are the c and d of the next.
            if i % 2 == 0:
                differs = np.bitwise_xor(b, c, out=differs)
            np.bitwise_xor(differs, b if i % 2 else d, out=mixed)
        else:
            np.invert(d, out=mixed)
            np.bitwise_or(mixed, b, out=mixed)
            np.bitwise_xor(mixed, c, out=mixed)
        word = words[_WORDS[i]]
        np.add(a, mixed, out=a)
        if isinstance(word, int):
            np.add(a, np.array((_SINES[i] + word) & _MASK, np.uint32), out=a)
        else:
            np.add(a, word, out=a)
            np.add(a, np.array(_SINES[i], np.uint32), out=a)
        np.left_shift(a, _LEFT_BY[i], out=mixed)
        np.right_shift(a, _RIGHT_BY[i], out=a)
        np.bitwise_or(a, mixed, out=a)
        np.add(a, b, out=a)
        a, b, c, d = d, a, b, c
    return tuple((x + y) & _MASK if isinstance(y, int) else np.add(y, x, dtype=np.uint32) for x, y in zip(state, (a, b, c, d)))


@lru_cache(maxsize=2)
def _digits(at: int, start: int, stop: int) -> dict[int, np.ndarray]:
    """The decimal digits of ``start .. stop - 1``, numbers of one length, from byte ``at`` of a text on: what
    they are within each 32-bit word."""
    left = np.arange(start, stop, dtype=np.uint32 if stop <= 2**32 else np.uint64)
    words = {}
    for byte in reversed(range(at, at + len(str(start)))):
        rest = left // 10
        digit = (left - rest * 10 + ord("0")).astype(np.uint32) << (8 * (byte % 4))
        words[byte // 4] = words[byte // 4] + digit if byte // 4 in words else digit
        left = rest
    return words


def _first_words(prefixes: list[bytes], start: int, stop: int) -> list[np.ndarray]:
    """The first two words of the digests for numbers of one length, prefix by prefix."""
    at, digits = len(prefixes[0]), len(str(start))
    blocks = (at + digits + 8) // 64 + 1
    end = (bytes(digits) + b"\x80").ljust(64 * blocks - 8 - at, b"\0") + struct.pack("<Q", 8 * (at + digits))
    texts = np.frombuffer(b"".join(prefix + end for prefix in prefixes), "<u4").reshape(len(prefixes), -1)
    words = texts[0].tolist()
    for k in np.flatnonzero((texts != texts[0]).any(axis=0)).tolist():
        words[k] = np.repeat(texts[:, k], stop - start)
    for k, part in _digits(at, start, stop).items():
        words[k] = np.add(np.tile(part, len(prefixes)), words[k], dtype=np.uint32)
    state = _START
    for block in range(blocks):
        state = _after_block(state, words[16 * block : 16 * block + 16])
    return state[:2]


def uniforms(prefixes: list[str], start: int, stop: int) -> np.ndarray:
    """For each prefix and each number from ``start`` to ``stop - 1``, a number in (0, 1) from the text of both. The
    prefixes are of one length in bytes."""
    texts = [prefix.encode() for prefix in prefixes]
    out, at = np.empty((len(texts), stop - start)), start
    while at < stop:
        end = min(stop, 10 ** len(str(at)))
        first, second = _first_words(texts, at, end)
        bits = first.byteswap().astype(np.uint64) << (UNIFORM_BITS - 32)
        bits |= second.byteswap() >> (64 - UNIFORM_BITS)
        np.add(bits.reshape(len(texts), -1), 0.5, out=out[:, at - start : end - start])
        at = end
    out /= 2.0**UNIFORM_BITS
    return out
