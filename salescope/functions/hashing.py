"""Reproducible randomness: every random choice is an md5 of (seed, key)."""

from __future__ import annotations

from collections.abc import Sequence
from math import floor, sin

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def md5_of(seed: int | str, *parts: Column) -> Column:
    """Hex md5 of ``seed:part:part...``."""
    pieces = [F.lit(str(seed))] + [p.cast("string") for p in parts]
    return F.md5(F.concat_ws(":", *pieces).cast("binary"))


def hex_bucket(h: Column, digits: int) -> Column:
    """Leading hex digits as an integer; monotone in the hex string."""
    return F.conv(F.substring(h, 1, digits), 16, 10).cast("int")


def hex_uint32(h: Column) -> Column:
    """First 32 bits of a hex digest as a bigint in [0, 2**32)."""
    return F.conv(F.substring(h, 1, 8), 16, 10).cast("bigint")


def hex_fraction(h: Column) -> Column:
    """The first 52 bits of a hex digest as a number in [0, 1); monotone in the hex string."""
    return F.conv(F.substring(h, 1, 13), 16, 10).cast("bigint") / F.lit(float(2 ** 52))


_SHIFTS = [(7, 12, 17, 22), (5, 9, 14, 20), (4, 11, 16, 23), (6, 10, 15, 21)]
_SINES = [floor(abs(sin(i + 1)) * 2**32) for i in range(64)]
_START = (0x67452301, 0xEFCDAB89, 0x98BADCFE, 0x10325476)


def md5_words(parts: Sequence[bytes | np.ndarray], n: int) -> list[np.ndarray]:
    """The md5 of ``n`` messages of equal length in arrays: the four 32-bit words of each digest, as in its hex form.

    A part of a message is the same bytes for all or a matrix of bytes with a row for each.
    """
    columns: list = []
    for part in parts:
        columns += list(part) if isinstance(part, bytes) else [part[:, i].astype(np.uint32) for i in range(part.shape[1])]
    length = len(columns)
    columns += [0x80, *[0] * (-(length + 9) % 64), *(8 * length).to_bytes(8, "little")]

    def word(four: list) -> np.ndarray:  # bytes that all messages share add up to one number
        out = np.array([sum(c << (8 * i) for i, c in enumerate(four) if isinstance(c, int))], np.uint32)
        for i, c in enumerate(four):
            if not isinstance(c, int):
                out = out | (c << np.uint32(8 * i))
        return out

    state = [np.full(n, s, np.uint32) for s in _START]
    for at in range(0, len(columns), 64):
        words = [word(columns[i : i + 4]) for i in range(at, at + 64, 4)]
        a, b, c, d = state
        for i in range(64):
            if i < 16:
                f, g = d ^ (b & (c ^ d)), i
            elif i < 32:
                f, g = c ^ (d & (b ^ c)), (5 * i + 1) % 16
            elif i < 48:
                f, g = b ^ c ^ d, (3 * i + 5) % 16
            else:
                f, g = c ^ (b | ~d), 7 * i % 16
            f += a
            f += words[g] + np.uint32(_SINES[i])
            shift = _SHIFTS[i // 16][i % 4]
            turned = f << np.uint32(shift)
            f >>= np.uint32(32 - shift)
            turned |= f
            turned += b
            a, d, c, b = d, c, b, turned
        state = [s + x for s, x in zip(state, (a, b, c, d))]
    return [s.byteswap() for s in state]


def digits_of(numbers: np.ndarray, width: int) -> np.ndarray:
    """The decimal digits, as bytes, of numbers that have ``width`` of them."""
    return np.stack([numbers // 10**i % 10 + 48 for i in range(width - 1, -1, -1)], axis=1).astype(np.uint8)
