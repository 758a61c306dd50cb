"""Polynomial prefix hashes over byte buffers, and bitmaps of fixed size.

``C[i] = sum(T[b_j] * P**j for j < i)`` modulo 2**64, so the hash of bytes s to e is
``(C[e] - C[s]) * P**-s``: one subtraction and one product for any substring. T is a
random table and P is odd, so it has an inverse.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_RNG = np.random.default_rng(20_240_101)
_TABLE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_P = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_P, -1, 1 << 64)
_powers = {_P: np.ones(1, np.uint64), _INVERSE: np.ones(1, np.uint64)}


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1), kept from call to call."""
    have = _powers[base]
    while len(have) < n:
        have = np.concatenate([have, have * np.uint64(pow(base, len(have), 1 << 64))])
        _powers[base] = have
    return have[:n]


def prefix(raw: np.ndarray) -> np.ndarray:
    out = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_TABLE[raw] * powers(_P, len(raw)), out=out[1:])
    return out


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def span_hash(c: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of the bytes from start to end."""
    return mix((c[end] - c[start]) * powers(_INVERSE, len(c))[start])


def sliding_min(x: np.ndarray, w: int) -> np.ndarray:
    """Minimum of each w neighbours: two running minima over blocks of w."""
    n = len(x)
    if n < w:
        return x[:0]
    blocks = np.concatenate([x, np.full(-n % w, np.iinfo(x.dtype).max, x.dtype)]).reshape(-1, w)
    ahead = np.minimum.accumulate(blocks, 1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(behind[: n - w + 1], ahead[w - 1 : n])


#: Bits of a bitmap at most: 16 MB whatever the data. It only spares work; what it lets through is joined or compared exactly.
BITS = 1 << 27


def bitmap(values: DataFrame, column: str) -> np.ndarray:
    """A bit for each value of a column of 64-bit hashes: about 64 bits a value, BITS at most."""
    n = 1 << min(BITS.bit_length() - 1, max(12, (values.count() * 64).bit_length()))
    at = F.col(column).bitwiseAND(F.lit(n - 1))
    words = values.select(F.shiftright(at, 6).alias("w"), at.bitwiseAND(F.lit(63)).cast("int").alias("k"))
    got = words.groupBy("w").agg(F.bit_or(F.expr("shiftleft(1L, k)")).alias("b")).toArrow()
    out = np.zeros(n >> 6, np.int64)
    out[got["w"].to_numpy()] = got["b"].to_numpy()
    return out.view(np.uint64)


def marked(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes have their bit set."""
    at = hashes.view(np.uint64) & np.uint64((len(bits) << 6) - 1)
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
