"""Number-theoretic transforms of many rows at once, exact in 64-bit floating point.

Numbers are residues modulo a prime of 23 bits, kept near zero, so that a sum of up to 256 products
is below 2^53 and a matrix product is exact. A transform is one matrix product for short
rows; longer rows are split into two factors with powers of the root between.
"""

from __future__ import annotations

from functools import cache

import numpy as np

#: 7 * 2^20 + 1, with 3 as a primitive root.
PRIME = 7340033
_ROOT = 3
MOST_POINTS = 1 << 20
_MOST_DIRECT = 6


def reduced(values: np.ndarray) -> np.ndarray:
    """Residues near zero of whole numbers below 2^53, in place."""
    near = values * (1.0 / PRIME)
    np.rint(near, out=near)
    near *= PRIME
    values -= near
    return values


@cache
def powers(points: int, inverse: bool) -> np.ndarray:
    """Powers of a root of unity of an order, by exponent."""
    root = pow(_ROOT, (PRIME - 1) // points, PRIME)
    if inverse:
        root = pow(root, -1, PRIME)
    found = np.ones(1, np.int64)
    while len(found) < points:
        found = np.concatenate([found, found * pow(root, len(found), PRIME) % PRIME])
    return reduced(found.astype(np.float64))


@cache
def _matrix(points: int, inverse: bool) -> np.ndarray:
    exponents = np.outer(np.arange(points), np.arange(points)) % points
    return powers(points, inverse)[exponents]


@cache
def _twist(first: int, second: int, inverse: bool) -> np.ndarray:
    exponents = np.outer(np.arange(first), np.arange(second))
    return powers(first * second, inverse)[exponents]


def transform(rows: np.ndarray, points: int, inverse: bool = False) -> np.ndarray:
    """The transform of each row, as if it went on with zeros up to ``points``.

    ``points`` is a power of two, and rows have that many numbers or a quarter of it. The inverse
    is not divided by the number of points.
    """
    count, given = rows.shape
    bits = points.bit_length() - 1
    if bits <= _MOST_DIRECT:
        return reduced(rows @ _matrix(points, inverse)[:given])
    first = 1 << -(-bits // -(-bits // _MOST_DIRECT))
    second = points // first
    columns = _matrix(first, inverse)[:, : given // second]
    mixed = reduced(np.matmul(columns, rows.reshape(count, -1, second)))
    mixed *= _twist(first, second, inverse)
    inner = transform(reduced(mixed).reshape(count * first, second), second, inverse)
    return inner.reshape(count, first, second).transpose(0, 2, 1).reshape(count, points)
