"""Rolling hashes and winnowed anchors over byte buffers, in numpy."""

from __future__ import annotations

import numpy as np

_MUL = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)
_SHIFT = np.uint64(29)


def mix(values: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values one to one."""
    out = (values ^ (values >> _SHIFT)) * _MIX
    return out ^ (out >> np.uint64(32))


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    out = left * _MUL + right
    out ^= out >> _SHIFT
    out *= _MIX
    return out


def window_hashes(symbols: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of every run of ``width`` symbols, by doubling the length hashed.

    Equal runs have equal hashes wherever they stand; fewer symbols than ``width`` give none.
    """
    count = len(symbols) - width + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    power = mix(symbols.astype(np.uint64) + _MUL)
    power_width, result, result_width, rest = 1, None, 0, width
    while True:
        if rest & 1:
            if result is None:
                result, result_width = power, power_width
            else:
                length = len(symbols) - result_width - power_width + 1
                result = _joined(result[:length], power[result_width : result_width + length])
                result_width += power_width
        rest >>= 1
        if not rest:
            return result[:count]
        length = len(symbols) - 2 * power_width + 1
        power = _joined(power[:length], power[power_width : power_width + length])
        power_width *= 2


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of every ``width`` neighbours."""
    count = len(values) - width + 1
    padded = np.full(-(-len(values) // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[: len(values)] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(blocks, axis=1).ravel()
    return np.minimum(ahead[:count], behind[width - 1 : width - 1 + count])


def winnow(hashes: np.ndarray, width: int) -> np.ndarray:
    """Positions of anchors: the least hash (the first, if tied) of any ``width`` neighbours.

    Two equal stretches of ``width`` hashes have the same anchors at the same places.
    """
    if len(hashes) < width:
        return np.zeros(0, np.int64)
    bits = np.uint64(max(1, int(len(hashes)).bit_length()))
    keys = (hashes >> bits << bits) | np.arange(len(hashes), dtype=np.uint64)
    low = np.uint64((1 << int(bits)) - 1)
    least = sliding_min(keys, width) & low
    chosen = np.zeros(len(hashes), bool)
    chosen[least.astype(np.int64)] = True
    return np.flatnonzero(chosen)
