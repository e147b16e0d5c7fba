"""Context-tree weighting over bytes, each coded as eight binary decisions.

A decision's context is the bits of the byte so far and up to ``depth`` bytes before. Every
context has counts of the bits that followed it and their Krichevsky-Trofimov probability.
Its weighted probability is the mean of that and of the product over the contexts one byte
longer, so that all depths are mixed, by how well they did in training. Trained trees are
frozen: what a bit costs in a text follows from the deepest known context on its path.

Counts come from runs of bytes, one longer than the context each. Runs that are left out
count in the context that is shorter by a byte, where they share one further context.

Contexts that end in the same bytes make a subtree, which can be weighed on its own: what the
shorter contexts need of it are sums (``subtree_sums``), what it needs of them is a ``Top``.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

#: No byte of UTF-8; marks the end of a text. Before a text stand zero bytes.
END = 0xFF
_BITS = 8


def runs(bodies: list[bytes], depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the runs that end at each byte and end mark of texts; where each text's begin."""
    start = bytes(depth)
    data = np.frombuffer(
        b"".join(part for body in bodies for part in (start, body, b"\xff")), np.uint8
    ).astype(np.int64)
    code = np.zeros(max(0, len(data) - depth), np.int64)
    for at in range(depth + 1):
        code = code << 8 | data[at : at + len(code)]
    lengths = np.array([len(body) + 1 for body in bodies], np.int64)
    firsts = np.cumsum(lengths + depth) - lengths - depth
    keep = np.ones(len(code), bool)
    for at in range(depth):
        # these end within the zero bytes ahead of the next text
        keep[firsts[1:] - depth + at] = False
    return code[keep], np.cumsum(lengths) - lengths


def counted(codes: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes and the sums of their counts."""
    code, count = np.concatenate(codes), np.concatenate(counts)
    # parts are in order, which a stable sort finds and merges
    order = np.argsort(code, kind="stable")
    code, count = code[order], count[order]
    first = np.flatnonzero(np.diff(code, prepend=-1))
    return code[first], np.add.reduceat(count, first) if len(first) else count


def _log_gamma(value: np.ndarray) -> np.ndarray:
    """Of values of a half or more: Stirling's series eight further up."""
    up = value + 8
    series = (up - 0.5) * np.log(up) - up + 0.5 * np.log(2 * np.pi)
    series += 1 / (12 * up) - 1 / (360 * up**3) + 1 / (1260 * up**5)
    for step in range(8):
        series -= np.log(value + step)
    return series


#: Log gamma of counts plus a half and plus one, for counts up to a few thousand.
_SMALL = 1 << 12
_HALVES = _log_gamma(np.arange(_SMALL) + 0.5)
_WHOLES = _log_gamma(np.arange(_SMALL) + 1.0)


def _looked_up_gamma(count: np.ndarray, table: np.ndarray, more: float) -> np.ndarray:
    found = table[np.minimum(count, _SMALL - 1).astype(np.int64)]
    large = np.flatnonzero(count >= _SMALL)
    found[large] = _log_gamma(count[large] + more)
    return found


def _log_kt(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Log of the Krichevsky-Trofimov probability of so many zeros and ones."""
    return (
        _looked_up_gamma(zeros, _HALVES, 0.5)
        + _looked_up_gamma(ones, _HALVES, 0.5)
        - np.log(np.pi)
        - _looked_up_gamma(zeros + ones, _WHOLES, 1.0)
    )


def levels_of(
    code: np.ndarray, count: np.ndarray, first: int, depth: int
) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each number of bytes before, from ``first`` to ``depth``, runs in order and their counts."""
    levels = []
    for length in range(first, depth + 1):
        key, at = np.unique(code & ((1 << 8 * (length + 1)) - 1), return_inverse=True)
        levels.append((key, np.bincount(at, count, len(key)).astype(np.int64)))
    return levels


def _counts(
    code: np.ndarray, count: np.ndarray, bit: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of contexts before a bit, bytes before and bits so far; counts of zeros and ones.

    Runs come in order, so that those of one key are neighbours.
    """
    key = code >> (_BITS - bit)
    first = np.flatnonzero(np.diff(key, prepend=-1))
    if not len(first):
        return key, np.zeros(0), np.zeros(0)
    ones = np.add.reduceat(count * (code >> (_BITS - 1 - bit) & 1), first).astype(np.float64)
    return key[first], np.add.reduceat(count, first) - ones, ones


def _weigh(bit: int, levels: list[tuple], first: int) -> tuple[list[np.ndarray], tuple]:
    """Mixes depths for one bit, from the longest contexts to those of ``first`` bytes.

    Returns each level's weights, and of the shortest contexts keys, zeros, ones and log
    probabilities.
    """
    half = np.log(0.5)
    weights: list[np.ndarray] = [None] * len(levels)
    below: tuple | None = None
    for index in range(len(levels) - 1, -1, -1):
        key, zeros, ones = levels[index]
        own = _log_kt(zeros, ones)
        if below is None:
            weighted = own
            weights[index] = np.ones(len(key))
        else:
            child, child_zeros, child_ones, child_weighted = below
            at = np.searchsorted(key, child & ((1 << 8 * (first + index) + bit) - 1))
            product = np.bincount(at, child_weighted, len(key))
            # runs that were left out share one more context
            rest_zeros = zeros - np.bincount(at, child_zeros, len(key))
            rest_ones = ones - np.bincount(at, child_ones, len(key))
            product = product + _log_kt(rest_zeros, rest_ones)
            weighted = half + np.logaddexp(own, product)
            weights[index] = np.exp(half + own - weighted)
        below = (key, zeros, ones, weighted)
    return weights, below


def _say(
    bit: int, levels: list[tuple], weights: list[np.ndarray], first: int, path: tuple | None
) -> tuple[list[tuple[np.ndarray, np.ndarray]], tuple]:
    """What the path down to each context says: chances by level, and the deepest level's path.

    A path is keys, what they say so far of a one and of a zero, and what is left for deeper ones.
    Tables hold the smaller of both chances, that of a zero as a negative number: so a chance next
    to certainty stays short of it, whatever the counts.
    """
    tables = []
    for index, (key, zeros, ones) in enumerate(levels):
        length = first + index
        if length:
            up, one, zero, left = path
            at = np.searchsorted(up, key & ((1 << 8 * (length - 1) + bit) - 1))
            one, zero, left = one[at], zero[at], left[at]
        else:
            one, zero, left = np.zeros(len(key)), np.zeros(len(key)), np.ones(len(key))
        own = left * weights[index] / (zeros + ones + 1.0)
        one = one + own * (ones + 0.5)
        zero = zero + own * (zeros + 0.5)
        left = left * (1 - weights[index])
        path = key, one, zero, left
        # deeper contexts that were never seen have even chances
        even = left * 0.5
        one_side, zero_side = one + even, zero + even
        smaller = np.where(one_side <= zero_side, one_side, -zero_side)
        tables.append((key, smaller.astype(np.float32)))
    return tables, path


def _looked_up(
    tables: list[list[tuple[np.ndarray, np.ndarray]]],
    first: int,
    code: np.ndarray,
    bit: int,
    smaller: np.ndarray,
) -> np.ndarray:
    """The smaller chance in the deepest known context of each run, or else the one given."""
    for index, table in enumerate(tables):
        key, chance = table[bit]
        if not len(key):
            continue
        wanted = (code & ((1 << 8 * (first + index + 1)) - 1)) >> (_BITS - bit)
        at = np.minimum(np.searchsorted(key, wanted), len(key) - 1)
        smaller = np.where(key[at] == wanted, chance[at], smaller)
    return smaller


def _log10_of(is_one: np.ndarray, smaller: np.ndarray) -> np.ndarray:
    """Log10 chances of bits, given the smaller of both chances as tables hold it."""
    size = np.abs(smaller)
    return np.where(is_one == (smaller > 0), np.log10(size), np.log1p(-size) / np.log(10))


def subtree_sums(levels: list[tuple], first: int) -> Iterator[tuple]:
    """For each bit keys of the contexts of ``first`` bytes, zeros, ones and log probabilities."""
    for bit in range(_BITS):
        yield _weigh(bit, [_counts(*level, bit) for level in levels], first)[1]


class Top:
    """The contexts of fewer than ``first`` bytes, above all subtrees; of a bounded size."""

    def __init__(self, sums: list[tuple], first: int) -> None:
        """``sums`` has, for each bit, keys in order of the contexts of ``first - 1`` bytes,
        zeros, ones and the sum of the log probabilities of the contexts a byte longer."""
        self.first = first
        self.tables: list[list[tuple]] = [[] for _ in range(first)]
        self.paths = []
        half = np.log(0.5)
        for bit, (key, zeros, ones, product) in enumerate(sums):
            levels = [(key, zeros, ones)]
            own = _log_kt(zeros, ones)
            weighted = half + np.logaddexp(own, product)
            weights = [np.exp(half + own - weighted)]
            for length in range(first - 2, -1, -1):
                short, at = np.unique(
                    levels[0][0] & ((1 << 8 * length + bit) - 1), return_inverse=True
                )
                product = np.bincount(at, weighted, len(short))
                zeros, ones = (np.bincount(at, n, len(short)) for n in levels[0][1:])
                own = _log_kt(zeros, ones)
                weighted = half + np.logaddexp(own, product)
                levels.insert(0, (short, zeros, ones))
                weights.insert(0, np.exp(half + own - weighted))
            tables, path = _say(bit, levels, weights, 0, None)
            for length, table in enumerate(tables):
                self.tables[length].append(table)
            self.paths.append(path)


class _Remembered:
    """Scores of runs in a hash table, for looking up most bytes in one step."""

    depth: int

    def _chances(self, code: np.ndarray) -> np.ndarray:
        raise NotImplementedError

    def _remember(self, code: np.ndarray, score: np.ndarray) -> None:
        """Two tables of slots with a run and its score side by side; the second for what
        finds no place in the first."""
        self.places = []
        for _ in range(_TABLES):
            bits = max(8, int(len(code)).bit_length() + 1)
            slots = np.full((1 << bits, 2), -1, np.int64)
            shift = np.uint64(64 - bits)
            at = _slot(code, len(self.places), shift)
            slots[at, 0] = code
            filled = slots[at, 0] == code
            slots[at[filled], 1] = score[filled].astype(np.float64).view(np.int64)
            # one gather of sixteen bytes finds both
            self.places.append((slots.reshape(-1).view(np.complex128), shift))
            code, score = code[~filled], score[~filled]

    def log10(self, code: np.ndarray) -> np.ndarray:
        """Log10 probability of the byte that ends each run."""
        total = np.empty(len(code))
        left, wanted = None, code
        for number, (slots, shift) in enumerate(self.places):
            found = slots[_slot(wanted, number, shift)].view(np.int64).reshape(-1, 2)
            score = np.ascontiguousarray(found[:, 1]).view(np.float64)
            other = np.flatnonzero(found[:, 0] != wanted)
            if left is None:
                total = score
            else:
                total[left] = score
            left = other if left is None else left[other]
            wanted = wanted[other]
        if len(wanted):
            distinct, back = np.unique(wanted, return_inverse=True)
            total[left] = self._chances(distinct)[back]
        return total


#: Tables in which a run may have its place; an odd multiplier for each.
_TABLES = 2
_SPREAD = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))


def _slot(code: np.ndarray, table: int, shift: np.uint64) -> np.ndarray:
    return (code.astype(np.uint64) * _SPREAD[table] >> shift).astype(np.int64)


class RunScores(_Remembered):
    """Known scores of all runs that will be asked for."""

    def __init__(self, code: np.ndarray, score: np.ndarray, depth: int) -> None:
        self.depth = depth
        self.code, first = np.unique(code, return_index=True)
        self.score = score[first]
        self._remember(self.code, self.score)

    def _chances(self, code: np.ndarray) -> np.ndarray:
        return self.score[np.searchsorted(self.code, code)]


class ContextTrees(_Remembered):
    """Frozen trees: for each context and bits so far, the probability that the next is one."""

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray]], top: Top | None = None) -> None:
        """``levels`` has, for each number of bytes before, runs in order and their counts.

        A run may be left out when all that end in it are. With a ``top`` they are the
        levels of whole subtrees below it.
        """
        self.top = top
        self.first = top.first if top else 0
        self.depth = self.first + len(levels) - 1
        self.tables: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in levels]
        for bit in range(_BITS):
            counts = [_counts(*level, bit) for level in levels]
            weights, _ = _weigh(bit, counts, self.first)
            tables, _ = _say(bit, counts, weights, self.first, top.paths[bit] if top else None)
            for index, table in enumerate(tables):
                self.tables[index].append(table)
        self._remember(levels[-1][0], self._chances(levels[-1][0]))

    def _chances(self, code: np.ndarray) -> np.ndarray:
        """Log10 probability of the last byte of each run, by looking up all its decisions."""
        total = np.zeros(len(code))
        for bit in range(_BITS):
            smaller = np.full(len(code), 0.5)
            if self.top:
                smaller = _looked_up(self.top.tables, 0, code, bit, smaller)
            smaller = _looked_up(self.tables, self.first, code, bit, smaller)
            total += _log10_of((code >> (_BITS - 1 - bit) & 1) == 1, smaller)
        return total


def text_scores(trees: ContextTrees | RunScores, bodies: Iterable[bytes]) -> Iterator[float]:
    """Log10 probability of each text and its end; divided by -log10(2) it is a length in bits."""
    bodies = list(bodies)
    if bodies:
        code, first = runs(bodies, trees.depth)
        yield from np.add.reduceat(trees.log10(code), first).tolist()
