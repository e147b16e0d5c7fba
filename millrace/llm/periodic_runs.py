"""Maximal periodic runs of words, found by block convolution at dyadic scales.

A run of period q that is at least 2 q long holds, at the scale b with 2 b <= q < 4 b, a whole
block of b words that occurs again q words later. At each scale the squared
differences of every block with all places of the words after it come from one convolution, a
number-theoretic transform for each block; a difference of zero is a seed. Seeds are compared word by
word, neighbouring seeds of one distance are joined, and what is joined is extended to both sides
by less than a block. Seeds inside a run whose period divides their distance say nothing new
and are left out, so that a text of one word over and over costs no more than others.
Texts are worked on together, the longest first, with a word of its own after each.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.blocks import text_chunks
from millrace.llm.residues import MOST_POINTS, PRIME, powers, reduced, transform
from millrace.llm.words import words

#: Shortest run, in words.
LEAST_LENGTH = 12
#: Bytes of texts that are worked on together.
_CHUNK = 1 << 19
#: Numbers in the arrays of one step.
_STEP = 1 << 18


def _zero_places(values: np.ndarray, size: int, ahead: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of blocks and distances at which their difference from the words there is zero.

    Distances run from ``ahead + 1`` up to ``ahead + 3`` blocks, from one word on for blocks of one
    word. Zero is meant modulo the prime.
    """
    points = 4 * size
    low, high = (0, 3) if size == 1 else (size, 3 * size)
    blocks = -(-len(values) // size)
    padded = np.zeros((blocks + ahead + 4) * size)
    padded[: len(values)] = values
    padded = reduced(padded)
    sums = np.concatenate([[0.0], np.cumsum(reduced(padded * padded))])
    quarter = powers(4, False)[np.outer(np.arange(4), np.arange(points)) % 4]
    mirror = -np.arange(points) % points
    scale = pow(points, -1, PRIME)
    step = max(8, _STEP // points)
    starts, distances = [], []
    for begin in range(0, blocks, step):
        count = min(step, blocks - begin)
        own = slice(begin * size, (begin + count) * size)
        later = slice((begin + ahead) * size, (begin + ahead + count + 3) * size)
        ahead_of = transform(padded[later].reshape(-1, size), points)
        window = ahead_of[:count] * quarter[0]
        for part in range(1, 4):
            window += ahead_of[part : part + count] * quarter[part]
        reduced(window)
        product = transform(padded[own].reshape(-1, size), points)[:, mirror]
        product *= window
        products = transform(reduced(product), points, inverse=True)[:, low:high]
        at = np.arange(begin, begin + count)[:, None] * size
        there = at + ahead * size + np.arange(low, high)
        squares = sums[at + size] - sums[at] + sums[there + size] - sums[there]
        squares -= 2 * reduced(products * scale)
        block, place = np.nonzero(reduced(squares) == 0)
        starts.append((begin + block) * size)
        distances.append(ahead * size + low + place)
    return np.concatenate(starts), np.concatenate(distances)


def _matches(
    values: np.ndarray, places: np.ndarray, distances: np.ndarray, steps: np.ndarray
) -> Iterator[tuple[slice, np.ndarray]]:
    """Whether words at places plus steps equal those a distance later; none beyond the ends do."""
    rows = max(1, _STEP // len(steps))
    for begin in range(0, len(places), rows):
        part = slice(begin, begin + rows)
        here = places[part, None] + steps
        there = here + distances[part, None]
        inside = (here >= 0) & (there < len(values))
        same = values[np.where(inside, here, 0)] == values[np.where(inside, there, 0)]
        yield part, inside & same


def _reach(
    values: np.ndarray, places: np.ndarray, distances: np.ndarray, steps: np.ndarray
) -> np.ndarray:
    """How many steps match before the first that does not."""
    found = np.zeros(len(places), np.int64)
    if len(steps):
        for part, same in _matches(values, places, distances, steps):
            found[part] = np.where(same.all(axis=1), len(steps), np.argmin(same, axis=1))
    return found


def _extended(
    values: np.ndarray,
    starts: np.ndarray,
    distances: np.ndarray,
    size: int,
    known: dict[tuple[int, int], int],
    least: int,
) -> None:
    """Adds the runs that seeds belong to, (start, end) to period."""
    inside = starts + distances + size <= len(values)
    starts, distances = starts[inside], distances[inside]
    told = np.zeros(len(starts), bool)
    for (begin, end), period in known.items():
        low, high = np.searchsorted(starts, [begin, end])
        if low < high:
            told[low:high] |= (starts[low:high] + distances[low:high] + size <= end) & (
                distances[low:high] % period == 0
            )
    starts, distances = starts[~told], distances[~told]
    same = np.zeros(len(starts), bool)
    for part, found in _matches(values, starts, distances, np.arange(size)):
        same[part] = found.all(axis=1)
    starts, distances = starts[same], distances[same]
    order = np.lexsort((starts, distances))
    starts, distances = starts[order], distances[order]
    joined = np.zeros(len(starts), bool)
    joined[1:] = (np.diff(distances) == 0) & (np.diff(starts) == size)
    heads = np.flatnonzero(~joined)
    tails = np.append(heads[1:], len(starts)) - 1 if len(heads) else heads
    first, last, period = starts[heads], starts[tails], distances[heads]
    needed = np.maximum(least, 2 * period) - period
    hopeful = last - first + size + 2 * (size - 1) >= needed
    first, last, period = first[hopeful], last[hopeful], period[hopeful]
    first = first - _reach(values, first, period, -np.arange(1, size))
    last = last + size + _reach(values, last + size, period, np.arange(size - 1)) + period
    for begin, end, each in zip(first.tolist(), last.tolist(), period.tolist(), strict=True):
        if end - begin >= max(least, 2 * each):
            known.setdefault((begin, end), each)


def word_runs(
    texts: Sequence[Sequence[bytes]], least: int = LEAST_LENGTH
) -> list[list[tuple[int, int, int]]]:
    """All runs (start, length, period) of each text's words, by start, then period.

    A run is a longest stretch with its smallest period, and at least ``least`` words and two
    periods long.
    """
    order = sorted(
        (at for at, text in enumerate(texts) if len(text) >= least), key=lambda at: -len(texts[at])
    )
    result: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    if not order:
        return result
    numbers = {word: at for at, word in enumerate(set(chain.from_iterable(texts)))}
    sizes = np.array([len(texts[at]) for at in order])
    ends = np.cumsum(sizes + 1)
    values = np.empty(ends[-1], np.int64)
    stops = ends - 1
    values[stops] = len(numbers) + np.arange(len(order))
    ordinary = np.ones(len(values), bool)
    ordinary[stops] = False
    values[ordinary] = np.fromiter(
        map(numbers.__getitem__, chain.from_iterable(texts[at] for at in order)),
        np.int64,
        int(sizes.sum()),
    )
    known: dict[tuple[int, int], int] = {}
    size = 1
    while True:
        long_enough = int(np.searchsorted(-sizes, -4 * size, "right"))
        if not long_enough:
            break
        ahead = 1
        while long_enough:
            part = values[: ends[long_enough - 1]]
            seeds = _zero_places(part + 1.0, size, ahead)
            _extended(part, *seeds, size, known, least)
            if 8 * size <= MOST_POINTS:
                break
            # no larger transform: the same blocks, farther ahead
            ahead += 2
            long_enough = int(np.searchsorted(-sizes, -2 * (ahead + 1) * size, "right"))
        size *= 2
        if 4 * size > MOST_POINTS:
            break
    begins = ends - sizes - 1
    for (begin, end), period in known.items():
        at = int(np.searchsorted(ends, begin, "right"))
        result[order[at]].append((begin - int(begins[at]), end - begin, period))
    for found in result:
        found.sort(key=lambda run: (run[0], run[2]))
    return result


def collapsed(text: Sequence[bytes], runs: Iterable[tuple[int, int, int]]) -> bytes:
    """Words joined by spaces, without those a run holds after its first period."""
    dropped = np.zeros(len(text) + 1, np.int64)
    for start, length, period in runs:
        dropped[start + period] += 1
        dropped[start + length] -= 1
    gone = np.cumsum(dropped[:-1]) > 0
    if not gone.any():
        return b" ".join(text)
    return b" ".join([text[at] for at in np.flatnonzero(~gone).tolist()])


_RUNS = pa.list_(
    pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
)


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST_LENGTH
) -> DataFrame:
    """Rows (id, n_words, runs, collapsed): runs of each text's words, and the text without repeats.

    ``collapsed`` is UTF-8 in binary. Null, empty and blank texts have no words and no runs;
    each row is a text of its own, repeated or not; a long text is worked on whole, in arrays that
    grow with its length only. Other columns are left out, whatever their names.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def find(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high in text_chunks(batch["body"], _CHUNK):
                texts = [words(body) for body in batch["body"][low:high].to_pylist()]
                found = word_runs(texts, least)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch["id"][low:high],
                        pa.array([len(text) for text in texts], pa.int64()),
                        pa.array([list(map(_named, runs)) for runs in found], _RUNS),
                        pa.array(map(collapsed, texts, found), pa.binary()),
                    ],
                    names=["id", "n_words", "runs", "collapsed"],
                )

    return docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.encode(F.col(text_col), "UTF-8"), F.lit(b"")).alias("body"),
    ).mapInArrow(
        find,
        f"id {id_type}, n_words bigint, "
        "runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed binary",
    )


def _named(run: tuple[int, int, int]) -> dict[str, int]:
    return dict(zip(("start", "length", "period"), run, strict=True))
