"""Benchmark items found in documents by greedy string tiling.

Items are joined with texts by seeds, runs of a few words that both have. What a text has of
an item, in the runs of words that seeds cover, is then tiled: the longest match of words not
yet in a tile becomes the next tile, again and again, with Karp-Rabin hashes of falling lengths
to find it. Tiles may come in any order, so passages that were moved about count too. A text is
contaminated by an item when tiles cover enough of the item.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    DoubleType,
    LongType,
    StructField,
    StructType,
)

#: Bytes of ASCII other than letters and digits part words.
_WORD_BYTES = bytes(
    value if value >= 128 or chr(value).isalnum() else 32 for value in range(256)
)
_PRIME = (1 << 61) - 1
_BASE = 1_000_003


def plain_words(text: str) -> list[bytes]:
    """Words in small letters, without ASCII punctuation."""
    return text.lower().encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()


def greedy_tiles(item: list, runs: list[list], least: int) -> list[tuple[int, int, int, int]]:
    """Tiles (place in item, run, place in run, length) of ``least`` words or more.

    Search lengths fall from the longest that is possible by halves. Windows of unmarked
    words of the runs are hashed by Karp-Rabin, looked up for windows of the item, and a
    match is followed on while words agree. If one turns out twice as long as searched for, the search starts
    again at that length. Matches become tiles longest first, unless one before took a word.
    """
    free_item = [True] * len(item)
    free_runs = [[True] * len(run) for run in runs]
    tiles = []
    length = min(len(item), max((len(run) for run in runs), default=0))
    while length >= least:
        matches = _matches(item, free_item, runs, free_runs, length)
        longest = max((match[3] for match in matches), default=0)
        if longest > 2 * length:
            length = longest
            continue
        for at, run, place, size in sorted(matches, key=lambda m: (-m[3], m[0], m[1], m[2])):
            mine, theirs = free_item[at : at + size], free_runs[run][place : place + size]
            if all(mine) and all(theirs):
                free_item[at : at + size] = [False] * size
                free_runs[run][place : place + size] = [False] * size
                tiles.append((at, run, place, size))
        if length == least:
            # a match cut by a tile may still leave enough words
            if not matches:
                break
            continue
        length = max(least, length // 2)
    return tiles


def _windows(values: list, free: list[bool], size: int) -> Iterator[tuple[int, int]]:
    """Place and rolling hash of each window of unmarked values."""
    top = pow(_BASE, size, _PRIME)
    current = count = 0
    for index, value in enumerate(values):
        if not free[index]:
            current = count = 0
            continue
        current = (current * _BASE + value) % _PRIME
        count += 1
        if count > size:
            current = (current - values[index - size] * top) % _PRIME
        if count >= size:
            yield index - size + 1, current


def _matches(
    item: list, free_item: list[bool], runs: list[list], free_runs: list[list[bool]], size: int
) -> list[tuple[int, int, int, int]]:
    places: dict[int, list[tuple[int, int]]] = {}
    for run, values in enumerate(runs):
        for place, hashed in _windows(values, free_runs[run], size):
            places.setdefault(hashed, []).append((run, place))
    found = []
    for at, hashed in _windows(item, free_item, size):
        for run, place in places.get(hashed, ()):
            values, free = runs[run], free_runs[run]
            length = 0
            while (
                at + length < len(item)
                and place + length < len(values)
                and item[at + length] == values[place + length]
                and free_item[at + length]
                and free[place + length]
            ):
                length += 1
            if length >= size:
                found.append((at, run, place, length))
    return found


class Items:
    """Benchmark items in a form to find in texts; small enough to be sent to all tasks."""

    def __init__(self, items: list[tuple], seed: int) -> None:
        self.seed = seed
        numbers: dict[bytes, int] = {}
        self.ids, self.words = [], []
        self.seeds: dict[tuple, list[int]] = {}
        for name, text in items:
            found = plain_words(text or "")
            if len(found) < seed:
                continue
            index = len(self.ids)
            self.ids.append(name)
            self.words.append([numbers.setdefault(word, len(numbers) + 1) for word in found])
            for window in set(_tuples(found, seed)):
                self.seeds.setdefault(window, []).append(index)
        self.numbers = numbers
        self.keys = self.seeds.keys()

    def covered(self, text: str) -> list[tuple[int, list[tuple[int, int, int, int]]]]:
        """Items that share seeds with a text, with their tiles."""
        found = plain_words(text)
        if self.keys.isdisjoint(_tuples(found, self.seed)):
            return []
        places: dict[int, list[int]] = {}
        for place, window in enumerate(_tuples(found, self.seed)):
            for index in self.seeds.get(window, ()):
                places.setdefault(index, []).append(place)
        result = []
        for index, starts in places.items():
            runs, end = [], -1
            for start in starts:
                if start > end:
                    runs.append([])
                    end = start
                runs[-1] += [self.numbers[word] for word in found[end : start + self.seed]]
                end = start + self.seed
            result.append((index, greedy_tiles(self.words[index], runs, self.seed)))
        return result


def _tuples(found: list[bytes], size: int) -> Iterator[tuple]:
    return zip(*(found[start:] for start in range(size)), strict=False)


def _blocks(
    benchmark: DataFrame, item_col: str, text_col: str, seed: int, block_chars: int
) -> Iterator[Items]:
    """The items in blocks of about ``block_chars`` characters, each with a bounded size."""
    total = benchmark.agg(F.sum(F.length(text_col))).first()[0] or 0
    count = 1 + total // block_chars
    block = F.pmod(F.xxhash64(item_col, text_col), F.lit(count))
    for number in range(count):
        rows = benchmark.where(block == number).select(item_col, text_col).distinct().collect()
        yield Items(sorted(map(tuple, rows), key=repr), seed)


def _leaks(items: Items, id_type, least_percent: int):
    """A function of a text column: the items that contaminate a text."""
    found = StructType(
        [
            StructField("item_id", id_type),
            StructField("item_words", LongType()),
            StructField("covered_words", LongType()),
            StructField("coverage", DoubleType()),
            StructField("n_tiles", LongType()),
            StructField("longest_tile", LongType()),
        ]
    )

    def of(text: str | None) -> list[dict]:
        rows = []
        for index, tiles in items.covered(text) if text else ():
            size = len(items.words[index])
            covered = sum(tile[3] for tile in tiles)
            if 100 * covered >= least_percent * size:
                rows.append(
                    {
                        "item_id": items.ids[index],
                        "item_words": size,
                        "covered_words": covered,
                        "coverage": covered / size,
                        "n_tiles": len(tiles),
                        "longest_tile": max(tile[3] for tile in tiles),
                    }
                )
        return rows

    @F.pandas_udf(ArrayType(found))
    def leaks(texts: pd.Series) -> pd.Series:
        return pd.Series([of(text) for text in texts], dtype=object)

    return leaks


def _leak_columns(
    docs: DataFrame, benchmark: DataFrame, text_col: str, item_col: str, item_text_col: str,
    seed: int, least_percent: int, block_chars: int,
) -> Iterator[Column]:
    for items in _blocks(benchmark, item_col, item_text_col, seed, block_chars):
        yield _leaks(items, benchmark.schema[item_col].dataType, least_percent)(text_col)


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    seed: int = 4,
    least_percent: int = 50,
    block_chars: int = 16_000_000,
) -> DataFrame:
    """Rows (id, item_id, item_words, covered_words, coverage, n_tiles, longest_tile).

    There is one for each text and item of which tiles of ``seed`` words or more cover
    ``least_percent`` or more. Words differ by neither case nor punctuation. Null and empty
    texts, and items of fewer than ``seed`` words, are in no row; repeated rows of documents
    have rows each, repeated items one. Documents are read once for each block of items
    and never shuffled.
    """
    found = None
    columns = _leak_columns(
        docs, benchmark, text_col, item_col, item_text_col, seed, least_percent, block_chars
    )
    for column in columns:
        rows = docs.select(F.col(id_col).alias("id"), F.explode(column).alias("leak")).select(
            "id", "leak.*"
        )
        found = rows if found is None else found.unionByName(rows)
    return found


def without_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    seed: int = 4,
    least_percent: int = 50,
    block_chars: int = 16_000_000,
) -> DataFrame:
    """The documents that no item contaminates, as told by ``leaks``, all columns kept."""
    columns = _leak_columns(
        docs, benchmark, text_col, item_col, item_text_col, seed, least_percent, block_chars
    )
    for column in columns:
        docs = docs.where(F.size(column) == 0)
    return docs
