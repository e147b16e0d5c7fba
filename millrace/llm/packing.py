"""Packing of tokenized documents into sequences of a fixed capacity.

How many pieces there are of each length, at most as many numbers as the capacity, is all
that a plan needs. Pieces longer than a third of the capacity go first: no three fit together,
so the longest is matched with the longest that still fits beside it. Shorter ones, longest
first, then go to the smallest gap that holds them. The plan treats all sequences with the
same contents as one entry, so its work and size depend on the capacity, not on the data.
Pieces of one length are numbered across tasks, and their number finds their place.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from millrace.llm.word_ids import token_ids
from millrace.operators.numbering import free_names

#: Parts that pieces of one length are dealt to for numbering.
_PARTS = 256


def tokenized_pieces(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 4096,
    end_id: int = 1,
) -> DataFrame:
    """Rows (id, piece, start, length, ids): token ids of texts, cut where over capacity.

    ``tokenizer`` is the path of a vocabulary file that drops white space, on every
    executor; so words can be encoded one at a time. Every text ends with ``end_id``;
    an empty or null one has only that. ``ids`` packs little-endian 32-bit numbers.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in token_ids(batches, tokenizer, end_id):
            rows, pieces, starts, lengths, ids = [], [], [], [], []
            for row, packed in enumerate(texts):
                for piece, at in enumerate(range(0, len(packed), 4 * capacity)):
                    part = packed[at : at + 4 * capacity]
                    rows.append(row)
                    pieces.append(piece)
                    starts.append(at // 4)
                    lengths.append(len(part) // 4)
                    ids.append(part)
            yield pa.RecordBatch.from_arrays(
                [
                    batch["id"].take(pa.array(rows, pa.int64())),
                    pa.array(pieces, pa.int32()),
                    pa.array(starts, pa.int64()),
                    pa.array(lengths, pa.int64()),
                    pa.array(ids, pa.binary()),
                ],
                names=["id", "piece", "start", "length", "ids"],
            )

    return docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.encode(F.col(text_col), "UTF-8"), F.lit(b"")).alias("body"),
    ).mapInArrow(encode, f"id {id_type}, piece int, start bigint, length bigint, ids binary")


@dataclass
class _Alike:
    """Sequences with the same contents: (length, first number, pieces in each, offset)."""

    count: int
    gap: int
    contents: list[tuple[int, int, int, int]] = field(default_factory=list)

    def split(self, count: int) -> _Alike:
        """Takes the first sequences off."""
        taken = _Alike(count, self.gap, list(self.contents))
        self.count -= count
        self.contents = [(s, at + count * each, each, off) for s, at, each, off in self.contents]
        return taken


def plan(counts: dict[int, int], capacity: int) -> np.ndarray:
    """Where pieces go: rows (length, first number, sequence, pieces in each, offset).

    Numbers from a row's first up to the next row's fill one sequence after another.
    """
    left = {length: count for length, count in sorted(counts.items()) if count}
    used = dict.fromkeys(left, 0)
    open_by_gap: dict[int, list[_Alike]] = {}
    gaps: list[int] = []
    closed: list[_Alike] = []

    def put_back(alike: _Alike) -> None:
        if not alike.count:
            return
        if not alike.gap:
            closed.append(alike)
            return
        if alike.gap not in open_by_gap:
            bisect.insort(gaps, alike.gap)
            open_by_gap[alike.gap] = []
        open_by_gap[alike.gap].append(alike)

    def add(alike: _Alike, length: int, each: int) -> None:
        alike.contents.append((length, used[length], each, capacity - alike.gap))
        used[length] += each * alike.count
        left[length] -= each * alike.count
        alike.gap -= each * length

    large = [length for length in left if 3 * length > capacity]
    while large:
        length = large[-1]
        if not left[length]:
            large.pop()
            continue
        partner = bisect.bisect_right(large, capacity - length) - 1
        while partner >= 0 and not left[large[partner]]:
            large.pop(partner)
            partner -= 1
        if partner < 0:
            alike = _Alike(left[length], capacity)
            add(alike, length, 1)
        elif large[partner] == length:
            alike = _Alike(max(1, left[length] // 2), capacity)
            add(alike, length, min(2, left[length]))
        else:
            alike = _Alike(min(left[length], left[large[partner]]), capacity)
            other = large[partner]
            add(alike, length, 1)
            add(alike, other, 1)
        put_back(alike)

    for length in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[length]:
            at = bisect.bisect_left(gaps, length)
            if at == len(gaps):
                alike = _Alike(-(-left[length] // (capacity // length)), capacity)
            else:
                gap = gaps[at]
                alike = open_by_gap[gap].pop()
                if not open_by_gap[gap]:
                    del open_by_gap[gap]
                    gaps.pop(at)
            each = alike.gap // length
            full = min(alike.count, left[length] // each)
            rest = alike
            if full:
                filled = alike.split(full)
                add(filled, length, each)
                put_back(filled)
            if rest.count and left[length]:
                last = rest.split(1)
                add(last, length, left[length])
                put_back(last)
            put_back(rest)

    rows, sequence = [], 0
    for alike in [*closed, *(a for found in open_by_gap.values() for a in found)]:
        rows += [(length, at, sequence, each, off) for length, at, each, off in alike.contents]
        sequence += alike.count
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


_PLACE = StructType([StructField("sequence_id", LongType()), StructField("offset", LongType())])


def packed(pieces: DataFrame, capacity: int = 4096) -> DataFrame:
    """Adds sequence_id and offset to rows with a ``length`` from 1 to ``capacity``.

    The rows are read three times, so they should come from a written table. Repeated rows
    are places of their own. Sequences are gapless from 0, their ids too. Columns named like the
    added ones are replaced; others keep their names, whatever they are.
    """
    counts = {
        row["length"]: row["count"] for row in pieces.groupBy("length").count().collect()
    }
    places = plan(counts, capacity)
    part, number, size, before, place_name = free_names(
        pieces.columns, "part", "number", "size", "before", "place"
    )
    names = [name for name in pieces.columns if name.lower() not in ("sequence_id", "offset")]
    dealt = pieces.withColumn(part, F.pmod(F.xxhash64(*pieces.columns), F.lit(_PARTS)))
    group = Window.partitionBy("length", part)
    so_far = F.sum(size).over(Window.partitionBy("length").orderBy(part))
    sizes = (
        dealt.groupBy("length", part)
        .agg(F.count("*").alias(size))
        .withColumn(before, so_far - F.col(size))
        .drop(size)
    )
    first = (places[:, 0] << 44) | places[:, 1]

    @F.pandas_udf(_PLACE)
    def place(length: pd.Series, number: pd.Series) -> pd.DataFrame:
        at = np.searchsorted(first, (length.to_numpy() << 44) | number.to_numpy(), "right") - 1
        _, begin, sequence, each, offset = places[at].T
        nth = number.to_numpy() - begin
        return pd.DataFrame(
            {
                "sequence_id": sequence + nth // each,
                "offset": offset + nth % each * length.to_numpy(),
            }
        )

    row = F.row_number().over(group.orderBy(*pieces.columns)).cast("long") - 1
    numbered = dealt.withColumn(number, row).join(sizes, ["length", part])
    return numbered.withColumn(
        place_name, place("length", F.col(number) + F.col(before))
    ).select(*names, f"{place_name}.sequence_id", f"{place_name}.offset")
