"""Harmonic packing: pieces of like length share sequences, each task on its own.

Class k holds pieces longer than 1/(k+1) and at most 1/k of the capacity; any k of them fill
one sequence, whatever else there is. So a task needs to know nothing of others: it holds at
most k - 1 pieces of each class, and a sequence is complete with the k-th. Texts are cut so
that k pieces of a class nearly fill it: a table gives the cuts of each rest shorter than
the capacity at least cost in padding, where each further piece costs as much as some padding.
What a task cannot complete, less than one sequence of each class, goes on to fewer and fewer
tasks; the last one lays the few pieces left end to end, and cuts the last sequence into
lengths that need no padding.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.shared import written
from millrace.llm.word_ids import token_ids

#: Tasks whose unfilled sequences go on to one task.
_FAN_IN = 8


@cache
def cut_table(capacity: int, piece_cost: float) -> np.ndarray:
    """The first piece of the best cut of each length up to the capacity.

    A piece of a class with k to a sequence bears a k-th of the sequence's padding. The cost of a
    cut is the padding its pieces bear and ``piece_cost`` for each of them; of equal
    costs the longest first piece counts.
    """
    lengths = np.arange(1, capacity + 1)
    own = capacity / (capacity // lengths) - lengths + piece_cost
    best = np.zeros(capacity + 1)
    first = np.zeros(capacity + 1, np.int64)
    for length in range(1, capacity + 1):
        totals = own[:length] + best[length - 1 :: -1]
        at = length - 1 - int(np.argmin(totals[::-1]))
        best[length], first[length] = totals[at], at + 1
    return first


def cut_lengths(length: int, capacity: int, piece_cost: float) -> list[int]:
    """Lengths of the pieces of a text, in order."""
    first = cut_table(capacity, piece_cost)
    pieces = [capacity] * (length // capacity)
    left = length % capacity
    while left:
        pieces.append(int(first[left]))
        left -= pieces[-1]
    return pieces


class _Sequences:
    """Fills sequences class by class and keeps what is short of one."""

    def __init__(self, capacity: int, task: int) -> None:
        self.capacity = capacity
        self.next_id = task << 32
        self.waiting: dict[int, list[dict]] = defaultdict(list)

    def add(self, row: dict) -> list[dict]:
        """The rows of a sequence, if this one completes it."""
        each = self.capacity // row["length"]
        waiting = self.waiting[each]
        waiting.append(row)
        if len(waiting) < each:
            return []
        del self.waiting[each]
        return self.placed(waiting)

    def placed(self, rows: list[dict]) -> list[dict]:
        """The rows with their places in a sequence of their own."""
        offset = 0
        for row in rows:
            row["sequence_id"], row["offset"] = self.next_id, offset
            offset += row["length"]
        self.next_id += 1
        return rows

    def short(self) -> list[dict]:
        """Rows of unfilled sequences, longest first."""
        rows = [row for each in sorted(self.waiting) for row in self.waiting[each]]
        return sorted(rows, key=lambda row: -row["length"])


def _cut(row: dict, length: int) -> tuple[dict, dict]:
    """A piece in two, the first of a given length."""
    head, tail = dict(row), dict(row)
    head["length"], head["ids"] = length, row["ids"][: 4 * length]
    tail["start"], tail["length"] = row["start"] + length, row["length"] - length
    tail["ids"] = row["ids"][4 * length :]
    return head, tail


def _end_to_end(rows: list[dict], capacity: int) -> Iterator[list[dict]]:
    """Rows in full sequences, then in ones of as many ids as a power of two, cut to fit."""
    left = sum(row["length"] for row in rows)
    rows = rows[::-1]
    while left:
        room = capacity if left >= capacity else 1 << (left.bit_length() - 1)
        left -= room
        filled = []
        while room:
            row = rows.pop()
            if row["length"] > room:
                row, rest = _cut(row, room)
                rows.append(rest)
            room -= row["length"]
            filled.append(row)
        yield filled


def harmonic_pieces(
    docs: DataFrame,
    tokenizer: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 2048,
    end_id: int = 1,
    piece_cost: float = 8,
) -> DataFrame:
    """Rows (id, start, length, ids, doc_tokens, sequence_id, offset, level) of all texts.

    Tokens as in ``packing``: ids of words and ``end_id``, packed as little-endian 32-bit
    numbers; an empty or null text has only the end. Each text is cut by ``cut_lengths``.
    Pieces of sequences that a task could not fill have a null ``sequence_id``; ``settled``
    places them. Repeated rows are texts of their own. Other columns are left out.
    """
    id_type = docs.schema[id_col].dataType.simpleString()

    def fill(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequences = None
        schema = None
        for batch, texts in token_ids(batches, tokenizer, end_id):
            if sequences is None:
                sequences = _Sequences(capacity, batch["task"][0].as_py())
                schema = _arrow_schema(batch.schema.field("id").type)
            names = batch["id"].to_pylist()
            out = []
            for name, packed in zip(names, texts, strict=True):
                at, total = 0, len(packed) // 4
                for length in cut_lengths(total, capacity, piece_cost):
                    row = {
                        "id": name,
                        "start": at,
                        "length": length,
                        "ids": packed[4 * at : 4 * (at + length)],
                        "doc_tokens": total,
                        "level": 0,
                    }
                    out += sequences.add(row)
                    at += length
            yield pa.RecordBatch.from_pylist(out, schema)
        if sequences is not None:
            yield pa.RecordBatch.from_pylist(sequences.short(), schema)

    return docs.select(
        F.col(id_col).alias("id"),
        F.coalesce(F.encode(F.col(text_col), "UTF-8"), F.lit(b"")).alias("body"),
        F.spark_partition_id().cast("long").alias("task"),
    ).mapInArrow(fill, _schema(id_type))


def _schema(id_type: str) -> str:
    return (
        f"id {id_type}, start bigint, length bigint, ids binary, doc_tokens bigint, "
        "sequence_id bigint, offset bigint, level int"
    )


def _arrow_schema(id_type: pa.DataType) -> pa.Schema:
    whole = pa.int64()
    return pa.schema(
        [
            ("id", id_type),
            ("start", whole),
            ("length", whole),
            ("ids", pa.binary()),
            ("doc_tokens", whole),
            ("sequence_id", whole),
            ("offset", whole),
            ("level", pa.int32()),
        ]
    )


def settled(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """All rows of ``harmonic_pieces`` with a place.

    The rows should come from a written table, whose files tell how many tasks there were.
    Rows with a place pass as they are: their ``ids`` may be gone, and columns be added, which
    are null in rows placed here. ``level`` tells how often a piece was passed on.
    """
    names = _schema("string").replace(",", "").split()[::2]
    done = pieces.where("sequence_id IS NOT NULL")
    short = pieces.where("sequence_id IS NULL").select(*names)
    schema = f"{short.drop('level').schema.simpleString()[7:-1]},level:int"
    tasks = short.select(F.input_file_name()).distinct().count()
    level = 0
    while True:
        level += 1
        last = tasks <= _FAN_IN
        tasks = max(1, -(-tasks // _FAN_IN))

        def fill(
            batches: Iterable[pa.RecordBatch], level: int = level, last: bool = last
        ) -> Iterator[pa.RecordBatch]:
            sequences = None
            arrow = None
            for batch in batches:
                if not batch.num_rows:
                    continue
                if sequences is None:
                    task = level << 24 | batch["task"][0].as_py()
                    sequences = _Sequences(capacity, task)
                    arrow = _arrow_schema(batch.schema.field("id").type)
                out = []
                for row in batch.drop_columns(["task"]).to_pylist():
                    row["level"] = level
                    out += sequences.add(row)
                yield pa.RecordBatch.from_pylist(out, arrow)
            if sequences is not None:
                rows = sequences.short()
                if last:
                    rows = [
                        row
                        for filled in _end_to_end(rows, capacity)
                        for row in sequences.placed(filled)
                    ]
                yield pa.RecordBatch.from_pylist(rows, arrow)

        dealt = short.repartition(tasks).withColumn("task", F.spark_partition_id().cast("long"))
        merged = written(dealt.mapInArrow(fill, schema), "harmonic")
        done = done.unionByName(
            merged.where("sequence_id IS NOT NULL"), allowMissingColumns=True
        )
        if last:
            return done
        short = merged.where("sequence_id IS NULL")
