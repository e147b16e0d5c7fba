"""Removal of byte strings that occur more than once, by sorted suffixes around shared anchors.

Any two equal strings of ``width`` bytes have an anchor, a run of ``gram`` bytes picked by
winnowing, at the same place. So documents first tell their anchors' hashes; only anchors
seen twice matter. All strings of ``width`` bytes around an anchor lie in its context, the
``width - gram`` bytes to either side. Where a whole context is seen twice, all its strings
are repeated. Anchors seen in several different contexts have these sent to one task, which
sorts the suffixes from the anchors to the right and, reversed, to the left (see
``suffix_groups``); common prefixes of neighbours in both orders tell which strings match.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.blocks import BLOCK_SCHEMA, bucket_count, from_blocks, text_chunks, to_blocks
from millrace.llm.hashing import mix, window_hashes, winnow
from millrace.llm.shared import written
from millrace.llm.suffix_groups import suffix_array

#: An anchor: hashes of its bytes and of its context, where it is, the bytes of context to
#: either side (fewer at the ends of a text), and whether the context was seen before.
_ANCHOR = np.dtype(
    [
        ("gram", "u8"),
        ("around", "u8"),
        ("row", "i8"),
        ("at", "u4"),
        ("left", "u2"),
        ("right", "u2"),
        ("many", "u1"),
    ]
)
_SPAN = np.dtype([("row", "i8"), ("start", "i8"), ("end", "i8")])
#: Kinds of block rows.
_ANCHORS, _SPANS, _CONTEXTS = 0, 1, 2
#: Anchors held by a task before equal ones are put together.
_HELD = 4_000_000
#: Above all bytes of UTF-8; marks what lies beyond an end of a text.
_BEYOND = 0xFF

_SPAN_LIST = "array<struct<start: bigint, end: bigint>>"


def _row_key(id_col: str, text_col: str) -> Column:
    """A row's identity; rows alike in both columns share it, and are copies of each other."""
    return F.xxhash64(F.col(id_col), F.col(text_col))


def repeated_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 200
) -> DataFrame:
    """Rows (row_key, spans binary): parts of texts covered by repeated strings, unmerged.

    A text that is null, empty or shorter than ``width`` bytes has no row. Rows repeated as
    a whole are copies of each other like any others. ``spans`` packs 64-bit (start, end).
    """
    gram = width // 2
    side = width - gram
    buckets = bucket_count(docs.sparkSession)
    keyed = docs.select(
        _row_key(id_col, text_col).alias("row_key"),
        F.encode(F.col(text_col), "UTF-8").alias("body"),
    ).where(F.length("body") >= width)

    def anchors(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            keys = np.asarray(batch["row_key"])
            for low, high in text_chunks(batch["body"]):
                found = _anchors(keys[low:high], batch["body"][low:high], gram, side)
                held.append(found)
                count += len(found)
                if count >= _HELD:
                    yield from _told(held, side, gram, buckets)
                    held, count = [], 0
        yield from _told(held, side, gram, buckets)

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = from_blocks(batches, {_ANCHORS: _ANCHOR, _SPANS: _SPAN})
        spans, wanted = _compared(found[_ANCHORS], gram, side)
        yield from _by_row(np.concatenate([found[_SPANS], spans]), _SPANS)
        yield from _by_row(wanted, _CONTEXTS)

    told = written(
        keyed.mapInArrow(anchors, BLOCK_SCHEMA)
        .repartition("bucket")
        .mapInArrow(compare, "kind int, row_key bigint, payload binary"),
        "anchors",
    )
    wanted = (
        told.where(F.col("kind") == _CONTEXTS)
        .groupBy("row_key")
        .agg(F.collect_list("payload").alias("wanted"))
    )
    context = _context_type(side)

    def contexts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [
                _contexts(key, body.as_buffer(), b"".join(parts.as_py()), gram, side, context)
                for key, body, parts in zip(
                    batch["row_key"].to_pylist(), batch["body"], batch["wanted"], strict=True
                )
            ]
            if made:
                records = np.concatenate(made)
                yield from to_blocks(records, mix(records["gram"]), buckets)

    def sort(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        records = from_blocks(batches, {0: context})[0]
        yield from _by_row(_sorted_spans(records, gram, side), _SPANS)

    sorted_spans = (
        keyed.join(wanted, "row_key")
        .mapInArrow(contexts, BLOCK_SCHEMA)
        .repartition("bucket")
        .mapInArrow(sort, "kind int, row_key bigint, payload binary")
    )
    return (
        told.where(F.col("kind") == _SPANS)
        .unionByName(sorted_spans)
        .select("row_key", F.col("payload").alias("spans"))
    )


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 200
) -> DataFrame:
    """Rows (id, n_bytes, spans, kept): each text without bytes that a repeated string covers.

    A string of ``width`` bytes is repeated when it starts at another place too, in any text;
    occurrences may overlap. ``spans`` has the maximal removed runs, byte offsets with the end
    exclusive, and ``kept`` the bytes that are left, which may cut a character. One row comes
    out for each row that goes in; a null text counts as empty. Other columns are ignored.
    """
    spans = (
        repeated_spans(docs, id_col, text_col, width)
        .groupBy("row_key")
        .agg(F.collect_list("spans").alias("found"))
    )
    whole = docs.select(
        F.col(id_col).alias("id"),
        _row_key(id_col, text_col).alias("row_key"),
        F.coalesce(F.encode(F.col(text_col), "UTF-8"), F.lit(b"")).alias("body"),
    )

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, lists, bodies = [], [], []
            for body, found in zip(batch["body"], batch["found"], strict=True):
                data = body.as_py()
                runs = _merged(np.frombuffer(b"".join(found.as_py() or ()), "i8").reshape(-1, 2))
                at, kept = 0, []
                for start, end in runs:
                    kept.append(data[at:start])
                    at = end
                kept.append(data[at:])
                sizes.append(len(data))
                lists.append([{"start": start, "end": end} for start, end in runs])
                bodies.append(b"".join(kept))
            yield pa.RecordBatch.from_arrays(
                [
                    batch["id"],
                    pa.array(sizes, pa.int64()),
                    pa.array(
                        lists,
                        pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])),
                    ),
                    pa.array(bodies, pa.binary()),
                ],
                names=["id", "n_bytes", "spans", "kept"],
            )

    id_type = docs.schema[id_col].dataType.simpleString()
    return (
        whole.join(spans, "row_key", "left")
        .select("id", "body", "found")
        .mapInArrow(cut, f"id {id_type}, n_bytes bigint, spans {_SPAN_LIST}, kept binary")
    )


def _anchors(keys: np.ndarray, bodies: pa.Array, gram: int, side: int) -> np.ndarray:
    """Anchors of some texts laid end to end; a few more than needed at their borders."""
    texts = [body.as_buffer() for body in bodies]
    ends = np.cumsum([len(text) for text in texts])
    starts = np.concatenate([[0], ends[:-1]])
    data = b"".join(texts)
    symbols = np.frombuffer(data, np.uint8)
    grams = window_hashes(symbols, gram)
    at = winnow(grams, side + 1)
    text = np.searchsorted(ends, at, "right")
    inside = at + gram <= ends[text]
    at, text = at[inside], text[inside]
    start, end = starts[text], ends[text]
    low, high = np.maximum(start, at - side), np.minimum(end, at + gram + side)
    whole = window_hashes(symbols, gram + 2 * side)
    around = np.zeros(len(at), np.uint64)
    full = high - low == gram + 2 * side
    around[full] = whole[low[full]]
    for index in np.flatnonzero(~full):
        left, right = at[index] - low[index], high[index] - at[index]
        around[index] = xxhash.xxh3_64_intdigest(
            data[low[index] : high[index]], seed=int(left << 20 | right)
        )
    found = np.zeros(len(at), _ANCHOR)
    found["gram"], found["around"] = grams[at], around
    found["row"], found["at"] = keys[text], at - start
    found["left"], found["right"] = at - low, high - at - gram
    return found


def _told(held: list, side: int, gram: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Anchors of a task as blocks: of those with the same context only one, marked."""
    if not held:
        return
    anchors = np.concatenate(held)
    anchors = anchors[np.lexsort((anchors["around"], anchors["gram"]))]
    first, size = _runs(anchors, ("gram", "around"))
    seen = np.repeat(size > 1, size)
    anchors["many"] |= seen
    yield from to_blocks(anchors[first], anchors["gram"][first], buckets, _ANCHORS)
    spans = _merged_by_row(_whole_spans(anchors[seen], gram, side))
    yield from to_blocks(spans, mix(spans["row"].astype(np.uint64)), buckets, _SPANS)


def _runs(records: np.ndarray, names: tuple[str, ...]) -> tuple[np.ndarray, np.ndarray]:
    """First index and length of each run of records alike in some fields."""
    new = np.ones(len(records), bool)
    if len(records):
        new[1:] = np.any([records[n][1:] != records[n][:-1] for n in names], axis=0)
    first = np.flatnonzero(new)
    return first, np.diff(first, append=len(records))


def _whole_spans(anchors: np.ndarray, gram: int, side: int) -> np.ndarray:
    """Spans of all strings in contexts known to be repeated."""
    anchors = anchors[anchors["left"].astype(np.int64) + anchors["right"] >= side]
    spans = np.zeros(len(anchors), _SPAN)
    spans["row"] = anchors["row"]
    spans["start"] = anchors["at"].astype(np.int64) - anchors["left"]
    spans["end"] = anchors["at"].astype(np.int64) + gram + anchors["right"]
    return spans


def _compared(anchors: np.ndarray, gram: int, side: int) -> tuple[np.ndarray, np.ndarray]:
    """Spans settled by counting contexts, and the anchors whose contexts must be compared."""
    anchors = anchors[np.lexsort((anchors["around"], anchors["gram"]))]
    first, size = _runs(anchors, ("gram", "around"))
    seen = size > 1
    np.logical_or.at(seen, np.repeat(np.arange(len(first)), size), anchors["many"] > 0)
    # anchors marked by their task have their spans already
    told = np.repeat(seen, size) & (anchors["many"] == 0)
    spans = _whole_spans(anchors[told], gram, side)
    distinct = anchors[first]
    distinct["many"] = seen
    start, contexts = _runs(distinct, ("gram",))
    return spans, distinct[np.repeat(contexts > 1, contexts)]


def _by_row(records: np.ndarray, kind: int) -> Iterator[pa.RecordBatch]:
    """Records as one binary row for each text that they are of."""
    if not len(records):
        return
    records = records[np.argsort(records["row"], kind="stable")]
    if kind == _SPANS:
        records = _merged_by_row(records)
    first, size = _runs(records, ("row",))
    if kind == _SPANS:
        pairs = np.stack([records["start"], records["end"]], axis=1)
        payloads = [pairs[a : a + n].tobytes() for a, n in zip(first, size, strict=True)]
    else:
        payloads = [records[a : a + n].tobytes() for a, n in zip(first, size, strict=True)]
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([kind] * len(first), pa.int32()),
            pa.array(records["row"][first], pa.int64()),
            pa.array(payloads, pa.binary()),
        ],
        names=["kind", "row_key", "payload"],
    )


def _merged_by_row(spans: np.ndarray) -> np.ndarray:
    """Spans in order, those of a row that overlap or touch made one."""
    if not len(spans):
        return spans
    spans = spans[np.lexsort((spans["start"], spans["row"]))]
    _, size = _runs(spans, ("row",))
    row = np.repeat(np.arange(len(size)), size)
    reach = int(spans["end"].max()) + 1
    far = np.maximum.accumulate(spans["end"] + row * reach)
    new = np.ones(len(spans), bool)
    new[1:] = spans["start"][1:] + row[1:] * reach > far[:-1]
    new[1:] |= row[1:] != row[:-1]
    first = np.flatnonzero(new)
    out = spans[first]
    out["end"] = far[np.append(first[1:], len(spans)) - 1] - row[first] * reach
    return out


def _merged(pairs: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of the spans of one text."""
    runs: list[tuple[int, int]] = []
    for start, end in pairs[np.argsort(pairs[:, 0], kind="stable")].tolist():
        if runs and start <= runs[-1][1]:
            runs[-1] = (runs[-1][0], max(end, runs[-1][1]))
        else:
            runs.append((start, end))
    return runs


def _context_type(side: int) -> np.dtype:
    """An anchor with the bytes to its right and, backwards, to its left."""
    return np.dtype([*_ANCHOR.descr, ("ahead", "u1", (side,)), ("behind", "u1", (side,))])


def _contexts(
    key: int, body: pa.Buffer, wanted: bytes, gram: int, side: int, context: np.dtype
) -> np.ndarray:
    """Contexts of the wanted anchors of one text."""
    anchors = np.frombuffer(wanted, _ANCHOR)
    data = np.concatenate(
        [
            np.full(side, _BEYOND, np.uint8),
            np.frombuffer(body, np.uint8),
            np.full(side, _BEYOND, np.uint8),
        ]
    )
    out = np.zeros(len(anchors), context)
    for name in _ANCHOR.names:
        out[name] = anchors[name]
    at = anchors["at"].astype(np.int64)[:, None] + side
    step = np.arange(side)
    out["ahead"] = data[at + gram + step]
    out["behind"] = data[at - 1 - step]
    return out


def _sorted_spans(records: np.ndarray, gram: int, side: int) -> np.ndarray:
    """Spans of the repeated strings in contexts that share anchors."""
    spans = np.zeros(0, _SPAN)
    if not len(records):
        return spans
    records = records[np.lexsort((records["around"], records["gram"]))]
    records = records[_runs(records, ("gram", "around"))[0]]
    _, size = _runs(records, ("gram",))
    anchor = np.repeat(np.arange(len(size)), size)
    ahead, ahead_common = _suffix_order(anchor, records["ahead"])
    behind, behind_common = _suffix_order(anchor, records["behind"])
    most = np.full(len(records), -1, np.int64)
    least = np.full(len(records), side + 1, np.int64)
    right_class = np.empty(len(records), np.int64)
    left_class = np.empty(len(records), np.int64)
    for left in range(side + 1):
        # strings that start `left` bytes before their anchor
        right_class[ahead] = np.cumsum(ahead_common < side - left)
        left_class[behind] = np.cumsum(behind_common < left)
        there = np.flatnonzero((records["left"] >= left) & (records["right"] >= side - left))
        both = right_class[there] * (len(records) + 1) + left_class[there]
        order = np.argsort(both)
        same = np.diff(both[order]) == 0
        twice = np.zeros(len(there), bool)
        twice[order[1:]] |= same
        twice[order[:-1]] |= same
        hit = there[twice]
        most[hit] = left
        least[hit] = np.minimum(least[hit], left)
    found = np.flatnonzero((most >= 0) & (records["many"] == 0))
    spans = np.zeros(len(found), _SPAN)
    at = records["at"][found].astype(np.int64)
    spans["row"] = records["row"][found]
    spans["start"] = at - most[found]
    spans["end"] = at - least[found] + gram + side
    return spans


def _suffix_order(anchor: np.ndarray, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Contexts in the order of the suffixes at their anchors, and what each shares with the last.

    The string sorted has the anchor, then the context in blocks of a fixed number of
    bytes, ranked by their bytes, then an end mark. The first of an anchor shares -1.
    """
    count, side = context.shape
    block = next(n for n in range(min(side, 25), 0, -1) if side % n == 0)
    blocks = np.ascontiguousarray(context).view(np.dtype((np.void, block)))
    values, ranks = np.unique(blocks.ravel(), return_inverse=True)
    length = side // block + 2
    string = np.zeros((count, length), np.int64)
    string[:, 0] = anchor + len(values) + 1
    string[:, 1:-1] = ranks.reshape(count, -1) + 1
    order = np.array(suffix_array(string.ravel().tolist()))
    order = order[order % length == 0] // length
    common = np.full(count, -1, np.int64)
    above, below = order[:-1], order[1:]
    differ = context[above] != context[below]
    shared = np.where(differ.any(axis=1), differ.argmax(axis=1), side)
    common[1:] = np.where(anchor[above] == anchor[below], shared, -1)
    return order, common
