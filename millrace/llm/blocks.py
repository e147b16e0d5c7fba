"""Numpy records moved through Spark shuffles as one binary row per task and bucket."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import SparkSession

#: Columns of a block row: a bucket to shuffle by, a kind, and packed records.
BLOCK_SCHEMA = "bucket int, kind int, payload binary"
_ARROW = pa.schema([("bucket", pa.int32()), ("kind", pa.int32()), ("payload", pa.binary())])
#: Rows of a record array are cut so that one payload stays small.
_MOST_BYTES = 1 << 22


def bucket_count(spark: SparkSession) -> int:
    """Four buckets per shuffle partition, so that partitions come out even."""
    return 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))


def to_blocks(
    records: np.ndarray, keys: np.ndarray, buckets: int, kind: int = 0
) -> Iterator[pa.RecordBatch]:
    """Records dealt to buckets by 64-bit keys that are hashes already."""
    if not len(records):
        return
    bucket = (keys >> np.uint64(20)) % np.uint64(buckets)
    order = np.argsort(bucket, kind="stable")
    bucket, records = bucket[order].astype(np.int64), records[order]
    edges = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1))
    step = max(1, _MOST_BYTES // records.dtype.itemsize)
    names, payloads = [], []
    for start, end in zip(edges[:-1], edges[1:], strict=True):
        for low in range(start, end, step):
            names.append(int(bucket[start]))
            payloads.append(records[low : min(end, low + step)].tobytes())
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(names, pa.int32()),
            pa.array([kind] * len(names), pa.int32()),
            pa.array(payloads, pa.binary()),
        ],
        schema=_ARROW,
    )


def from_blocks(batches: Iterable[pa.RecordBatch], kinds: dict[int, np.dtype]) -> dict:
    """All records of a partition by kind."""
    parts: dict[int, list] = {kind: [] for kind in kinds}
    for batch in batches:
        for kind, payload in zip(batch["kind"].to_pylist(), batch["payload"], strict=True):
            parts[kind].append(np.frombuffer(payload.as_buffer(), kinds[kind]))
    return {
        kind: np.concatenate(found) if found else np.zeros(0, kinds[kind])
        for kind, found in parts.items()
    }


def text_chunks(values: pa.Array, most_bytes: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """Row ranges of a string or binary array of about ``most_bytes`` together; a long value is whole."""
    sizes = values.cast(pa.binary()) if pa.types.is_string(values.type) else values
    lengths = np.asarray(pa.compute.fill_null(pa.compute.binary_length(sizes), 0))
    start, total = 0, 0
    for row, length in enumerate(lengths):
        if row > start and total + length > most_bytes:
            yield start, row
            start, total = row, 0
        total += int(length)
    if start < len(lengths):
        yield start, len(lengths)
