"""Placement of rows in shards by a lookup table that shards fill in turns.

Each shard has an order of preference over all slots of a table whose size is a prime: it
starts at one hash of its name and steps by another. Shards take turns, each claiming the
first slot of its order that is still free, until all are taken. So shards hold equal numbers
of slots, give or take one, and when a shard comes or goes few other slots change hands. A row
falls into a slot by the hash of its key; finding its shard is one lookup in a table of fixed size.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.numbering import free_names

#: A prime, so that any step visits all slots; far above the number of shards.
SLOTS = 65_537


def lookup_table(shards: Sequence[str], slots: int = SLOTS) -> np.ndarray:
    """For each slot the index of the shard that holds it."""
    if not 0 < len(shards) <= slots or len(set(shards)) != len(shards):
        raise ValueError("shards need distinct names, and no more of them than slots")
    if any(slots % factor == 0 for factor in range(2, int(slots**0.5) + 1)):
        raise ValueError(f"{slots} is no prime")
    at = [xxhash.xxh64_intdigest(name, 1) % slots for name in shards]
    step = [xxhash.xxh64_intdigest(name, 2) % (slots - 1) + 1 for name in shards]
    holder = [-1] * slots
    left = slots
    while True:
        for shard in range(len(shards)):
            slot = at[shard]
            while holder[slot] >= 0:
                slot = (slot + step[shard]) % slots
            holder[slot] = shard
            at[shard] = (slot + step[shard]) % slots
            left -= 1
            if not left:
                return np.array(holder, np.int32)


def placed(
    df: DataFrame,
    key_col: str,
    shards: Sequence[str],
    spread_cols: Sequence[str] = (),
    slots: int = SLOTS,
    slot_col: str = "slot",
    shard_col: str = "shard",
) -> DataFrame:
    """Adds the slot and the shard's name to every row.

    Rows with the same key go to the same shard. Those without one are spread by the hash
    of ``spread_cols`` (without any, they share the slot of the empty key). The
    table sent to all tasks has ``slots`` rows, whatever the data. Columns that are named
    like the added ones are replaced.
    """
    table = lookup_table(shards, slots)
    slot_name, of_slot, shard_name = free_names(df.columns, "slot", "of_slot", "shard")
    lookup = df.sparkSession.createDataFrame(
        [(slot, shards[shard]) for slot, shard in enumerate(table.tolist())],
        f"`{of_slot}` int, `{shard_name}` string",
    )
    key = F.when(F.col(key_col).isNotNull(), F.xxhash64(F.col(key_col).cast("string"))).otherwise(
        F.xxhash64(*(F.col(name).cast("string") for name in spread_cols))
        if spread_cols
        else F.xxhash64(F.lit(""))
    )
    added = (slot_col.lower(), shard_col.lower())
    kept = [name for name in df.columns if name.lower() not in added]
    return (
        df.withColumn(slot_name, F.pmod(key, F.lit(slots)).cast("int"))
        .join(F.broadcast(lookup), F.col(slot_name) == F.col(of_slot))
        .select(
            *(F.col(f"`{name}`") for name in kept),
            F.col(slot_name).alias(slot_col),
            F.col(shard_name).alias(shard_col),
        )
    )


def write_shards(df: DataFrame, path: str, shard_col: str = "shard") -> None:
    """One folder for each shard, in files of even size; a large shard is split over tasks."""
    df.hint("rebalance", shard_col).write.partitionBy(shard_col).parquet(path)
