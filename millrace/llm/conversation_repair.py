"""Repair of conversations: faults of turns, and the cheapest edits to a legal order of roles.

Turns are sorted over all tasks by conversation, turn, role and text and cut into parts of a
bounded size, so that no conversation is one task's. A conversation in one part is solved at
once. For others each part gives its matrix of least costs between states; these, sixteen
numbers a part, tell what is still to pay behind each part, with that each part tells its exit
for each entry, and these tell the entries; then all parts are solved alike.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.edit_paths import (
    AT_END,
    DELETE,
    INSERT,
    KEEP,
    NAMES,
    NOTHING,
    USER,
    EditPaths,
    part_matrix,
    row_kind,
)
from millrace.llm.shared import written

_SPACES = " \t\n\x0b\x0c\r"
_LEGAL = {"su", "ua", "au"}
#: Rows and bytes of texts after which a part ends.
_PART_ROWS = 2048
_PART_BYTES = 1 << 17
#: Rows whose paths are sought together.
_TOGETHER = 1 << 14

_COUNTS = ("blank", "duplicate", "truncated", "illegal")


def distinct_turns(turns: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """Rows (id, turn, role, text, copies): equal rows once; a null role or text is one space."""

    def shown(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    return (
        turns.select(
            F.col(id_col).alias("id"),
            F.col(turn_col).alias("turn"),
            shown(role_col).alias("role"),
            shown(text_col).alias("text"),
        )
        .groupBy("id", "turn", "role", "text")
        .agg(F.count("*").alias("copies"))
    )


def with_faults(rows: DataFrame) -> DataFrame:
    """Adds booleans blank, again (role and text are those of an earlier row) and cut_off.

    Groups of equal role and text are told by 128 bits of hashes, and only those of several
    turns are joined back.
    """
    keyed = rows.withColumn("key", F.xxhash64("role", "text")).withColumn(
        "key2", F.xxhash64("text", F.lit("text"), "role")
    )
    several = (
        keyed.groupBy("id", "key", "key2")
        .agg(F.min(F.struct("turn")).alias("first"), F.count("*").alias("rows"))
        .where("rows > 1")
        .select(*(F.col(name).alias(f"of_{name}") for name in ("id", "key", "key2", "first")))
    )
    # written, so that its size tells Spark whether it can be sent to all tasks
    several = written(several, "several")
    same = (
        F.col("id").eqNullSafe(F.col("of_id"))
        & (F.col("key") == F.col("of_key"))
        & (F.col("key2") == F.col("of_key2"))
    )
    ended = F.rtrim("text", F.lit(_SPACES))
    again = F.col("of_first").isNotNull() & ~F.col("turn").eqNullSafe(F.col("of_first.turn"))
    return keyed.join(several, same, "left").select(
        "id",
        "turn",
        "role",
        "text",
        "copies",
        (ended == "").alias("blank"),
        again.alias("again"),
        (~F.right(ended, F.lit(1)).isin(".", "!", "?")).alias("cut_off"),
    )


_PARTS = (
    "part bigint, kinds binary, copies array<bigint>, roles array<string>, texts array<string>, "
    "blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
    "first string, last string"
)


def _parts(faulty: DataFrame, part_rows: int, part_bytes: int) -> DataFrame:
    """Turns in order, in parts numbered upwards over all tasks."""
    id_type = faulty.schema["id"].dataType.simpleString()
    order = ("id", "turn", "role", "text")
    ordered = faulty.repartitionByRange(*order).sortWithinPartitions(*order)

    def gather(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict = {}
        done: list[dict] = []
        number = held = 0
        schema = None
        for batch in batches:
            if schema is None:
                schema = _part_schema(batch.schema.field("id").type)
            for row in batch.to_pylist():
                size = len(row["text"])
                if state and (
                    row["id"] != state["id"]
                    or len(state["roles"]) >= part_rows
                    or state["bytes"] + size > part_bytes
                ):
                    held += state["bytes"]
                    done.append(_finished(state))
                    state = {}
                    if held > 1 << 22 or len(done) >= 4096:
                        yield pa.RecordBatch.from_pylist(done, schema)
                        done, held = [], 0
                if not state:
                    state = _empty_part(row["id"], row["task"] << 32 | number)
                    number += 1
                _add_row(state, row, size)
        if state:
            done.append(_finished(state))
        if done:
            yield pa.RecordBatch.from_pylist(done, schema)

    return ordered.withColumn("task", F.spark_partition_id().cast("long")).mapInArrow(
        gather, f"id {id_type}, {_PARTS}"
    )


def _empty_part(name: object, part: int) -> dict:
    lists = {"kinds": bytearray(), "copies": [], "roles": [], "texts": []}
    return {"id": name, "part": part, "bytes": 0, "last": None, **lists, **dict.fromkeys(_COUNTS, 0)}


def _add_row(part: dict, row: dict, size: int) -> None:
    """Counts the faults of a row and its further copies, and keeps it."""
    more = row["copies"] - 1
    initial = row["role"][:1]
    if row["blank"]:
        part["blank"] += row["copies"]
    else:
        part["duplicate"] += more + row["again"]
        part["truncated"] += row["cut_off"] and not row["again"]
    if part["last"] is None:
        part["first"] = initial
    else:
        part["illegal"] += part["last"] + initial not in _LEGAL
    part["illegal"] += more
    part["last"] = initial
    must_go = row["blank"] or row["again"]
    part["kinds"].append(row_kind(initial, must_go, row["cut_off"] and not must_go))
    part["copies"].append(row["copies"])
    part["roles"].append(row["role"])
    part["texts"].append(row["text"])
    part["bytes"] += size


def _finished(part: dict) -> dict:
    del part["bytes"]
    return {**part, "kinds": bytes(part["kinds"])}


def _part_schema(id_type: pa.DataType) -> pa.Schema:
    whole = pa.int64()
    return pa.schema(
        [
            ("id", id_type),
            ("part", whole),
            ("kinds", pa.binary()),
            ("copies", pa.list_(whole)),
            ("roles", pa.list_(pa.string())),
            ("texts", pa.list_(pa.string())),
            *((name, whole) for name in _COUNTS),
            ("first", pa.string()),
            ("last", pa.string()),
        ]
    )


def _kinds(value: bytes) -> np.ndarray:
    return np.frombuffer(value, np.uint8).astype(np.int64)


def _together(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of parts with a bounded number of rows together."""
    start = total = 0
    for at, size in enumerate(sizes):
        if at > start and total + size > _TOGETHER:
            yield start, at
            start, total = at, 0
        total += size
    if start < len(sizes):
        yield start, len(sizes)


def _matrices(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [part_matrix(_kinds(value)).ravel().tolist() for value in batch["kinds"].to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch["id"], batch["part"], pa.array(found, pa.list_(pa.int64()))],
            names=["id", "part", "matrix"],
        )


def _costs_behind(parts: pd.DataFrame) -> pd.DataFrame:
    """What is to pay behind each part of a conversation; null behind the last."""
    parts = parts.sort_values("part")
    costs, behind = AT_END, [None]
    for matrix in parts["matrix"][:0:-1]:
        costs = (np.reshape(matrix, (4, 4)) + costs).min(axis=1)
        behind.append(costs.tolist())
    return pd.DataFrame({"part": parts["part"], "behind": behind[::-1]})


def _exits(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        kinds = [_kinds(value) for value in batch["kinds"].to_pylist()]
        behind = batch["behind"].to_pylist()
        found = []
        for low, high in _together([len(each) for each in kinds]):
            solved = EditPaths(kinds[low:high], behind[low:high])
            found += [solved.exits(at) for at in range(high - low)]
        yield pa.RecordBatch.from_arrays(
            [batch["id"], batch["part"], batch["behind"], pa.array(found, pa.list_(pa.int32()))],
            names=["id", "part", "behind", "exits"],
        )


def _entries(parts: pd.DataFrame) -> pd.DataFrame:
    """The state ahead of each part of a conversation."""
    parts = parts.sort_values("part")
    state, found = NOTHING, []
    for exits in parts["exits"]:
        found.append(state)
        state = int(exits[state])
    return parts.assign(entry=found)[["part", "behind", "entry"]]


def _audit(path_names: np.ndarray, path_rows: np.ndarray, copies: list[int]) -> str:
    """Initials of edits; all further copies of a row are deleted right behind it."""
    names = NAMES[path_names].tobytes().decode()
    if max(copies, default=1) == 1:
        return names
    return "".join(
        name if edit == INSERT else name + "D" * (copies[row] - 1)
        for name, edit, row in zip(names, path_names.tolist(), path_rows.tolist(), strict=True)
    )


def _solved(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    turn = pa.struct([("role", pa.string()), ("text", pa.string())])
    kept = ["id", "part", *_COUNTS, "first", "last"]
    for batch in batches:
        rows = batch.drop_columns([*_COUNTS, "first", "last"]).to_pylist()
        costs, audits, repaired = [], [], []
        for low, high in _together([len(row["kinds"]) for row in rows]):
            some = rows[low:high]
            paths = EditPaths([_kinds(row["kinds"]) for row in some], [row["behind"] for row in some])
            for row, path in zip(some, paths.paths([row["entry"] or NOTHING for row in some]), strict=True):
                more = sum(row["copies"]) - len(row["copies"])
                costs.append(path.cost + 3 * more)
                audits.append(_audit(path.names, path.rows, row["copies"]))
                turns = []
                for edit, at, state in zip(
                    path.names.tolist(), path.rows.tolist(), path.states.tolist(), strict=True
                ):
                    if edit == DELETE:
                        continue
                    role = "user" if state == USER else "assistant"
                    turns.append(
                        {
                            "role": row["roles"][at] if edit == KEEP else role,
                            "text": "" if edit == INSERT else row["texts"][at],
                        }
                    )
                repaired.append(turns)
        yield pa.RecordBatch.from_arrays(
            [
                *(batch[name] for name in kept),
                pa.array(costs, pa.int64()),
                pa.array(audits, pa.string()),
                pa.array(repaired, pa.list_(turn)),
                batch["entry"].is_null(),
            ],
            names=[*kept, "cost", "audit", "repaired", "alone"],
        )


def repaired_parts(
    faulty: DataFrame, part_rows: int = _PART_ROWS, part_bytes: int = _PART_BYTES
) -> DataFrame:
    """Conversations of ``with_faults``, repaired, in parts in the order of ``part``.

    Rows (id, part, blank, duplicate, truncated, illegal, first, last, cost, audit, repaired,
    alone): counts of the part's faults, each row's first one, and of neighbours of an illegal
    order; initials of its first and last role; cost and initials of its edits; the turns it has
    then; whether it is all of its conversation.
    ``illegal`` leaves out the step from one part to the next. Turns without a number come
    first; of equal numbers the order is that of role and text. A conversation without an id
    is one like others.
    """
    parts = written(_parts(faulty, part_rows, part_bytes), "parts")
    id_type = parts.schema["id"].dataType.simpleString()
    several = (
        parts.groupBy("id").agg(F.collect_list("part").alias("all")).where("size(all) > 1")
    ).select(F.explode("all").alias("part"))
    split = written(parts.join(several, "part", "left_semi").select("id", "part", "kinds"), "split")
    behind = (
        split.mapInArrow(_matrices, f"id {id_type}, part bigint, matrix array<bigint>")
        .groupBy("id")
        .applyInPandas(_costs_behind, "part bigint, behind array<bigint>")
    )
    exits = split.join(behind, "part").select("id", "part", "behind", "kinds").mapInArrow(
        _exits, f"id {id_type}, part bigint, behind array<bigint>, exits array<int>"
    )
    entries = exits.groupBy("id").applyInPandas(
        _entries, "part bigint, behind array<bigint>, entry int"
    )
    counts = ", ".join(f"{name} bigint" for name in _COUNTS)
    return parts.join(written(entries, "entries"), "part", "left").mapInArrow(
        _solved,
        f"id {id_type}, part bigint, {counts}, first string, last string, cost bigint, "
        "audit string, repaired array<struct<role:string,text:string>>, alone boolean",
    )


def conversation_reports(parts: DataFrame) -> DataFrame:
    """One row for each conversation of ``repaired_parts``.

    (id, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256); the hash is of
    ``role:text`` of the repaired turns, joined by line feeds. A conversation's parts stream
    through one task, which keeps counts, a hash and initials, since a hash has one order; of
    a conversation in one part only the hash is sent.
    """
    id_type = parts.schema["id"].dataType.simpleString()
    line = F.transform("repaired", lambda t: F.concat(t["role"], F.lit(":"), t["text"]))
    body = F.when(F.size("repaired") > 0, F.array_join(line, "\n"))
    streamed = (
        parts.select(
            "id",
            "part",
            *_COUNTS,
            "first",
            "last",
            "cost",
            "audit",
            F.when(~F.col("alone"), body).alias("body"),
            F.when(F.col("alone"), F.sha2(F.coalesce(body, F.lit("")), 256)).alias("digest"),
        )
        .repartition("id")
        .sortWithinPartitions("id", "part")
    )

    def report(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict = {}
        schema = None
        for batch in batches:
            if schema is None:
                schema = _report_schema(batch.schema.field("id").type)
            done = []
            for row in batch.to_pylist():
                if state and row["id"] != state["id"]:
                    done.append(_closed(state))
                    state = {}
                if not state:
                    numbers = dict.fromkeys((*_COUNTS, "cost"), 0)
                    empty = {"audit": [], "hash": None, "digest": None, "last": None}
                    state = {"id": row["id"], **empty, **numbers}
                _add_part(state, row)
            yield pa.RecordBatch.from_pylist(done, schema)
        if state:
            yield pa.RecordBatch.from_pylist([_closed(state)], schema)

    counts = ", ".join(f"{name} bigint" for name in _COUNTS)
    return streamed.mapInArrow(
        report, f"id {id_type}, {counts}, cost bigint, audit string, repaired_sha256 string"
    )


def _add_part(state: dict, row: dict) -> None:
    for name in (*_COUNTS, "cost"):
        state[name] += row[name]
    if state["last"] is not None:
        state["illegal"] += state["last"] + row["first"] not in _LEGAL
    state["last"] = row["last"]
    state["audit"].append(row["audit"])
    state["digest"] = row["digest"]
    if row["body"] is not None:
        if state["hash"] is None:
            state["hash"] = hashlib.sha256()
        else:
            state["hash"].update(b"\n")
        state["hash"].update(row["body"].encode())


def _closed(state: dict) -> dict:
    streamed, digest = state.pop("hash") or hashlib.sha256(), state.pop("digest")
    del state["last"]
    found = digest or streamed.hexdigest()
    return {**state, "audit": "".join(state["audit"]), "repaired_sha256": found}


def _report_schema(id_type: pa.DataType) -> pa.Schema:
    numbers = [(name, pa.int64()) for name in (*_COUNTS, "cost")]
    texts = [("audit", pa.string()), ("repaired_sha256", pa.string())]
    return pa.schema([("id", id_type), *numbers, *texts])


def turn_gaps(rows: DataFrame) -> DataFrame:
    """Rows (id, gaps): turn numbers missing between a conversation's first and last."""
    numbered = rows.groupBy("id", "turn").agg(F.lit(1).alias("one"))
    missing = F.max("turn") - F.min("turn") + 1 - F.count("turn")
    return numbered.groupBy("id").agg(F.coalesce(missing, F.lit(0)).cast("long").alias("gaps"))
