"""Repair of conversations against all edits tried in plain Python."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from millrace.llm import conversation_repair as module
from millrace.llm import queries
from millrace.llm.edit_paths import AT_END, NAMES, EditPaths, part_matrix

SF_DIR = "/root/testdata/sf0.01"
COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
_KEEP = {("0", "s"): "S", ("0", "u"): "U", ("S", "u"): "U", ("A", "u"): "U", ("U", "a"): "A"}
_NEXT = {"0": "U", "S": "U", "A": "U", "U": "A"}


def plain_edits(rows):
    """(cost, initials, turns) of the cheapest and then least edits of (initial, must go, cut off)."""
    behind = {state: (0, "", ()) if state in "0A" else (10**9, "", ()) for state in "0SUA"}
    for at in range(len(rows), -1, -1):
        here = {}
        for state in "0SUA":
            options = []
            if at == len(rows):
                options.append(behind[state])
            else:
                initial, must_go, cut_off = rows[at]
                ways = [(3, "D", state, ())]
                if not must_go:
                    ways.append((2 + cut_off, "R", _NEXT[state], ((at, _NEXT[state]),)))
                    if (state, initial) in _KEEP:
                        ways.append((cut_off, "K", _KEEP[state, initial], ((at, None),)))
                for price, name, after, turn in ways:
                    cost, names, turns = behind[after]
                    options.append((price + cost, name + names, turn + turns))
            here[state] = min(options, key=lambda option: option[:2])
        for _ in range(3):
            for state in "0SUA":
                cost, names, turns = here[_NEXT[state]]
                option = (2 + cost, "I" + names, ((None, _NEXT[state]), *turns))
                here[state] = min(here[state], option, key=lambda found: found[:2])
        behind = here
    return behind["0"]


def damaged(turns):
    def shown(value):
        return " " if value is None else str(value)

    for name, turn, role, text in turns:
        kind = zlib.crc32(f"{shown(name)}:{shown(turn)}".encode()) % 20
        role, text = shown(role), shown(text)
        if kind == 1:
            text = ""
        elif kind == 2:
            text = re.sub("[.!?]", "", text)
        elif kind == 4:
            role = "user"
        yield from [(name, turn, role, text)] * {0: 0, 3: 2}.get(kind, 1)


def plain_reports(turns, damage=damaged):
    rows_of = defaultdict(list)
    for name, *row in damage(turns):
        rows_of[name].append(row)
    reports = {}
    for name in {turn[0] for turn in turns}:
        rows = sorted(
            rows_of[name],
            key=lambda row: (row[0] is not None, row[0] or 0, row[1].encode(), row[2].encode()),
        )
        numbers = [row[0] for row in rows if row[0] is not None]
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        faults, seen, kinds = [0, 0, 0], set(), []
        for _, role, text in rows:
            core = text.strip(" \t\n\x0b\x0c\r")
            fault = None
            if not core:
                fault = 0
            elif (role, text) in seen:
                fault = 1
            elif core[-1] not in ".!?":
                fault = 2
            if fault is not None:
                faults[fault] += 1
            seen.add((role, text))
            kinds.append((role[:1], fault in (0, 1), fault == 2))
        illegal = sum(
            a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(kinds, kinds[1:], strict=False)
        )
        cost, names, turns_left = plain_edits(kinds)
        lines = []
        for at, state in turns_left:
            role = {"U": "user", "A": "assistant"}.get(state) or rows[at][1]
            lines.append(f"{role}:{'' if at is None else rows[at][2]}")
        digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        reports[name] = (gaps, *faults, illegal, cost, names, digest)
    return reports


def reports(spark, sf_dir):
    found = queries.op11_conversation_repair(spark, sf_dir).select("conv_id", *COLUMNS).collect()
    assert len({row[0] for row in found}) == len(found)
    return {row[0]: tuple(row)[1:] for row in found}


def kinds_to_rows(kinds):
    return [("sua?"[kind // 4], bool(kind & 2), kind & 1) for kind in kinds]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.lists(st.integers(0, 15), max_size=25), min_size=1, max_size=5), st.data())
def test_edits_of_random_rows(rows, data):
    parts = [np.array(row, np.int64) for row in rows]
    paths = EditPaths(parts, [None] * len(parts)).paths([0] * len(parts))
    for row, path in zip(rows, paths, strict=True):
        cost, names, _ = plain_edits(kinds_to_rows(row))
        assert (path.cost, NAMES[path.names].tobytes().decode()) == (cost, names)
    # the first one again, cut in three
    cuts = sorted(data.draw(st.lists(st.integers(0, len(rows[0])), min_size=2, max_size=2)))
    parts = [
        np.array(rows[0][a:b], np.int64)
        for a, b in zip([0, *cuts], [*cuts, len(rows[0])], strict=True)
    ]
    costs, ends = AT_END, [None]
    for part in parts[:0:-1]:
        costs = (part_matrix(part) + costs).min(axis=1)
        ends.append(costs)
    state, names, total = 0, "", 0
    for part, end in zip(parts, ends[::-1], strict=True):
        solved = EditPaths([part], [end])
        (path,) = solved.paths([state])
        assert solved.exits(0)[state] == path.exit
        state, total = path.exit, total + path.cost
        names += NAMES[path.names].tobytes().decode()
    assert (total, names) == plain_edits(kinds_to_rows(rows[0]))[:2]


def odd_turns():
    """Nulls, other roles, blank and long texts, repeated turns and rows, one long conversation."""
    rng = random.Random(5)
    roles = ["user", "assistant", "system", "user", "assistant", None, "", "tool", "User"]
    texts = [None, "", " \t", "a.", "b", "c! ", "long text? " * 400, "été…", "x.\x85", "y.　"]
    turns = [
        (name, None if rng.random() < 0.1 else turn, rng.choice(roles), rng.choice([*texts, f"{rng.random()}."]))
        for name, count in ((None, 9), (1, 400), (2, 1), (3, 2), (4, 17), (5, 30), (6, 5))
        for turn in range(count)
    ]
    return turns + turns[:20] + [turns[-1]] * 5 + [(7, None, None, None), (8, -3, "user", "q?")]


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("part_rows", [2048, 7, 1])
def test_query_on_odd_rows(spark, tmp_path, monkeypatch, part_rows):
    """Also with parts so small that conversations cross them."""
    whole = module.repaired_parts
    monkeypatch.setattr(queries, "repaired_parts", lambda rows: whole(rows, part_rows))
    turns = odd_turns()
    spark.createDataFrame(turns, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    assert reports(spark, tmp_path) == plain_reports(turns)


def test_query_on_no_rows(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    assert reports(spark, tmp_path) == {}


def test_query_on_a_table(spark):
    turns = spark.read.parquet(f"{SF_DIR}/conversations.parquet")
    turns = list(map(tuple, turns.select("conv_id", "turn", "role", "text").collect()))
    assert reports(spark, SF_DIR) == plain_reports(turns)


def test_operator_with_own_names(spark):
    """Undamaged turns under other column names and next to clashing ones; what comes back."""
    rows = [
        ("c", 1, "system", "Be kind.", 1, "x", 9),
        ("c", 2, "user", "Hello?", 1, "x", 9),
        ("c", 2, "user", "Hello?", 2, "y", 8),
        ("c", 3, "user", "Are you there", 1, "x", 9),
        ("c", 4, "assistant", "Yes.", 1, "x", 9),
        (None, 1, "assistant", "Alone.", 1, "x", 9),
    ]
    turns = spark.createDataFrame(
        rows, "id string, n int, who string, said string, copies int, key string, part int"
    )
    found = module.with_faults(module.distinct_turns(turns, "id", "n", "who", "said"))
    parts = {row["id"]: row for row in module.repaired_parts(found).collect()}
    whole = parts["c"]
    assert (whole["duplicate"], whole["truncated"], whole["illegal"]) == (1, 1, 2)
    # keep, keep, delete the copy, then delete the cut-off turn rather than answer it
    assert whole["audit"] == plain_edits(
        [("s", False, 0), ("u", False, 0), ("u", True, 0), ("u", False, 1), ("a", False, 0)]
    )[1]
    assert [tuple(turn) for turn in whole["repaired"]][:2] == [
        ("system", "Be kind."),
        ("user", "Hello?"),
    ]
    assert parts[None]["audit"] == "IK"
    assert [tuple(turn) for turn in parts[None]["repaired"]] == [("user", ""), ("assistant", "Alone.")]
