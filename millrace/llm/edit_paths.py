"""Cheapest edits that give conversations a legal order of roles, and the least of them by name.

Edits of a row are Delete, Keep and Rerole; Insert adds a turn anywhere. Nodes are a row (or the
end) and what was last put out: nothing, system, user or assistant. Costs to go come from
min-plus products of one small matrix per kind of row, doubled in length until they reach the
end. Only edits on cheapest paths remain as arcs, named by their initials (D, I, K, R), and no two
arcs of one node have the same name. Nodes are ranked by the first one, two, four, ... names of
their paths: a rank of twice the length comes from the pair of ranks here and where the
pointer leads. Of a node's arcs the one with the least name and the least rank behind it stays,
and doubled pointers along these give every step of all paths at once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np

#: What was put out last.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: A row's kind: 4 times its role (the last for any other), 2 if it must go, 1 if it is cut off.
ROLES = ("s", "u", "a")
MUST_GO, CUT_OFF = 2, 1
_KINDS, _END, _LAST = 16, 16, 17
DELETE, INSERT, KEEP, REROLE = range(1, 5)
NAMES = np.frombuffer(b".DIKR", np.uint8)
_COSTS = {DELETE: 3, INSERT: 2, REROLE: 2}
_FAR = 1 << 40
#: The state after an inserted or renamed turn, and after a kept one by its role.
_NEXT = np.array([USER, USER, ASSISTANT, USER])
_KEPT = np.array(
    [[SYSTEM, -1, -1, -1], [USER, USER, -1, USER], [-1, -1, ASSISTANT, -1], [-1, -1, -1, -1]]
)
#: What is still to pay at the end of a conversation.
AT_END = np.array([0, 4, 2, 0], np.int64)


def _times(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Min-plus products of rows of matrices."""
    return np.minimum((left[..., :, :, None] + right[..., None, :, :]).min(axis=-2), _FAR)


def _matrices() -> np.ndarray:
    """Costs from state to state over one row, inserts ahead of it included; last, no row."""
    none = np.where(np.eye(4, dtype=bool), 0, _FAR)
    insert = none.copy()
    insert[np.arange(4), _NEXT] = _COSTS[INSERT]
    ahead = _times(insert, insert)
    found = []
    for kind in range(_KINDS):
        one = np.where(np.eye(4, dtype=bool), _COSTS[DELETE], _FAR)
        if not kind & MUST_GO:
            for state in range(4):
                kept, other = _KEPT[kind // 4, state], _NEXT[state]
                if kept >= 0:
                    one[state, kept] = min(one[state, kept], kind & CUT_OFF)
                one[state, other] = min(one[state, other], _COSTS[REROLE] + (kind & CUT_OFF))
        found.append(_times(ahead, one))
    return np.array([*found, none, none])


_MATRICES = _matrices()


def row_kind(initial: str, must_go: bool, cut_off: bool) -> int:
    """The kind of a row."""
    role = ROLES.index(initial) if initial in ROLES else len(ROLES)
    return 4 * role + MUST_GO * must_go + CUT_OFF * cut_off


def part_matrix(kinds: np.ndarray) -> np.ndarray:
    """Least costs from state to state over all rows of a part."""
    matrices = _MATRICES[kinds] if len(kinds) else _MATRICES[_END : _END + 1]
    while len(matrices) > 1:
        odd = matrices[len(matrices) & ~1 :]
        matrices = np.concatenate([_times(matrices[: len(matrices) & ~1 : 2], matrices[1::2]), odd])
    return matrices[0]


@dataclass
class Path:
    """Edits of a part: names, rows they belong to, states after them; cost and last state."""

    names: np.ndarray
    rows: np.ndarray
    states: np.ndarray
    cost: int
    exit: int


class EditPaths:
    """Least paths through several parts of conversations at once.

    ``parts`` are kinds of rows; ``ends`` the costs to go from each state behind a part,
    None where the conversation ends with it.
    """

    def __init__(self, parts: Sequence[np.ndarray], ends: Sequence[np.ndarray | None]) -> None:
        sizes = np.array([len(part) + 1 for part in parts])
        self.stops = np.cumsum(sizes) - 1
        self.starts = self.stops - sizes + 1
        self.kinds = np.concatenate(
            [
                np.append(part, _LAST if end is None else _END)
                for part, end in zip(parts, ends, strict=True)
            ]
        ).astype(np.int64)
        stop = np.repeat(self.stops, sizes)
        behind = np.array([AT_END if end is None else end for end in ends], np.int64)
        self.costs = self._costs(stop, np.repeat(behind, sizes, axis=0))
        self.labels, self.targets = self._arcs()
        self.pointers, self.lengths = self._doubled(self.targets)

    def _costs(self, stop: np.ndarray, behind: np.ndarray) -> np.ndarray:
        """Costs to go of each place and state."""
        places = np.arange(len(self.kinds))
        matrices = _MATRICES[self.kinds]
        step = 1
        while step < (stop - places).max(initial=0):
            matrices = _times(matrices, matrices[np.minimum(places + step, stop)])
            step *= 2
        return (matrices + behind[:, None, :]).min(axis=2)

    def _arcs(self) -> tuple[np.ndarray, np.ndarray]:
        """The name and target of each node's arc on the least path; a last node leads to itself."""
        count = len(self.kinds)
        place, state = np.divmod(np.arange(4 * count), 4)
        kinds = self.kinds[place]
        cost = self.costs.ravel()
        row = kinds < _KINDS
        free = row & (kinds & MUST_GO == 0)
        cut_off = np.where(row, kinds & CUT_OFF, 0)
        other = _NEXT[state]
        kept = _KEPT[np.where(row, kinds // 4, 3), state]
        after = 4 * (place + 1)
        options = (
            (DELETE, row, after + state, _COSTS[DELETE]),
            (INSERT, kinds != _END, 4 * place + other, _COSTS[INSERT]),
            (KEEP, free & (kept >= 0), after + kept, cut_off),
            (REROLE, free, after + other, _COSTS[REROLE] + cut_off),
        )
        arcs = []
        labels = np.zeros(4 * count, np.int64)
        targets = np.arange(4 * count)
        for name, open_, target, price in reversed(options):
            target = np.where(open_, target, 0)
            best = open_ & (cost == price + cost[target])
            labels = np.where(best, name, labels)
            targets = np.where(best, target, targets)
            arcs.append((name, best, target))
        ranks = self._ranks(labels, targets)
        least = np.full(4 * count, np.iinfo(np.int64).max)
        for name, best, target in arcs:
            order = name * (ranks.max(initial=0) + 1) + ranks[target]
            better = best & (order < least)
            least = np.where(better, order, least)
            labels = np.where(better, name, labels)
            targets = np.where(better, target, targets)
        return labels, targets

    def _ranks(self, labels: np.ndarray, targets: np.ndarray) -> np.ndarray:
        """Ranks of nodes by all names of their paths."""
        ranks, pointers = labels, targets
        while labels[pointers].any():
            pairs = ranks * (ranks.max(initial=0) + 1) + ranks[pointers]
            ranks = np.unique(pairs, return_inverse=True)[1]
            pointers = pointers[pointers]
        return ranks

    def _doubled(self, targets: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """Pointers of 1, 2, 4, ... steps, and how many steps there are to the end."""
        pointers = [targets]
        lengths = (self.labels > 0).astype(np.int64)
        while self.labels[pointers[-1]].any():
            last = pointers[-1]
            lengths = lengths + lengths[last]
            pointers.append(last[last])
        return pointers, lengths

    def exits(self, part: int) -> list[int]:
        """The state behind a part, by the state ahead of it."""
        return [int(self.pointers[-1][4 * self.starts[part] + state] % 4) for state in range(4)]

    def paths(self, entries: Sequence[int]) -> list[Path]:
        """The least path through each part from the state ahead of it."""
        first = 4 * self.starts + np.asarray(entries, np.int64)
        counts = self.lengths[first]
        ends = np.cumsum(counts)
        steps = np.arange(counts.sum()) - np.repeat(ends - counts, counts)
        nodes = np.repeat(first, counts)
        for bit, pointer in enumerate(self.pointers):
            nodes = np.where(steps >> bit & 1, pointer[nodes], nodes)
        costs = self.costs.ravel()
        found = []
        for part, (begin, end) in enumerate(zip(ends - counts, ends, strict=True)):
            on = nodes[begin:end]
            last = self.pointers[-1][first[part]]
            found.append(
                Path(
                    self.labels[on],
                    on // 4 - self.starts[part],
                    self.targets[on] % 4,
                    int(costs[first[part]] - costs[last]),
                    int(last % 4),
                )
            )
        return found
