"""Several byte patterns compiled into one minimal deterministic automaton.

Patterns know literals, escapes (``\\xHH`` and escaped punctuation), classes with ranges,
groups, alternation and the quantifiers ``? * + {m} {m,} {m,n}``.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

ALL_BYTES = range(256)


class _Nfa:
    """States with empty moves and moves by sets of bytes."""

    def __init__(self) -> None:
        self.empty: list[list[int]] = []
        self.moves: list[list[tuple[frozenset[int], int]]] = []

    def state(self) -> int:
        self.empty.append([])
        self.moves.append([])
        return len(self.empty) - 1


class _Reader:
    """Reads a pattern into nested tuples: bytes, seq, alt, repeat."""

    def __init__(self, pattern: str) -> None:
        self.text, self.at = pattern, 0

    def peek(self) -> str:
        return self.text[self.at : self.at + 1]

    def take(self) -> str:
        self.at += 1
        return self.text[self.at - 1]

    def alternatives(self) -> tuple:
        found = [self.sequence()]
        while self.peek() == "|":
            self.take()
            found.append(self.sequence())
        return ("alt", found)

    def sequence(self) -> tuple:
        parts = []
        while self.peek() and self.peek() not in "|)":
            parts.append(self.repeated())
        return ("seq", parts)

    def repeated(self) -> tuple:
        part = self.atom()
        while self.peek() and self.peek() in "?*+{":
            kind = self.take()
            if kind == "{":
                stop = self.text.index("}", self.at)
                low, comma, high = self.text[self.at : stop].partition(",")
                self.at = stop + 1
                bounds = (int(low), int(high) if high else (None if comma else int(low)))
            else:
                bounds = {"?": (0, 1), "*": (0, None), "+": (1, None)}[kind]
            part = ("repeat", part, *bounds)
        return part

    def atom(self) -> tuple:
        if self.peek() == "(":
            self.take()
            inner = self.alternatives()
            if self.take() != ")":
                raise ValueError(f"unclosed group in {self.text}")
            return inner
        if self.peek() == "[":
            self.take()
            return ("bytes", self.byte_class())
        return ("bytes", frozenset([self.byte()]))

    def byte(self) -> int:
        char = self.take()
        if char != "\\":
            return ord(char)
        char = self.take()
        if char == "x":
            self.at += 2
            return int(self.text[self.at - 2 : self.at], 16)
        return ord(char)

    def byte_class(self) -> frozenset[int]:
        found: set[int] = set()
        while self.peek() != "]":
            low = high = self.byte()
            if self.peek() == "-" and self.text[self.at + 1] != "]":
                self.take()
                high = self.byte()
            found.update(range(low, high + 1))
        self.take()
        return frozenset(found)


def parsed(pattern: str) -> tuple:
    reader = _Reader(pattern)
    tree = reader.alternatives()
    if reader.at != len(pattern):
        raise ValueError(f"unbalanced pattern {pattern}")
    return tree


def reversed_tree(tree: tuple) -> tuple:
    """The pattern of all matches read backwards."""
    if tree[0] == "seq":
        return ("seq", [reversed_tree(part) for part in reversed(tree[1])])
    if tree[0] == "alt":
        return ("alt", [reversed_tree(part) for part in tree[1]])
    if tree[0] == "repeat":
        return ("repeat", reversed_tree(tree[1]), *tree[2:])
    return tree


def without_case(tree: tuple) -> tuple:
    """The pattern with ASCII letters of either case."""
    if tree[0] == "bytes":
        both = bytes(tree[1]).lower() + bytes(tree[1]).upper() + bytes(tree[1])
        return ("bytes", frozenset(both))
    if tree[0] == "repeat":
        return ("repeat", without_case(tree[1]), *tree[2:])
    return (tree[0], [without_case(part) for part in tree[1]])


def _build(nfa: _Nfa, tree: tuple, start: int) -> int:
    """Adds a pattern after a state; returns the state at its end."""
    if tree[0] == "bytes":
        end = nfa.state()
        nfa.moves[start].append((tree[1], end))
        return end
    if tree[0] == "seq":
        for part in tree[1]:
            start = _build(nfa, part, start)
        return start
    if tree[0] == "alt":
        end = nfa.state()
        for part in tree[1]:
            nfa.empty[_build(nfa, part, start)].append(end)
        return end
    _, part, low, high = tree
    for _ in range(low):
        start = _build(nfa, part, start)
    end = nfa.state()
    nfa.empty[start].append(end)
    if high is None:
        loop = nfa.state()
        nfa.empty[start].append(loop)
        nfa.empty[_build(nfa, part, loop)] += [loop, end]
    else:
        for _ in range(high - low):
            start = _build(nfa, part, start)
            nfa.empty[start].append(end)
    return end


class Automaton:
    """A table of moves for all bytes of all states, flat and scaled by 256.

    State ``start`` begins. A state's patterns are those of which a match ends there; states
    from ``first_hit`` up have some, all others none.
    """

    def __init__(self, trees: Sequence[tuple], anywhere: bool) -> None:
        nfa = _Nfa()
        root = nfa.state()
        finals: dict[int, int] = {}
        for index, tree in enumerate(trees):
            entry = nfa.state()
            nfa.empty[root].append(entry)
            finals[_build(nfa, tree, entry)] = index
        moves, hits = _subsets(nfa, root, finals, anywhere)
        self.moves, self.hits, self.start, self.first_hit = _minimal(moves, hits)

    @property
    def states(self) -> int:
        return len(self.moves) // 256

    def patterns(self, state: int) -> frozenset[int]:
        return self.hits[state >> 8]

    def longest(self, body: bytes, start: int) -> int:
        """Where the longest match from a place ends, or -1; for one pattern, not anywhere."""
        state, end, moves, first_hit = self.start, -1, self.moves, self.first_hit
        for at in range(start, len(body)):
            state = moves[state + body[at]]
            if state >= first_hit:
                end = at + 1
            elif not state:
                break
        return end


def _closure(nfa: _Nfa, states: Iterable[int]) -> frozenset[int]:
    found, todo = set(states), list(states)
    while todo:
        for other in nfa.empty[todo.pop()]:
            if other not in found:
                found.add(other)
                todo.append(other)
    return frozenset(found)


def _subsets(
    nfa: _Nfa, root: int, finals: dict[int, int], anywhere: bool
) -> tuple[list[list[int]], list[frozenset[int]]]:
    """Subset construction; state 0 is dead and state 1 the start."""
    begin = _closure(nfa, [root])
    known: dict[frozenset[int], int] = {frozenset(): 0}
    known.setdefault(begin, 1)
    todo, moves, hits = [begin], [[0] * 256], [frozenset()]
    done = 0
    while done < len(todo):
        states = todo[done]
        done += 1
        targets: list[set[int]] = [set() for _ in ALL_BYTES]
        for state in states:
            for values, target in nfa.moves[state]:
                for value in values:
                    targets[value].add(target)
        row, made = [], {}
        for value in ALL_BYTES:
            key = frozenset(targets[value])
            if key not in made:
                after = _closure(nfa, [*key, root] if anywhere else key)
                if after not in known:
                    known[after] = len(known)
                    todo.append(after)
                made[key] = known[after]
            row.append(made[key])
        moves.append(row)
        hits.append(frozenset(finals[state] for state in states if state in finals))
    return moves, hits


def _minimal(
    moves: list[list[int]], hits: list[frozenset[int]]
) -> tuple[list[int], list[frozenset[int]], int, int]:
    """States that no input tells apart made one, by refining classes until they stay."""
    names = {hit: index for index, hit in enumerate(dict.fromkeys(hits))}
    part = [names[hit] for hit in hits]
    while True:
        seen: dict[tuple, int] = {}
        finer = [
            seen.setdefault((part[state], *(part[to] for to in row)), len(seen))
            for state, row in enumerate(moves)
        ]
        if len(seen) == len(set(part)):
            break
        part = finer
    # the dead state stays 0, states with matches go last
    classes: dict[int, int] = {}
    for state in range(len(moves)):
        classes.setdefault(part[state], state)
    rest = [name for name in classes if name != part[0]]
    ranked = [part[0], *sorted(rest, key=lambda name: bool(hits[classes[name]]))]
    number = {name: index for index, name in enumerate(ranked)}
    table = [
        number[part[to]] << 8 for name in ranked for to in moves[classes[name]]
    ]
    new_hits = [hits[classes[name]] for name in ranked]
    first = next((i for i, hit in enumerate(new_hits) if hit), len(ranked))
    return table, new_hits, number[part[1]] << 8, first << 8
