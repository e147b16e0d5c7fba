"""Plain Python versions of what the operators do, for small inputs."""

from __future__ import annotations

import hashlib
import itertools
import math
import re
from collections import Counter, defaultdict

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").encode())


def lower_words(text):
    return WORD.findall((text or "").encode().translate(LOWER))


def counts(text):
    text = text or ""
    found = words(text)
    lines = [line for line in text.split("\n") if words(line)]
    windows = [tuple(found[at : at + 8]) for at in range(len(found) - 7)]
    often = Counter(windows)
    repeated = {
        at + step for at, window in enumerate(windows) if often[window] > 1 for step in range(8)
    }
    return (
        len(found),
        sum(len(word.decode()) for word in found),
        sum(text.count(symbol) for symbol in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        len(repeated),
        len(lines),
    )


def shingles(text, width=5):
    found = lower_words(text)
    if len(found) < width:
        return {tuple(found)} if found else set()
    return {tuple(found[at : at + width]) for at in range(len(found) - width + 1)}


def components(rows, percent=75):
    """Least id reachable, by position of the row."""
    sets = [shingles(text) for _, text in rows]
    parent = list(range(len(rows)))

    def root(node):
        while parent[node] != node:
            node = parent[node]
        return node

    for a, b in itertools.combinations(range(len(rows)), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            parent[root(a)] = root(b)
    least = defaultdict(list)
    for at, (name, _) in enumerate(rows):
        if name is not None:
            least[root(at)].append(name)
    return [
        (name, len(sets[at]), min(least[root(at)], default=None))
        for at, (name, _) in enumerate(rows)
    ]


ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)


def secrets(text):
    text = text or ""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [(("assign", "access", "hex")[kind], start, end) for start, kind, end in sorted(found)]


def without_repeats(texts, width=200):
    """Size, removed, runs and hash of what is left, of each text."""
    bodies = [(text or "").encode() for text in texts]
    seen = Counter(body[at : at + width] for body in bodies for at in range(len(body) - width + 1))
    result = []
    for body in bodies:
        gone = bytearray(len(body))
        for at in range(len(body) - width + 1):
            if seen[body[at : at + width]] > 1:
                gone[at : at + width] = b"\1" * width
        starts = sum(1 for at, flag in enumerate(gone) if flag and not (at and gone[at - 1]))
        left = bytes(value for value, flag in zip(body, gone, strict=True) if not flag)
        result.append((len(body), sum(gone), starts, hashlib.sha256(left).hexdigest()))
    return result


def tree_scores(train, texts, depth, times=1):
    """Log10 probabilities under context-tree weighting, straight from its definition.

    The texts to learn from count so many times.
    """
    nodes = defaultdict(lambda: [0, 0])

    def decisions(text):
        data = bytes(depth) + text + b"\xff"
        for at in range(depth, len(data)):
            for bit in range(8):
                yield data[at - depth : at], bit, data[at] >> (8 - bit), data[at] >> (7 - bit) & 1

    for text in train:
        for before, bit, prefix, value in decisions(text):
            for length in range(depth + 1):
                nodes[before[depth - length :], bit, prefix][value] += times
    longer = defaultdict(list)
    for before, bit, prefix in list(nodes):
        if before:
            longer[before[1:], bit, prefix].append((before, bit, prefix))

    def kt(zeros, ones):
        return (
            math.lgamma(zeros + 0.5)
            + math.lgamma(ones + 0.5)
            - math.log(math.pi)
            - math.lgamma(zeros + ones + 1)
        )

    weighted = {}
    for node in sorted(nodes, key=lambda n: -len(n[0])):
        own = kt(*nodes[node])
        if len(node[0]) < depth:
            deep = sum(weighted[other] for other in longer[node])
            high = max(own, deep)
            own = math.log(0.5) + high + math.log(math.exp(own - high) + math.exp(deep - high))
        weighted[node] = own

    def one(before, bit, prefix, length=0):
        node = (before[depth - length :], bit, prefix)
        if node not in weighted:
            return 0.5
        zeros, ones = nodes[node]
        chance = (ones + 0.5) / (zeros + ones + 1)
        if length == depth:
            return chance
        share = math.exp(math.log(0.5) + kt(zeros, ones) - weighted[node])
        return share * chance + (1 - share) * one(before, bit, prefix, length + 1)

    return [
        sum(
            math.log10(p if value else 1 - p)
            for before, bit, prefix, value in decisions(text)
            for p in [one(before, bit, prefix)]
        )
        for text in texts
    ]
