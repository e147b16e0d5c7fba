"""Search for secrets: all rules in one pass over the bytes of a text.

A pass of the automaton of all rules tells which rules have a match in a text; most texts have
none. For the others an automaton of the reversed rules, run from the end, marks every place
where a match starts, and from the first such place on each rule's own automaton tells
where its longest match ends. What may follow a match and belongs to it is only looked for there.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from millrace.llm.automaton import Automaton, parsed, reversed_tree, without_case


@dataclass(frozen=True)
class Rule:
    """A kind of secret: ``lead`` before the value itself, which has a least length in bytes.

    ``tail`` is what belongs to the secret if it follows the value.
    """

    kind: str
    lead: str
    value: str
    least: int
    any_case: bool = False
    tail: str = ""


#: Header lines of a key, with line ends as they are or as escapes in a string.
_KEY_HEADERS = (
    r"""([\x20\x09\x0A\x0D"',>#*|]|\\[nrt])*([A-Za-z][A-Za-z0-9-]*:\x20"""
    r"""[\x20-\x5B\x5D-\x7E\x80-\xFF]*([\x0A\x0D]|\\[nr])+[\x20\x09"',>#*|]*)*"""
)
#: The rest of a key: up to its END line base64 and what lines are indented, quoted, joined or
#: escaped with, never five dashes; without an END line only lines of base64 and a last short one.
_KEY_BODY = (
    rf"{_KEY_HEADERS}("
    r"""(-{0,4}[A-Za-z0-9+/=\x20\x09\x0A\x0D\\"',>#*|<&;])*-{5,6}END ([A-Z]+ )*PRIVATE KEY( BLOCK)?-----"""
    r"""|(([\x20\x09\x0A\x0D"',>#*|]|\\[nrt])*[A-Za-z0-9+/]{40,}=*)+"""
    r"""(([\x0A\x0D]|\\[nr])+[\x20\x09"',>#*|]*[A-Za-z0-9+/]+=*)?)"""
)

#: Fixed patterns; the order tells how spans with the same start are listed.
RULES = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?""",
        r"[A-Za-z0-9+/_.=-]+",
        8,
        any_case=True,
    ),
    Rule("access", "", r"AKIA[A-Z0-9]+", 16),
    Rule("hex", "", r"[0-9a-f]{32,}", 32),
    Rule("github", "", r"gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("slack", "", r"xox[abprs]-[A-Za-z0-9-]+", 20),
    Rule(
        "private_key",
        "",
        r"-----BEGIN ([A-Z]+ )*PRIVATE KEY( BLOCK)?-----",
        0,
        tail=_KEY_BODY,
    ),
)

SPANS = ArrayType(
    StructType(
        [
            StructField("kind", StringType()),
            StructField("start", LongType()),
            StructField("end", LongType()),
        ]
    )
)


class Scanner:
    """Automata of a set of rules; built once for each worker process."""

    def __init__(self, rules: tuple[Rule, ...]) -> None:
        trees = []
        leads = []
        for rule in rules:
            tree, lead = parsed(rule.lead + rule.value), parsed(rule.lead)
            trees.append(without_case(tree) if rule.any_case else tree)
            leads.append(without_case(lead) if rule.any_case else lead)
        self.rules = rules
        self.any = Automaton(trees, anywhere=True)
        self.starts = Automaton([reversed_tree(tree) for tree in trees], anywhere=True)
        self.whole = [Automaton([tree], anywhere=False) for tree in trees]
        self.leads = [Automaton([lead], anywhere=False) for lead in leads]
        self.tails = [
            Automaton([parsed(rule.tail)], anywhere=False) if rule.tail else None for rule in rules
        ]

    def has_any(self, body: bytes) -> bool:
        """Whether any rule matches anywhere: the one pass over a text without secrets."""
        state, moves, first_hit = self.any.start, self.any.moves, self.any.first_hit
        for value in body:
            state = moves[state + value]
            if state >= first_hit:
                return True
        return False

    def spans(self, body: bytes) -> list[tuple[str, int, int]]:
        """Kind, start and end in bytes, leftmost and longest, without overlap within a kind."""
        if not self.has_any(body):
            return []
        places: list[list[int]] = [[] for _ in self.rules]
        state, moves, first_hit = self.starts.start, self.starts.moves, self.starts.first_hit
        for at in range(len(body) - 1, -1, -1):
            state = moves[state + body[at]]
            if state >= first_hit:
                for index in self.starts.patterns(state):
                    places[index].append(at)
        found = []
        for index, rule in enumerate(self.rules):
            free = 0
            for start in reversed(places[index]):
                if start < free:
                    continue
                end = self.whole[index].longest(body, start)
                if self.tails[index]:
                    end = max(end, self.tails[index].longest(body, end))
                free = end
                value = self.leads[index].longest(body, start) if rule.lead else start
                if end - value >= rule.least:
                    found.append((start, index, end))
        return [(self.rules[index].kind, start, end) for start, index, end in sorted(found)]


@cache
def scanner(rules: tuple[Rule, ...] = RULES) -> Scanner:
    return Scanner(rules)


def _spans_in_characters(text: str, rules: tuple[Rule, ...]) -> list[tuple[str, int, int]]:
    body = text.encode("utf-8", "surrogatepass")
    found = scanner(rules).spans(body)
    if not found or len(body) == len(text):
        return found
    points = sorted({place for _, start, end in found for place in (start, end)})
    characters, at, count = {}, 0, 0
    for point in points:
        count += len(body[at:point].decode("utf-8", "surrogatepass"))
        at = point
        characters[point] = count
    return [(kind, characters[start], characters[end]) for kind, start, end in found]


@F.pandas_udf(SPANS)
def secret_spans(texts: pd.Series) -> pd.Series:
    """Secrets of each text, by start and then rule; code points, end exclusive. Of a null: none."""
    return pd.Series(
        [
            [
                {"kind": kind, "start": start, "end": end}
                for kind, start, end in _spans_in_characters(text, RULES)
            ]
            if text
            else []
            for text in texts
        ],
        dtype=object,
    )


@F.pandas_udf(StringType())
def without_secrets(texts: pd.Series) -> pd.Series:
    """Each text with its secrets replaced by ``[kind]``; overlapping ones by the first's kind."""

    def cut(text: str | None) -> str | None:
        found = _spans_in_characters(text, RULES) if text else []
        if not found:
            return text
        parts, at = [], 0
        for kind, start, end in found:
            if start >= at:
                parts += [text[at:start], f"[{kind}]"]
            at = max(at, end)
        return "".join(parts) + text[at:]

    return texts.map(cut)
