"""Runs of words against their definition."""

from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import plain
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from odd import no_docs, odd_docs, odd_rows  # noqa: F401

from millrace.llm import periodic_runs as module
from millrace.llm import queries
from millrace.llm.periodic_runs import collapsed, periodic_runs, word_runs
from millrace.llm.residues import PRIME, transform

SF_DIR = "/root/testdata/sf0.001"


def as_words(letters):
    return [letter.encode() for letter in letters]


def plain_runs(text, least=12):
    """Longest stretches of each period, the smallest period of equal stretches."""
    found = {}
    for period in range(1, len(text) // 2 + 1):
        at = 0
        while at + period < len(text):
            end = at
            while end + period < len(text) and text[end] == text[end + period]:
                end += 1
            length = end - at + period
            if end > at and length >= max(least, 2 * period):
                found.setdefault((at, length), period)
            at = end + 1
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda run: (run[0], run[2]))


def plain_collapsed(text, runs):
    gone = {at for start, length, period in runs for at in range(start + period, start + length)}
    return b" ".join(word for at, word in enumerate(text) if at not in gone)


@pytest.mark.parametrize("points", [4, 64, 128, 512, 4096])
@pytest.mark.parametrize("given_part", [1, 4])
def test_transform_is_exact(points, given_part):
    rng = np.random.default_rng(points)
    rows = rng.integers(-(PRIME // 2), PRIME // 2, (3, points // given_part)).astype(float)
    there = transform(rows, points)
    root = pow(3, (PRIME - 1) // points, PRIME)
    for at in (0, 1, points - 1):
        expected = sum(int(v) * pow(root, at * j, PRIME) for j, v in enumerate(rows[1]))
        assert (int(there[1, at]) - expected) % PRIME == 0
    back = transform(there, points, inverse=True)[:, : points // given_part]
    assert not ((back - rows * points) % PRIME).any()


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("ab", max_size=80) | st.text("abcdef", max_size=60), max_size=6))
def test_runs_of_random_texts(texts):
    texts = [as_words(text) for text in texts]
    assert word_runs(texts) == [plain_runs(text) for text in texts]


def periodic(rng, count, kinds):
    text = [b"%d" % rng.randrange(kinds) for _ in range(count)]
    start = rng.randrange(count)
    period = 1 + (count - start) // rng.randrange(2, 9)
    return [text[i] if i < start else text[start + (i - start) % period] for i in range(count)]


@pytest.mark.parametrize("most_points", [1 << 20, 32])
def test_runs_of_planted_texts(monkeypatch, most_points):
    """Also with transforms so short that large periods need several windows."""
    monkeypatch.setattr(module, "MOST_POINTS", most_points)
    rng = random.Random(2)
    for _ in range(20):
        texts = [periodic(rng, rng.choice([1, 12, 50, 300, 700]), rng.choice([2, 9, 400])) for _ in range(6)]
        assert word_runs(texts) == [plain_runs(text) for text in texts]


def test_one_word_over_and_over():
    text = [b"a"] * 40_000
    assert word_runs([text]) == [[(0, 40_000, 1)]]
    assert collapsed(text, [(0, 40_000, 1)]) == b"a"


def test_nested_and_overlapping_runs():
    inner = as_words("aaaaaaaaaaaab")
    text = inner * 3 + as_words("cd" * 7) + as_words("dcdcdcdcdcdc")
    runs = word_runs([text])[0]
    assert runs == plain_runs(text)
    assert {period for _, _, period in runs} >= {1, 13, 2}
    assert collapsed(text, runs) == plain_collapsed(text, runs)


def test_short_texts_have_none():
    assert word_runs([]) == []
    assert word_runs([[], [b"a"] * 11]) == [[], []]
    assert word_runs([[b"a"] * 11], least=11) == [[(0, 11, 1)]]


def test_operator_on_odd_rows(odd_docs, no_docs, odd_rows):
    assert periodic_runs(no_docs).count() == 0
    got = sorted(
        (
            (row["id"], row["n_words"], [tuple(run) for run in row["runs"]], bytes(row["collapsed"]))
            for row in periodic_runs(odd_docs).collect()
        ),
        key=repr,
    )
    expected = []
    for row in odd_rows:
        text = plain.words(row[1])
        runs = plain_runs(text)
        expected.append((row[0], len(text), runs, plain_collapsed(text, runs)))
    assert got == sorted(expected, key=repr)
    assert any(runs for _, _, runs, _ in got)


def test_query(spark):
    got = {row["doc_id"]: tuple(row)[1:] for row in queries.op12_periodic_runs(spark, SF_DIR).collect()}
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    assert len(got) == len(docs)
    checked = planted = 0
    for name, body in docs:
        text = plain.words(body)
        hashed = zlib.crc32(str(name).encode())
        g = hashed // 10
        if len(text) > 1200:
            continue
        if hashed % 10 == 0 and text:
            planted += 1
            a = g % len(text)
            p = 1 + (len(text) - a) // (3 + g % 8)
            text = [text[i] if i < a else text[a + (i - a) % p] for i in range(len(text))]
        runs = plain_runs(text)
        best = (None,) * 4
        if runs:
            start, length, period = min(runs, key=lambda run: (-run[1], run[0], run[2]))
            best = (start, length, period, 1000 * length // period)
        listed = "".join("%d,%d,%d\n" % run for run in runs)
        assert got[name] == (
            len(runs),
            *best,
            hashlib.sha256(listed.encode()).hexdigest(),
            hashlib.sha256(plain_collapsed(text, runs)).hexdigest(),
        )
        checked += 1
    assert checked > 150
    assert planted > 10
