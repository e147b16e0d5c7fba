"""Harmonic packing: nothing lost, places without gaps, little padding."""

from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
from odd import no_docs, odd_docs, odd_rows  # noqa: F401
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from millrace.llm import queries
from millrace.llm.harmonic import cut_lengths, cut_table, harmonic_pieces, settled
from millrace.llm.shared import written
from millrace.llm.word_ids import WordIds

SF_DIR = "/root/testdata/sf0.001"
BPE = public_tokenizers.path("word_bpe_49k.json")


def token_arrays(texts):
    tokenizer = Tokenizer.from_file(BPE)
    found = tokenizer.encode_batch([text or "" for text in texts], add_special_tokens=False)
    return [np.array([*each.ids, 1], "<u4") for each in found]


def padding(rows, capacity):
    """Checks places; ids and padding of all sequences."""
    sequences = defaultdict(list)
    for row in rows:
        sequences[row["sequence_id"]].append((row["offset"], row["length"]))
    total = lost = 0
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            assert length > 0
            at += length
        assert at <= capacity
        total += at
        lost += 0 if at & (at - 1) == 0 else capacity - at
    return total, lost


@pytest.mark.parametrize("capacity", [1, 2, 7, 64, 2048])
def test_cuts(capacity):
    table = cut_table(capacity, 8)
    assert all(1 <= table[length] <= length for length in range(1, capacity + 1))
    for length in {1, capacity - 1, capacity, capacity + 1, 5 * capacity + 3} - {0}:
        assert sum(cut_lengths(length, capacity, 8)) == length
        assert max(cut_lengths(length, capacity, 8)) <= capacity


def test_cuts_cost_least():
    capacity, cost = 60, 3.0

    def own(length):
        return capacity / (capacity // length) - length + cost

    best = [0.0]
    for length in range(1, capacity + 1):
        best.append(min(own(piece) + best[length - piece] for piece in range(1, length + 1)))
    for length in range(1, capacity):
        pieces = cut_lengths(length, capacity, cost)
        assert sum(map(own, pieces)) == pytest.approx(best[length])


@pytest.mark.parametrize("capacity", [8, 64, 2048])
def test_operator_on_odd_rows(odd_docs, no_docs, odd_rows, capacity):
    empty = settled(written(harmonic_pieces(no_docs, BPE, capacity=capacity), "t"), capacity)
    assert empty.count() == 0
    first = written(harmonic_pieces(odd_docs.repartition(5), BPE, capacity=capacity), "t")
    rows = settled(first, capacity).collect()
    total, lost = padding(rows, capacity)
    tokens = token_arrays([row[1] for row in odd_rows])
    assert total == sum(map(len, tokens))
    if capacity == 2048:
        assert lost <= 0.02 * total
    # pieces of texts that occur once, put together again
    by_id = defaultdict(list)
    for row in rows:
        by_id[row["id"]].append(row)
    for (name, *_), ids in zip(odd_rows, tokens, strict=True):
        if sum(name == other[0] for other in odd_rows) > 1:
            continue
        pieces = sorted(by_id[name], key=lambda row: row["start"])
        assert b"".join(row["ids"] for row in pieces) == ids.tobytes()
        assert {row["doc_tokens"] for row in pieces} == {len(ids)}
        assert all(4 * row["length"] == len(row["ids"]) for row in pieces)


def test_classes_hold_a_fixed_count(spark):
    """Sequences filled by a task hold k pieces of class k."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = harmonic_pieces(docs, BPE).where("sequence_id IS NOT NULL").collect()
    sequences = defaultdict(list)
    for row in rows:
        sequences[row["sequence_id"]].append(2048 // row["length"])
    assert sequences
    for classes in sequences.values():
        assert set(classes) == {len(classes)}


def test_many_rounds(spark):
    """Unfilled sequences of many tasks meet in several rounds."""
    docs = spark.range(0, 700, 1, 70).select(
        F.col("id").alias("doc_id"),
        F.array_join(F.array_repeat(F.lit("word"), (F.col("id") % 37).cast("int")), " ").alias("text"),
    )
    rows = settled(written(harmonic_pieces(docs, BPE, capacity=32), "t"), 32).collect()
    assert max(row["level"] for row in rows) >= 3
    total, lost = padding(rows, 32)
    assert total == sum(n % 37 + 1 for n in range(700))
    assert {row["id"] for row in rows} == set(range(700))


def test_query(spark):
    rows = queries.op13_harmonic_packing(spark, SF_DIR).collect()
    total, lost = padding(rows, 2048)
    assert lost < 0.005 * total
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    by_id = defaultdict(list)
    for row in rows:
        by_id[row["doc_id"]].append(row)
    assert len(by_id) == len(docs)
    for (name, _), ids in zip(docs, token_arrays([text for _, text in docs]), strict=True):
        at = 0
        for row in sorted(by_id[name], key=lambda row: row["start"]):
            assert row["start"] == at
            assert row["ids_crc32"] == zlib.crc32(ids[at : at + row["length"]].tobytes())
            assert row["doc_tokens"] == len(ids)
            at += row["length"]
        assert at == len(ids)


def test_word_memory_of_two_generations():
    """Common words outlive full memories, and ids stay right."""
    small = WordIds(BPE, kept_words=5)
    texts = [f"Common word{number} x{number}".encode() for number in range(40)]
    tokenizer = Tokenizer.from_file(BPE)
    for text in texts:
        (packed,) = small.ids([text])
        assert np.frombuffer(packed, "<u4").tolist() == tokenizer.encode(
            text.decode(), add_special_tokens=False
        ).ids
        assert len(small.young) <= 5 + 3
        assert b"common" in small.young
    words = [b"ab", b"\x01", b"c\x01d", b"\x01\x01", b"", *(b"w%d" % n for n in range(99))]
    words = [word for word in words if word]
    assert small.encoded([word.decode() for word in words]) == [
        np.array(tokenizer.encode(word.decode(), add_special_tokens=False).ids, "<u4").tobytes()
        for word in words
    ]
    long = b"z" * 200
    small.ids([long])
    assert long not in small.young
