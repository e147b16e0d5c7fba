"""Columns of whole queries against plain Python."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import plain
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer, models, pre_tokenizers

from millrace.llm import queries
from millrace.llm.decontaminate import plain_words

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    return {row["doc_id"]: row["text"] for row in docs}


def plain_tiling(item, text, least=4):
    """Words of an item that tiles cover: always the longest match left, found by trying all."""
    free_item, free_text = [True] * len(item), [True] * len(text)
    places = defaultdict(list)
    for at in range(len(text) - least + 1):
        places[tuple(text[at : at + least])].append(at)
    covered = 0
    while True:
        best = (0, 0, 0)
        for at in range(len(item) - least + 1):
            for place in places.get(tuple(item[at : at + least]), ()):
                size = 0
                while (
                    at + size < len(item)
                    and place + size < len(text)
                    and item[at + size] == text[place + size]
                    and free_item[at + size]
                    and free_text[place + size]
                ):
                    size += 1
                if size > best[0]:
                    best = (size, at, place)
        size, at, place = best
        if size < least:
            return covered
        covered += size
        free_item[at : at + size] = [False] * size
        free_text[place : place + size] = [False] * size


def test_leaks_of_all_documents(spark, texts):
    """Whether an item leaks, and how much of it, for all pairs that share four words in a row."""
    items = {
        row["item_id"]: plain_words(row["text"] or "")
        for row in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()
    }
    seeds = defaultdict(set)
    for name, words in items.items():
        for at in range(len(words) - 3):
            seeds[tuple(words[at : at + 4])].add(name)
    expected = {}
    for name, text in texts.items():
        words = plain_words(text or "")
        near = set()
        for at in range(len(words) - 3):
            near |= seeds.get(tuple(words[at : at + 4]), set())
        for item in near:
            covered = plain_tiling(items[item], words)
            if 2 * covered >= len(items[item]):
                expected[name, item] = covered
    found = {
        (row["doc_id"], row["item_id"]): row["covered_words"]
        for row in queries.op1_decontaminate(spark, SF_DIR).collect()
    }
    assert found == expected
    assert found


def test_token_counts_and_scores_of_all_documents(spark, texts):
    model = sentencepiece.SentencePieceProcessor(
        model_file=public_tokenizers.path("piece_bpe_32k.model")
    )
    vocabulary = [(model.id_to_piece(at), model.get_score(at)) for at in range(model.vocab_size())]
    tokenizer = Tokenizer(models.Unigram(vocabulary, 0, True))
    tokenizer.pre_tokenizer = pre_tokenizers.Metaspace(
        replacement="▁", prepend_scheme="always", split=True
    )
    score = dict(vocabulary)
    unknown = min(score.values()) - 10
    scored = 0
    for row in queries.op2_token_counts(spark, SF_DIR).collect():
        pieces = tokenizer.encode(texts[row["doc_id"]] or "").tokens
        assert row["n_tokens"] == len(pieces)
        bytes_of = [piece for piece in pieces if piece.startswith("<0x")]
        # a character without a piece is as many byte pieces as it has bytes, at one penalty
        characters = sum(not 0x80 <= int(piece[3:5], 16) < 0xC0 for piece in bytes_of)
        total = sum(score[piece] for piece in pieces if not piece.startswith("<0x"))
        assert row["score"] == pytest.approx(total + characters * unknown, rel=1e-9, abs=1e-6)
        scored += 1
    assert scored == len(texts)


def test_base_secrets_of_all_documents(spark):
    larger = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{larger}/documents.parquet").select("doc_id", "text").collect()
    texts, seen = dict(map(tuple, docs)), 0
    for row in queries.op8_secret_scan(spark, larger).collect():
        found = plain.secrets(texts[row["doc_id"]])
        listed = [f"{kind}:{start}:{end}" for kind, start, end in found]
        assert row["base_sha256"] == hashlib.sha256(",".join(listed).encode()).hexdigest()
        kinds = [kind for kind, _, _ in found]
        assert (row["n_assign"], row["n_access"], row["n_hex"]) == tuple(
            kinds.count(kind) for kind in ("assign", "access", "hex")
        )
        spans = row["spans"].split(",") if row["spans"] else []
        assert set(listed) <= set(spans)
        starts = [int(span.split(":")[1]) for span in spans]
        assert starts == sorted(starts)
        seen += len(found)
    assert seen


def test_pieces_of_all_documents(spark, texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for row in queries.op9_best_fit_packing(spark, SF_DIR).collect():
        pieces[row["doc_id"]].append((row["piece"], row["start"], row["length"], row["ids_crc32"]))
        sequences[row["sequence_id"]].append((row["offset"], row["length"]))
    total = 0
    for name, text in texts.items():
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        cuts = [ids[at : at + 4096] for at in range(0, len(ids), 4096)]
        assert sorted(pieces[name]) == [
            (piece, 4096 * piece, len(cut), zlib.crc32(cut.tobytes())) for piece, cut in enumerate(cuts)
        ]
        total += len(ids)
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 4096
    assert len(sequences) <= 1.02 * total / 4096 + 1
