"""The pipeline's stages against plain Python."""

from __future__ import annotations

import corpus_pipeline
import numpy as np
import plain
import public_tokenizers
import pytest
from odd import no_docs, odd_docs, odd_rows  # noqa: F401
from tokenizers import Tokenizer

from millrace.llm.shared import written

SF_DIR = "/root/testdata/sf0.001"
NAMES = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def steps(spark):
    """What goes in and comes out of each stage."""
    docs, found = spark.read.parquet(f"{SF_DIR}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        out = written(stage(spark, docs, SF_DIR), name.replace(" ", "-"))
        found[name] = (docs.collect(), out.collect())
        if name != "packing":
            assert out.columns == NAMES
        docs = out
    return found


def test_quality_rejects_failed_documents(steps):
    before, after = steps["quality rules"]
    kept = {row["doc_id"] for row in after}
    for row in before:
        n_words, *_, repeated = plain.counts(row["text"])
        if n_words < 20 or 100 * repeated > 30 * n_words:
            assert row["doc_id"] not in kept
    assert len(kept) > 0.75 * len(before)


def test_one_document_of_each_group_stays(steps):
    before, after = steps["near duplicates"]
    names = plain.components([(row["doc_id"], row["text"]) for row in before])
    assert sorted(row["doc_id"] for row in after) == sorted({least for _, _, least in names})


def test_leaked_documents_go(spark, steps):
    before, after = steps["decontamination"]
    items = spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()
    kept = {row["doc_id"] for row in after}
    gone = {row["doc_id"] for row in before} - kept
    whole = {row["doc_id"] for row in before if any(item["text"] in row["text"] for item in items)}
    assert whole <= gone
    assert len(gone) < 0.2 * len(before)


def test_secrets_are_gone(steps):
    before, after = steps["secrets"]
    texts = {row["doc_id"]: row["text"] for row in before}
    assert len(after) == len(before)
    for row in after:
        assert row["n_chars"] == len(row["text"])
        assert not plain.secrets(row["text"])
        if not plain.secrets(texts[row["doc_id"]]):
            assert row["text"] == texts[row["doc_id"]]


def test_all_documents_are_packed(steps):
    before, after = steps["packing"]
    assert {row["doc_id"] for row in after} == {row["doc_id"] for row in before}
    filled = {}
    for row in sorted(after, key=lambda r: (r["sequence_id"], r["offset"])):
        assert filled.get(row["sequence_id"], 0) == row["offset"]
        filled[row["sequence_id"]] = row["offset"] + row["length"]
    assert max(filled.values()) <= 4096


def test_sequences_hold_the_tokens_of_all_documents(steps):
    before, after = steps["packing"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = {
        row["doc_id"]: tokenizer.encode(row["text"], add_special_tokens=False).ids + [1]
        for row in before
    }
    found = {}
    for row in sorted(after, key=lambda r: (r["doc_id"], r["piece"])):
        ids = np.frombuffer(row["ids"], "<u4").tolist()
        assert len(ids) == row["length"]
        found.setdefault(row["doc_id"], []).extend(ids)
    assert found == expected


@pytest.mark.parametrize("stage", range(len(corpus_pipeline.STAGES)))
def test_stages_take_odd_rows(spark, odd_docs, no_docs, stage):
    name, function = corpus_pipeline.STAGES[stage]
    for docs in (written(odd_docs, "odd"), no_docs):
        out = function(spark, docs, SF_DIR)
        out.collect()
        if name != "packing":
            assert out.columns == docs.columns


def test_run(spark, steps):
    rows = corpus_pipeline.run(spark, SF_DIR).collect()
    assert sorted(map(tuple, rows), key=repr) == sorted(map(tuple, steps["packing"][1]), key=repr)
