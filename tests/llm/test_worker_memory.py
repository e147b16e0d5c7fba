"""What a Python worker holds from one step to the next, and while it pairs classes."""

from __future__ import annotations

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa

from millrace.llm import ngram_join, word_ids
from millrace.llm.ngram_join import Likeness
from millrace.llm.quality import text_counts

BPE = public_tokenizers.path("word_bpe_49k.json")


def test_a_worker_forgets_words_when_it_goes_on_to_other_work():
    batch = pa.RecordBatch.from_arrays([pa.array([b"some words", b"more"])], names=["body"])
    (first,) = [ids for _, ids in word_ids.token_ids([batch], BPE, 1)]
    assert word_ids._word_ids.cache_info().currsize == 1
    text_counts.func(pd.Series(["other work"]))
    assert word_ids._word_ids.cache_info().currsize == 0
    (again,) = [ids for _, ids in word_ids.token_ids([batch], BPE, 1)]
    assert again == first


def test_pairs_are_added_up_a_bounded_number_at_a_time():
    holders, tokens = 100, 1000
    postings = np.zeros(holders * tokens, ngram_join._POSTING)
    postings["token"] = np.repeat(np.arange(tokens), holders)
    postings["cls"] = np.tile(np.arange(1, holders + 1), tokens)
    postings["size"] = 50
    made = list(ngram_join._pairs(*ngram_join._by_token(postings), Likeness(75)))
    total = ngram_join._summed(np.concatenate(made))
    pairs = holders * (holders - 1) // 2
    assert len(total) == pairs and set(total["n"].tolist()) == {tokens}
    assert max(part["n"].sum() for part in made) <= 2_000_000
