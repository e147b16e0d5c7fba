"""Token ids of texts, word by word, with a bounded memory of words."""

from __future__ import annotations

import gc
import os
from collections.abc import Callable, Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from millrace.llm.blocks import text_chunks

#: Words in each of the two generations of a worker's memory.
_KEPT_WORDS = 600_000
_KEPT_LENGTH = 64
#: A word that hardly occurs in texts, and how many words go with marks between them.
_MARK = "\x01"
_GROUP = 64
#: Bytes of text whose new words are encoded together.
_CHUNK = 1 << 21


class WordIds:
    """Ids of words as packed bytes, remembered in two generations.

    When the young generation is full it becomes the old one, whose words return as they
    are met again; so common words stay and rare ones go.
    """

    def __init__(self, path: str, kept_words: int = _KEPT_WORDS) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        normalizer = self.tokenizer.normalizer
        self.small = normalizer is not None and normalizer.normalize_str("AZ") == "az"
        self.mark = np.array(self.tokenizer.encode(_MARK, add_special_tokens=False).ids, "<u4")
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values(), default=0) + 1, bool)
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        for token, number in vocabulary.items():
            self.ends[number] = bool(suffix) and token.endswith(suffix)
        self.kept_words = kept_words
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def ids(self, bodies: pa.Array | list[bytes]) -> list[bytes]:
        """Packed ids of each text; a word that texts share is looked up once."""
        if len(self.young) > self.kept_words:
            self.young, self.old = {}, self.young
        text = pa.array(bodies, pa.binary()).cast(pa.string())
        lists = pc.ascii_split_whitespace(pc.ascii_lower(text) if self.small else text)
        ends = np.cumsum(np.diff(np.asarray(lists.offsets)))
        coded = lists.flatten().cast(pa.binary()).dictionary_encode()
        word = np.asarray(coded.indices)
        packed = self._looked_up(_values(coded.dictionary))
        sizes = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
        flat = np.frombuffer(b"".join(packed), "<u4")
        count = sizes[word]
        upto = np.concatenate([[0], np.cumsum(count)])
        place = np.repeat((np.cumsum(sizes) - sizes)[word] - upto[:-1], count)
        place += np.arange(len(place))
        whole = flat[place].tobytes()
        last = (4 * upto[ends]).tolist()
        return [whole[a:b] for a, b in zip([0, *last], last, strict=False)]

    def _looked_up(self, distinct: list[bytes]) -> list[bytes]:
        """Packed ids of words, none of them twice; the empty word has none."""
        young, old = self.young, self.old
        found = list(map(young.get, distinct))
        gaps = [at for at, ids in enumerate(found) if ids is None]
        new = []
        for at in gaps:
            word = distinct[at]
            ids = old.get(word) if word else b""
            if ids is None:
                new.append(word)
            else:
                found[at] = young[word] = ids
        known = dict(zip(new, self.encoded([word.decode() for word in new]), strict=True))
        for at in gaps:
            if found[at] is None:
                found[at] = known[distinct[at]]
        young.update((word, ids) for word, ids in known.items() if len(word) <= _KEPT_LENGTH)
        return found

    def encoded(self, new: list[str]) -> list[bytes]:
        """Packed ids of words, many to a call.

        Letters alone end in one token that ends a word, which tells them apart; other
        words have a mark of one token between them. What does not come out so goes alone.
        """
        plain = [word.isalpha() for word in new]
        letters = [word for word, is_plain in zip(new, plain, strict=True) if is_plain]
        others = [word for word, is_plain in zip(new, plain, strict=True) if not is_plain]
        found = iter(self._in_groups(letters, " ", self._after_ends))
        rest = iter(self._in_groups(others, f" {_MARK} ", self._between_marks))
        return [next(found if is_plain else rest) for is_plain in plain]

    def _in_groups(
        self, new: list[str], glue: str, cut: Callable[[np.ndarray, int], list | None]
    ) -> list[bytes]:
        groups = [new[at : at + _GROUP] for at in range(0, len(new), _GROUP)]
        joined = self.tokenizer.encode_batch_fast(
            [glue.join(group) for group in groups], add_special_tokens=False
        )
        packed = []
        for group, encoding in zip(groups, joined, strict=True):
            ids = np.array(encoding.ids, "<u4")
            spans = cut(ids, len(group))
            if spans is None:
                alone = self.tokenizer.encode_batch_fast(group, add_special_tokens=False)
                packed += [np.array(each.ids, "<u4").tobytes() for each in alone]
            else:
                whole = ids.tobytes()
                packed += [whole[4 * a : 4 * b] for a, b in spans]
        return packed

    def _after_ends(self, ids: np.ndarray, count: int) -> list[tuple[int, int]] | None:
        ends = (np.flatnonzero(self.ends[ids]) + 1).tolist()
        if len(ends) != count or ends[-1] != len(ids):
            return None
        return list(zip([0, *ends[:-1]], ends, strict=True))

    def _between_marks(self, ids: np.ndarray, count: int) -> list[tuple[int, int]] | None:
        if len(self.mark) != 1:
            return None
        marks = np.flatnonzero(ids == self.mark[0]).tolist()
        if len(marks) != count - 1:
            return None
        return list(zip([0, *(mark + 1 for mark in marks)], [*marks, len(ids)], strict=True))


def _values(words: pa.BinaryArray) -> list[bytes]:
    """What ``to_pylist`` gives for an array without nulls, some times faster."""
    if not len(words):
        return []
    _, offsets, data = words.buffers()
    edges = np.frombuffer(offsets, np.int32)[words.offset : words.offset + len(words) + 1].tolist()
    whole = data.to_pybytes() if data is not None else b""
    return [whole[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]


@cache
def _word_ids(path: str) -> WordIds:
    """One memory of words for all tasks of a worker process."""
    return WordIds(path)


def forget_words() -> None:
    """Lets go of the memory of words, for a worker process that goes on to other work.

    A worker outlives the step that made it, and so would hundreds of megabytes of words.
    """
    if _word_ids.cache_info().currsize:
        _word_ids.cache_clear()
        gc.collect()
        pa.default_memory_pool().release_unused()


def token_ids(
    batches: Iterable[pa.RecordBatch], tokenizer: str, end_id: int
) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Rows of batches with a binary ``body``, some at a time, with the packed ids of each.

    ``tokenizer`` is the path of a vocabulary file that drops white space, on every
    executor; so words can be encoded one at a time. Every text ends with ``end_id``;
    an empty one has only that.
    """
    known = _word_ids(tokenizer)
    end = np.array([end_id], "<u4").tobytes()
    for batch in batches:
        for low, high in text_chunks(batch["body"], _CHUNK):
            part = batch.slice(low, high - low)
            yield part, [ids + end for ids in known.ids(part["body"])]
