"""Sets of word shingles as sorted 64-bit hashes, for many texts at once."""

from __future__ import annotations

import numpy as np
import xxhash

from millrace.llm.hashing import mix, window_hashes
from millrace.llm.words import lower_words

_KEPT_WORDS = 250_000


class WordHashes(dict):
    """64-bit hashes of words, remembered; emptied by ``trim`` when there are too many."""

    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def trim(self) -> None:
        if len(self) > _KEPT_WORDS:
            self.clear()


def shingle_sets(
    bodies: list[bytes], width: int, known: WordHashes
) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of texts: (index of the text, hash), in order of both.

    A text with fewer words than ``width`` has its whole sequence as one shingle; one
    without words has none.
    """
    known.trim()
    lists = [lower_words(body) for body in bodies]
    sizes = np.array([len(found) for found in lists], np.int64)
    total = int(sizes.sum())
    hashes = np.fromiter(
        (known[word] for found in lists for word in found), np.uint64, count=total
    )
    text = np.repeat(np.arange(len(lists)), sizes)
    last = np.cumsum(sizes)[text] if total else np.zeros(0, np.int64)
    windows = window_hashes(hashes, width)
    inside = np.flatnonzero(np.arange(len(windows)) + width <= last[: len(windows)])
    texts, values = [text[inside]], [windows[inside]]
    starts = np.cumsum(sizes) - sizes
    for index in np.flatnonzero((sizes > 0) & (sizes < width)):
        start, size = int(starts[index]), int(sizes[index])
        whole = window_hashes(hashes[start : start + size], size)
        texts.append(np.array([index]))
        values.append(mix(whole + np.uint64(size)))
    text, value = np.concatenate(texts), np.concatenate(values)
    order = np.lexsort((value, text))
    text, value = text[order], value[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
    return text[new], value[new]
